"""Quality of scored rows (row_id, label 0/1, score): AUC, average precision, F1, bootstrap.

All of them group equal scores first and use running totals over the distinct scores, which are
range-partitioned; no list of scores is collected anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions.ordering import range_count, running_totals
from refrain.session import cut_lineage


def _exact(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def _by_score(scored: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    label = F.col("label").cast("long")
    return scored.groupBy(*group, "score").agg(
        F.sum(label).alias("pos"), F.sum(1 - label).alias("neg")
    )


def auc_from_counts(counts: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """AUC per group from (score, pos, neg): share of pairs in order, ties count half."""
    running = running_totals(counts, ["score"], {"below": "neg"}, group)
    pairs2 = F.sum(_exact(F.col("pos")) * _exact(2 * F.col("below") - F.col("neg")))
    every = _exact(F.sum("pos")) * _exact(F.sum("neg"))
    value = F.try_divide(pairs2.cast("double"), 2 * every.cast("double"))
    return running.groupBy(*group).agg(
        value.alias("auc"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )


def auc(scored: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    return auc_from_counts(_by_score(scored, group), group)


def average_precision(scored: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Area under the precision-recall curve as average precision over the distinct scores."""
    running = running_totals(
        _by_score(scored, group),
        [F.desc("score")],
        {"tp": "pos", "fp": "neg"},
        group,
        grand={"all_pos": "pos"},
    )
    step = F.col("pos") / F.col("all_pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return running.groupBy(*group).agg(F.sum(F.when(F.col("all_pos") > 0, step)).alias("pr_auc"))


def confusion(scored: DataFrame, group: Sequence[str] = (), *, threshold: float = 0.5) -> DataFrame:
    """F1, accuracy and the support of both classes at a threshold."""
    hit, true = F.col("score") >= threshold, F.col("label") == 1
    counts = scored.groupBy(*group).agg(
        F.count_if(hit & true).alias("tp"),
        F.count_if(hit & ~true).alias("fp"),
        F.count_if(~hit & true).alias("fn"),
        F.count_if(~hit & ~true).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *group,
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        (tp + fn).alias("support_pos"),
        (fp + tn).alias("support_neg"),
    )


def poisson_thresholds() -> list[int]:
    """Distribution function of Poisson(1) in units of 2**-32, up to where it reaches 1."""
    total, term, steps = 0.0, math.exp(-1), []
    for k in range(1, 13):
        total += term
        steps.append(math.floor(total * 2**32))
        term /= k
    return steps


def poisson_weights(ids: Sequence[str], replicates: int) -> np.ndarray:
    """How often each row occurs in each replicate: Poisson(1) by inversion of 32 digest bits.

    They depend on the ids only, so a task that runs again draws the same sample.
    """
    ends = [b":%d" % b for b in range(1, replicates + 1)]
    digests = b"".join([md5(i + end).digest() for i in (x.encode() for x in ids) for end in ends])
    draws = np.frombuffer(digests, ">u4")[::4].astype(np.int64)  # the first of the four words of a digest
    return np.searchsorted(poisson_thresholds(), draws, side="right").reshape(len(ids), replicates)


class _Pairs:
    """Counts of one group in a range of scores, for all replicates at a time.

    Scores come in ascending order. The first and the last one may go on in other ranges, so they are
    given apart from what lies between them, where pairs can be counted.
    """

    def __init__(self, group: tuple, replicates: int) -> None:
        self.group, self.open, self.started = group, None, False
        self.low, self.pos, self.neg, self.pairs2 = None, *np.zeros((3, replicates), np.int64)
        self.out: list[tuple] = []

    def _whole(self, score: float, pos: np.ndarray, neg: np.ndarray) -> None:
        self.out.append((*self.group, score, True, pos, neg, np.zeros_like(pos)))

    def add(self, scores: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> None:
        """Different scores with their weights; the first may be the one added last."""
        if self.open is not None and self.open[0] == scores[0]:
            pos[0] += self.open[1]
            neg[0] += self.open[2]
        elif self.open is not None:
            scores, pos, neg = np.append(self.open[0], scores), np.vstack([self.open[1], pos]), np.vstack([self.open[2], neg])
        if len(scores) > 1 and not self.started:
            self._whole(scores[0], pos[0], neg[0])
            self.started, scores, pos, neg = True, scores[1:], pos[1:], neg[1:]
        self.open = (scores[-1], pos[-1], neg[-1])
        if len(scores) > 1:
            scores, pos, neg = scores[:-1], pos[:-1], neg[:-1]
            self.low = scores[0] if self.low is None else self.low
            below = np.cumsum(neg, axis=0) - neg + self.neg
            self.pairs2 += (pos * (2 * below + neg)).sum(axis=0)
            self.pos, self.neg = self.pos + pos.sum(axis=0), self.neg + neg.sum(axis=0)

    def segments(self) -> list[tuple]:
        """(group, score, whether a single score, positives, negatives, twice the ordered pairs)."""
        if self.low is not None:
            self.out.append((*self.group, self.low, False, self.pos, self.neg, self.pairs2))
        if self.open is not None:
            self._whole(*self.open)
        return self.out


def bootstrap_segments(scored: DataFrame, group: Sequence[str], replicates: int) -> DataFrame:
    """(group, low, single, pos, neg, pairs2): at most three rows for each range of scores and group.

    Rows are sorted by score once, and carry their weights in all replicates as an array; the salt
    cuts a score that very many rows share.
    """
    parts = range_count(scored.sparkSession)
    rows = scored.select(*group, F.col("label").cast("int").alias("__label"), F.col("score").cast("double").alias("__score"), F.col("row_id").cast("string").alias("__id"))
    salted = rows.repartitionByRange(parts, *group, "__score", F.xxhash64("__id")).sortWithinPartitions(*group, "__score")
    width = len(group)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scored.select(*group).schema) + (", " if group else "")
    schema = kinds + "low double, single boolean, pos array<bigint>, neg array<bigint>, pairs2 array<bigint>"
    names = [*group, "low", "single", "pos", "neg", "pairs2"]
    arrays = [pa.float64(), pa.bool_(), *[pa.list_(pa.int64())] * 3]

    def made(found: list[tuple], keys: list[pa.DataType]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], kind) for i, kind in enumerate([*keys, *arrays])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Pairs | None = None
        types: list[pa.DataType] = []
        for whole in batches:
            types = [f.type for f in whole.schema][:width]
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                keys = list(zip(*(batch.column(i).to_pylist() for i in range(width)), strict=True)) if width else [()] * batch.num_rows
                labels, scores = (batch.column(width + i).to_numpy(zero_copy_only=False) for i in (0, 1))
                weights = poisson_weights(batch.column(width + 2).to_pylist(), replicates)
                edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
                for a, b in zip(edges, edges[1:], strict=False):
                    if now is None or now.group != keys[a]:
                        if now is not None:
                            yield made(now.segments(), types)
                        now = _Pairs(keys[a], replicates)
                    firsts = np.flatnonzero(np.append(True, scores[a + 1 : b] != scores[a : b - 1]))
                    hit = labels[a:b, None] == 1
                    now.add(scores[a:b][firsts], *(np.add.reduceat(np.where(x, weights[a:b], 0), firsts, axis=0) for x in (hit, ~hit)))
        if now is not None:
            yield made(now.segments(), types)

    return salted.mapInArrow(run, schema)


def bootstrap_auc(
    scored: DataFrame, group: Sequence[str] = (), *, replicates: int = 100, level: float = 0.95
) -> DataFrame:
    """Percentile interval of the AUC over Poisson bootstrap replicates.

    The rows are shuffled once, each as it is; what follows works on a few rows for each range.
    """
    segments = cut_lineage(bootstrap_segments(scored, group, replicates))
    each = segments.select(*group, "low", "single", F.posexplode(F.arrays_zip("pos", "neg", "pairs2")).alias("replicate", "w"))
    folded = each.groupBy(*group, "replicate", "single", "low").agg(*[F.sum(F.col("w")[c]).alias(c) for c in ("pos", "neg", "pairs2")])
    before = Window.partitionBy(*group, "replicate").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    pos, neg, below = _exact(F.col("pos")), _exact(F.col("neg")), _exact(F.coalesce("below", F.lit(0).cast("long")))
    own = F.when(F.col("single"), pos * neg).otherwise(F.col("pairs2").cast("decimal(38,0)"))
    pairs2 = F.sum(own + 2 * pos * below)
    every = _exact(F.sum("pos")) * _exact(F.sum("neg"))
    placed = folded.withColumn("below", F.sum("neg").over(before))
    aucs = placed.groupBy(*group, "replicate").agg(F.try_divide(pairs2.cast("double"), 2 * every.cast("double")).alias("auc"))
    tail = (1 - level) / 2
    return aucs.groupBy(*group).agg(
        F.count("auc").alias("replicates"),
        F.round(F.avg("auc"), 6).alias("auc_mean"),
        F.round(F.percentile("auc", tail), 6).alias("auc_ci_lower"),
        F.round(F.percentile("auc", 1 - tail), 6).alias("auc_ci_upper"),
    )
