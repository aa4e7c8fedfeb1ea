"""Exact Shapley values of a forest's predictions.

Left out, a feature is averaged over: at its nodes both branches count, by the share of training
weight that went each way. A leaf then adds its value times one factor for each feature on its
path: 1 or 0, whether the row keeps to the feature's interval, where the feature is given, and the
product of its shares where not. The Shapley values of such a product follow from the coefficients
of a polynomial with one linear factor per feature, and they depend on the row only by which of
the (at most ``maxDepth``) intervals it keeps to. So each leaf becomes a small table of effects by
that pattern, made once; a row looks up one line of each. The tables are as large as the model,
and rows are only read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.session import remove_path, scratch_path


@dataclass
class Leaf:
    """A path: its features with their intervals (low, high] and shares, and the effects by pattern."""

    features: np.ndarray
    shares: list[float]
    low: np.ndarray
    high: np.ndarray
    value: float
    expected: float
    effects: np.ndarray  # 2^d patterns by d features


def shapley_effects(value: float, shares: list[float]) -> np.ndarray:
    """Shapley values of ``value * product of factors`` for every pattern of intervals kept."""
    d = len(shares)
    effects = np.zeros((1 << d, d))
    for pattern in range(1 << d):
        kept = [pattern >> j & 1 for j in range(d)]
        for i in range(d):
            # coefficient s: sum over the subsets of size s of the other features
            polynomial = np.ones(1)
            for j in range(d):
                if j != i:
                    polynomial = np.convolve(polynomial, [shares[j], kept[j]])
            weight = [math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d) for s in range(d)]
            effects[pattern, i] = value * (kept[i] - shares[i]) * float(polynomial @ weight)
    return effects


def model_nodes(spark, model) -> dict[int, dict[int, dict]]:
    """The nodes of every tree as Spark's own writer lists them; as many as the model has."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*").collect()
    remove_path(spark, path)
    trees: dict[int, dict[int, dict]] = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["id"]] = r.asDict(recursive=True)
    return trees


def forest_leaves(spark, model) -> list[Leaf]:
    """The paths of a random forest whose splits are thresholds; a leaf's value is its share of class 1 over the number of trees."""
    trees = model_nodes(spark, model)
    leaves: list[Leaf] = []

    def walk(nodes: dict[int, dict], at: int, intervals: dict[int, tuple[float, float, float]]) -> None:
        node = nodes[at]
        weight = sum(node["impurityStats"])
        if node["leftChild"] < 0:
            features = sorted(intervals)
            value = node["impurityStats"][1] / weight / len(trees) if weight else 0.0
            shares = [intervals[f][2] for f in features]
            low, high = (np.array([intervals[f][k] for f in features]) for k in (0, 1))
            leaves.append(Leaf(np.array(features, np.int64), shares, low, high, value, value * math.prod(shares), shapley_effects(value, shares)))
            return
        if node["split"]["numCategories"] != -1:
            raise ValueError("splits on categories are not supported")
        f, threshold = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
        low, high, share = intervals.get(f, (-math.inf, math.inf, 1.0))
        for child, bounds in ((node["leftChild"], (low, min(high, threshold))), (node["rightChild"], (max(low, threshold), high))):
            part = sum(nodes[child]["impurityStats"]) / weight
            walk(nodes, child, intervals | {f: (*bounds, share * part)})

    for nodes in trees.values():
        walk(nodes, 0, {})
    return leaves


def attribute(values: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    """Shapley values of all features for each row of ``values``."""
    out = np.zeros(values.shape)
    for leaf in leaves:
        if not len(leaf.features):
            continue
        own = values[:, leaf.features]
        kept = (own > leaf.low) & (own <= leaf.high)
        out[:, leaf.features] += leaf.effects[kept @ (1 << np.arange(len(leaf.features)))]
    return out


def tree_attribution(frame: DataFrame, model) -> DataFrame:
    """(row_id, base, effects) of (row_id, features): ``base`` and the effects add up to the prediction."""
    leaves = forest_leaves(frame.sparkSession, model)
    base = sum(leaf.expected for leaf in leaves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column(1).to_pylist(), np.float64).reshape(batch.num_rows, -1)
            effects = attribute(rows, leaves)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([base] * batch.num_rows, pa.float64()), pa.array(list(effects), pa.list_(pa.float64()))], names=["row_id", "base", "effects"])

    narrow = frame.select(F.col("row_id").cast("long").alias("row_id"), vector_to_array("features").alias("x"))
    return narrow.mapInArrow(run, "row_id bigint, base double, effects array<double>")


def mean_attribution(attributed: DataFrame, features: list[str]) -> DataFrame:
    """Per feature: mean of the effects and of their size, six decimals."""
    each = attributed.select(F.posexplode("effects").alias("j", "effect"))
    names = F.array(*[F.lit(f) for f in features])
    means = each.groupBy("j").agg(F.round(F.avg(F.abs("effect")), 6).alias("mean_abs_attribution"), F.round(F.avg("effect"), 6).alias("mean_attribution"))
    return means.select(F.get(names, F.col("j")).alias("feature"), "mean_abs_attribution", "mean_attribution")
