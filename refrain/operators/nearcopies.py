"""Near copies by 60-bit SimHash signatures.

1. Signature: every word occurrence votes with the first 60 bits of its MD5. The votes of a
   document are counted where its text is read, and different words are hashed once per batch;
   nothing is shuffled.
2. Equal signatures are folded to one representative first: copies never meet each other in a
   join, however many there are.
3. Distinct signatures within three bits of each other: cut the 60 bits into six blocks. Three
   differing bits touch at most three blocks, so at least three blocks are equal, and joining on
   each of the 20 choices of three blocks (30 bits) finds every pair.
4. A choice that too many signatures share is cut again in the same way over its other 30 bits.
   A bucket then fixes 45 bits and holds at most 2**15 distinct signatures. Nothing is capped.
5. Connected components over the representatives; the earliest document of each is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.functions.joins import join_heavy
from refrain.functions.ordering import range_count
from refrain.operators.components import components
from refrain.operators.tokens import words
from refrain.session import cut_lineage

BITS = 60
HALF = BITS // 2
DISTANCE = 3
CROWDED = 1024  # signatures per bucket beyond which it is cut again, so that none is compared with more in a choice


def word_hash(word: str) -> int:
    """First 60 bits of the MD5 digest."""
    return int.from_bytes(md5(word.encode()).digest()[:8]) >> 4


def majority(words: pa.ListArray) -> pa.Array:
    """Signature of every list of words: the bits that more than half of its words have; NULL without words.

    Bits i and i + 30 of a word are counted in one integer, 30 binary digits each. A text of at most
    2**31 bytes has fewer than 2**30 words, so the lower counter never runs into the upper one.
    """
    n = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    some = np.flatnonzero(n)
    signed = np.zeros(len(n), np.int64)
    if len(some):
        coded = words.flatten().dictionary_encode()
        hashes = np.array([word_hash(w) for w in coded.dictionary.to_pylist()], np.int64)
        codes = coded.indices.to_numpy()
        starts = (np.cumsum(n) - n)[some]
        for i in range(HALF):
            counted = np.add.reduceat((hashes >> i & (1 << HALF | 1))[codes], starts)
            low, high = counted & (1 << HALF) - 1, counted >> HALF
            signed[some] |= (2 * low > n[some]).astype(np.int64) << i | (2 * high > n[some]).astype(np.int64) << i + HALF
    return pa.array(signed, mask=n == 0)


def profiles(documents: DataFrame, **kept: Column) -> DataFrame:
    """(doc_id, kept columns, signature) of every document, read once; the signature is NULL without words."""
    read = documents.select("doc_id", *[c.alias(name) for name, c in kept.items()], words(F.col("text")).alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], majority(part.column(part.num_columns - 1))], names=[*part.schema.names[:-1], "signature"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.schema[:-1])
    return read.mapInArrow(run, f"{kinds}, signature bigint")


def signatures(documents: DataFrame) -> DataFrame:
    """(doc_id, signature) for every document with at least one word."""
    return profiles(documents).filter(F.col("signature").isNotNull())


def _masks(positions: list[int], blocks: int = 2 * DISTANCE, equal: int = DISTANCE) -> list[int]:
    """Bit masks of all choices of ``equal`` blocks out of ``blocks`` over the given positions."""
    size = len(positions) // blocks
    parts = [sum(1 << p for p in positions[i * size : (i + 1) * size]) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, equal)]


def _longs(values: list[int]) -> str:
    return "array(" + ", ".join(f"{v}L" for v in values) + ")"


OUTER = _masks(list(range(BITS)))
INNER = [_masks([p for p in range(BITS) if not mask >> p & 1]) for mask in OUTER]


def _first_equal(difference: Column, masks: list[Column]) -> Column:
    """Zero-based number of the first choice of blocks in which two signatures agree."""
    return F.coalesce(*[F.when(difference.bitwiseAND(m) == 0, i) for i, m in enumerate(masks)])


def _matches(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of different signatures of one bucket within the distance."""
    left = buckets.select(*keys, F.col("signature").alias("low"))
    right = buckets.select(*keys, F.col("signature").alias("high"))
    difference = F.col("low").bitwiseXOR(F.col("high"))
    pairs = left.join(right, keys).filter(F.col("low") < F.col("high"))
    close = pairs.filter(F.bit_count(difference) <= DISTANCE)
    # A pair is found once per choice it agrees in; it is reported by the first of them only.
    return close.filter(_first_equal(difference, [F.lit(m) for m in OUTER]) == F.col("slot"))


def close_pairs(distinct: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(low, high) pairs of distinct signatures at most three bits apart; ``distinct`` has signature."""
    parts = F.transform(F.expr(_longs(OUTER)), lambda m: F.col("signature").bitwiseAND(m))
    keys = ["slot", "part"]
    # dealt by number: few bytes make many pairs, so small partitions are not to be put together
    buckets = distinct.select("signature", F.posexplode(parts).alias(*keys)).repartition(range_count(distinct.sparkSession), *keys)
    load = buckets.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowded)
    small = _matches(buckets.join(load, keys, "left_anti"), keys).select("low", "high")

    inner = F.element_at(F.expr(f"array({', '.join(_longs(m) for m in INNER)})"), F.col("slot") + 1)
    finer = F.transform(inner, lambda m: F.col("signature").bitwiseAND(m))
    split = buckets.join(load, keys, "left_semi").select(
        "signature", *keys, F.posexplode(finer).alias("inner_slot", "inner_part")
    )
    difference = F.col("low").bitwiseXOR(F.col("high"))
    agrees = F.transform(inner, lambda m: difference.bitwiseAND(m) == 0)
    large = _matches(split, [*keys, "inner_slot", "inner_part"]).filter(F.array_position(agrees, True) - 1 == F.col("inner_slot"))
    return small.unionByName(large.select("low", "high"))


def near_groups(signed: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(doc_id, keep_id): every signed document and the earliest document of its near copies."""
    signed = cut_lineage(signed)  # the texts are read once; 16 bytes per document remain
    folded = cut_lineage(
        signed.groupBy("signature").agg(
            F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")
        )
    )
    pairs = close_pairs(folded.select("signature"), crowded)
    first = folded.select("signature", "first_id")
    edges = pairs.join(first.toDF("low", "a"), "low").join(first.toDF("high", "b"), "high")
    roots = components(edges.select("a", "b"))
    kept = folded.join(roots, folded["first_id"] == roots["node"], "left").select(
        "signature", "copies", F.coalesce("root", "first_id").alias("keep_id")
    )
    return join_heavy(signed, cut_lineage(kept), "signature", "copies").select("doc_id", "keep_id")
