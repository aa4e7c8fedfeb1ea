"""Quantile cuts against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from refrain.functions import selection


def plain(rows, column, buckets):
    """NTILE by sorting."""
    ordered = sorted(rows, key=lambda r: (selection.SMALLEST if r[column] is None else r[column], r[0]))
    small, extra = divmod(len(rows), buckets)
    sizes = [small + (k < extra) for k in range(buckets)]
    tiles = [k + 1 for k, size in enumerate(sizes) for _ in range(size)]
    return {r[0]: t for r, t in zip(ordered, tiles, strict=True)}


@pytest.mark.parametrize("n, buckets", [(1, 4), (3, 4), (4, 4), (997, 4), (997, 7)])
@pytest.mark.parametrize("spread", [1, 5, 10**15])
def test_ntiles(spark, n, buckets, spread):
    rng = random.Random(n)
    ids = rng.sample(range(-(10**12), 10**12), n)
    rows = [(i, rng.randrange(-spread, spread), rng.choice([None, 3, 8]), 7) for i in ids]
    df = spark.createDataFrame(rows, "id long, a long, b long, c long")
    made = selection.add_ntiles(df, {"ta": "a", "tb": "b", "tc": "c"}, "id", buckets).collect()
    for k, name in ((1, "ta"), (2, "tb"), (3, "tc")):
        assert {r["id"]: r[name] for r in made} == plain(rows, k, buckets)


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, a long")
    assert selection.quantile_cuts(df, ["a"], "id", 4) == {"a": []} and selection.add_ntiles(df, {"t": "a"}, "id", 4).count() == 0


def test_nothing_is_sorted(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("a"))
    plan = selection.add_ntiles(df, {"t": "a"}, "id", 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
