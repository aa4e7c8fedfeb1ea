"""Distributed ranks against the textbook definitions, with hot groups and ties."""

import random

import pytest
from pyspark.sql import functions as F

from refrain.functions.joins import join_heavy
from refrain.functions.ordering import add_ntile, add_rank, number_rows, running_totals


def rows_with_a_hot_group(n=600):
    """One group holds well over a third of the rows; values repeat."""
    rng = random.Random(7)
    return [(i, "hot" if i % 2 else f"g{rng.randrange(40)}", rng.randrange(12)) for i in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows_with_a_hot_group(), "id long, g string, v long")


def test_number_rows_per_group(frame):
    got = {r.id: (r.row_no, r.n) for r in number_rows(frame, [F.desc("v"), "id"], ["g"], size="n").collect()}
    groups = {}
    for i, g, v in rows_with_a_hot_group():
        groups.setdefault(g, []).append((-v, i))
    want = {
        i: (place, len(members))
        for members in groups.values()
        for place, (_, i) in enumerate(sorted(members), 1)
    }
    assert got == want


def test_number_rows_null_group(spark):
    frame = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, g string")
    got = {r.id: r.row_no for r in number_rows(frame, ["id"], ["g"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10, 33])
def test_ntile_remainders(spark, n):
    frame = spark.range(n).withColumn("v", F.lit(1))  # all tied
    got = {r.id: r.t for r in add_ntile(frame, 4, ["v", "id"], "t").collect()}
    frame.createOrReplaceTempView("tiles")
    want = {
        r.id: r.t for r in spark.sql("SELECT id, ntile(4) OVER (ORDER BY v, id) AS t FROM tiles").collect()
    }
    assert got == want


def test_rank_shares_ties(frame):
    got = {r.id: (r.r, r.n) for r in add_rank(frame, "v", "id", rank="r", size="n").collect()}
    values = [v for _, _, v in rows_with_a_hot_group()]
    want = {i: (1 + sum(x < v for x in values), len(values)) for i, _, v in rows_with_a_hot_group()}
    assert got == want


def test_running_totals_with_group_and_grand_total(frame):
    out = running_totals(frame, ["v", "id"], {"upto": "v"}, ["g"], grand={"all_v": "v"})
    got = {r.id: (r.upto, r.all_v) for r in out.collect()}
    groups = {}
    for i, g, v in rows_with_a_hot_group():
        groups.setdefault(g, []).append((v, i))
    want = {}
    for members in groups.values():
        total, grand = 0, sum(v for v, _ in members)
        for v, i in sorted(members):
            total += v
            want[i] = (total, grand)
    assert got == want


def test_a_hot_group_is_spread_over_the_ranges(spark):
    from refrain.functions.ordering import _ranged

    hot = spark.range(20000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("g"))
    sizes = [r["count"] for r in _ranged(hot, ["g"], ["id"]).groupBy("__range").count().collect()]
    assert sum(sizes) == 20000 and len(sizes) == 5 and max(sizes) < 2 * 20000 / 5


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id long, g string, v long")
    assert number_rows(empty, ["id"], ["g"]).count() == 0
    assert add_rank(empty, "v", "id", rank="r").count() == 0


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_same_result_for_any_partitioning(spark, frame, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = sorted((r.id, r.row_no) for r in number_rows(frame, ["v", "id"]).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted((v, i) for i, _, v in rows_with_a_hot_group())
    assert got == sorted((i, place) for place, (_, i) in enumerate(order, 1))


def test_heavy_join_equals_plain_join(spark):
    facts = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1700).alias("k")
    )
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    lookup = counts.withColumn("name", F.concat(F.lit("k"), F.col("k").cast("string"))).filter("k <> 5")
    got = sorted(map(tuple, join_heavy(facts, lookup, "k", "n").select("id", "name").collect()))
    want = sorted(map(tuple, facts.join(lookup, "k").select("id", "name").collect()))
    assert got == want
