"""Late days, sketches that add up, and the layout by user."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from refrain.operators import segments, sketches
from refrain.plans import refresh
from refrain.plans.layers import read_layer, write_layers
from refrain.plans.warehouse import Warehouse

ROOT = "/root/testdata/sf0.001"


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_refreshed_layers_equal_a_full_build(spark, tmp_path):
    names = ["dws_song_daily", "ads_song_rank"]
    whole, late = str(tmp_path / "whole"), str(tmp_path / "late")
    w = Warehouse(spark, ROOT)
    write_layers(w, whole, names)
    day = F.to_date("comment_time")
    last = w.comment.agg(F.max(day)).first()[0]
    missing = day.isin([last - datetime.timedelta(days=6)])  # a whole day is missing at first
    part = Warehouse(spark, ROOT)
    part.comment = w.comment.filter(~missing)
    write_layers(part, late, names)
    assert rows(read_layer(spark, late, names[1])) != rows(read_layer(spark, whole, names[1]))
    days = refresh.touched_days(w.comment.filter(missing))
    assert days == [last - datetime.timedelta(days=6)]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "late" / "dws" / "dws_song_daily").rglob("*.parquet")}
    refresh.refresh_days(w, late, days)
    kept = {p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]}
    assert kept == set(before)  # the files of the other days were not written again
    for name in names:
        columns = read_layer(spark, whole, name).columns
        assert rows(read_layer(spark, late, name).select(columns)) == rows(read_layer(spark, whole, name))
    refresh.refresh_days(w, late, [])


def test_sketches_add_up(spark):
    rng = random.Random(2)
    start = datetime.datetime(2024, 5, 1)
    data = [(start + datetime.timedelta(days=rng.randrange(20)), rng.choice("aab"), rng.randrange(3000)) for _ in range(20000)] + [(None, "a", 1)]
    facts = spark.createDataFrame(data, "ts timestamp, k string, user_id long")
    daily = sketches.daily_sketches(facts, "ts", ["k"], "user_id")
    for low, high in ((1, 20), (3, 7)):
        inside = daily.filter(F.day("dt").between(low, high))
        chosen = [(k, u) for t, k, u in data if t and low <= t.day <= high]
        for r in sketches.merged_counts(inside, ["k"]).collect():
            exact = len({u for k, u in chosen if k == r.k})
            once = facts.filter(F.day("ts").between(low, high) & (F.col("k") == r.k)).agg(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", F.lit(12)))).first()[0]
            assert r.row_count == sum(k == r.k for k, _ in chosen)
            assert r.distinct_count == pytest.approx(exact, rel=0.065) and r.distinct_count == pytest.approx(once, rel=0.05)
    assert sketches.merged_counts(daily).first().row_count == 20000


def test_facts_by_user_are_grouped_where_they_lie(spark):
    w = Warehouse(spark, ROOT)
    stored = refresh.UserFacts(w.purchases, 4)
    try:
        churn = segments.churn_label(stored.frame, F.lit(datetime.date(1998, 1, 1)))
        assert "Exchange" not in churn._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in segments.churn_label(w.purchases, F.lit(datetime.date(1998, 1, 1)))._jdf.queryExecution().executedPlan().toString()
        cohort = segments.cohort_retention(stored.frame)
        assert rows(cohort) == rows(segments.cohort_retention(w.purchases))
        plan = segments.rfm_base(stored.frame, F.lit(datetime.date(1998, 1, 1)))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        stored.close()
