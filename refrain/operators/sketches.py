"""Distinct counts that can be added up: one sketch per day and key, merged for any range of days.

An exact distinct count of a month cannot be had from those of its days. A sketch of each day can be
stored beside the daily metrics, is a few kilobytes whatever it counts, and merges to the sketch of
any set of days, so that long ranges never read the facts again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 12  # 2^12 registers: a standard error of about 1.6 per cent


def daily_sketches(facts: DataFrame, moment: str, keys: Sequence[str], counted: str, precision: int = PRECISION) -> DataFrame:
    """(dt, keys, row_count, sketch) of the facts that have a time."""
    timed = facts.filter(F.col(moment).isNotNull())
    return timed.groupBy(F.to_date(moment).alias("dt"), *keys).agg(F.count(F.lit(1)).alias("row_count"), F.hll_sketch_agg(counted, F.lit(precision)).alias("sketch"))


def merged_counts(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, row_count, distinct_count) over all days of ``sketches``; filter those to a range first."""
    united = sketches.groupBy(*keys).agg(F.sum("row_count").alias("row_count"), F.hll_union_agg("sketch").alias("sketch"))
    return united.select(*keys, "row_count", F.hll_sketch_estimate("sketch").alias("distinct_count"))
