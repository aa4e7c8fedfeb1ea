"""Joins that keep working when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1000


def join_heavy(facts: DataFrame, lookup: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of ``facts`` with one lookup row per key, given the facts per key in ``weight``.

    A key that holds more than 1/1000 of the facts is heavy; fewer than 1000 keys can be, so their
    lookup rows are broadcast whatever the size of the data, and their facts are not shuffled.
    All other keys are small enough for an ordinary shuffled join. No row is dropped. ``lookup``
    is read three times, so pass one that is cheap to read (cut its lineage first).
    """
    total = lookup.agg(F.sum(weight).alias("total")).scalar()
    columns = [c for c in lookup.columns if c not in (key, weight)]
    heavy = F.col(weight) * HEAVY_SHARE > F.col("__total")
    sized = lookup.withColumn("__total", total)
    row = F.struct(*columns).alias("__row")
    light_rows = sized.filter(~heavy).select(key, row)
    heavy_rows = sized.filter(heavy).select(key, F.struct(*columns).alias("__heavy"))
    tagged = facts.join(F.broadcast(heavy_rows), key, "left")
    rest = tagged.filter(F.col("__heavy").isNull()).drop("__heavy").join(light_rows, key)
    done = tagged.filter(F.col("__heavy").isNotNull()).withColumnRenamed("__heavy", "__row")
    fields = [F.col("__row")[c].alias(c) for c in columns]
    return done.select(*facts.columns, *fields).unionByName(rest.select(*facts.columns, *fields))
