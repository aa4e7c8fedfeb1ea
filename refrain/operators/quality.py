"""Referential checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(facts: DataFrame, checks: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """For each (name, key, dimension, dimension_key): keys without a match, and the rows that hold them.

    A missing key is no orphan. The facts are read once for all checks and counted per key first, so
    a key that holds most rows is one row in the join. It is an outer join, because an anti join on
    the grouping key would be pushed down to the facts.
    """
    held = F.array(*[F.struct(F.lit(i).alias("check"), F.col(key).cast("long").alias("k")) for i, (_, key, _, _) in enumerate(checks)])
    keys = facts.select(F.inline(held)).filter(F.col("k").isNotNull()).groupBy("check", "k").agg(F.count(F.lit(1)).alias("n"))
    known = [d.select(F.lit(i).alias("check"), F.col(k).cast("long").alias("k"), F.lit(True).alias("known")) for i, (_, _, d, k) in enumerate(checks)]
    lost = keys.join(reduce(DataFrame.unionByName, known), ["check", "k"], "left").filter(F.col("known").isNull())
    counted = lost.groupBy("check").agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows"))
    names = facts.sparkSession.createDataFrame([(i, name) for i, (name, *_) in enumerate(checks)], "check int, foreign_key string")
    none = F.lit(0).cast("long")
    return names.join(counted, "check", "left").select("foreign_key", F.coalesce("keys", none).alias("orphan_keys"), F.coalesce("rows", none).alias("orphan_rows"))
