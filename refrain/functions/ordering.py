"""Exact ranks, running totals and buckets over total orders, without single-task windows.

A plain ``row_number() over (order by x)`` sends every row to one task, and ``partition by song``
sends a hot song to one task. Here the rows are range-partitioned on (group, order), so a hot
group is cut into as many ranges as it needs; positions inside a range are counted locally and
the ranges are stitched together with one row per (range, group).

The order columns must be unique within a group. The ranged rows are checkpointed before they
are counted: offsets and rows then come from the same materialised ranges even when an executor
is lost and its tasks run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refrain.session import cut_lineage

_RANGE = "__range"
_LOCAL = "__local"
_LOCAL_BITS = 33  # layout of monotonically_increasing_id: partition number above 33 bits of position


def range_count(spark: SparkSession) -> int:
    """Ranges to cut into: the partitions a shuffle starts with on this cluster."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def _ranged(df: DataFrame, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    keys = [*group, *order]
    ordered = df.repartitionByRange(range_count(df.sparkSession), *keys).sortWithinPartitions(*keys)
    position = F.monotonically_increasing_id()
    ranged = ordered.withColumn(_LOCAL, position).withColumns(
        {
            _RANGE: F.shiftright(_LOCAL, _LOCAL_BITS),
            _LOCAL: F.col(_LOCAL).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
        }
    )
    return cut_lineage(ranged)


def _attach(rows: DataFrame, offsets: DataFrame, group: Sequence[str]) -> DataFrame:
    """Join the per-(range, group) offsets back; no key is wider than one range."""
    renamed = offsets.select(
        F.col(_RANGE).alias("__o_range"),
        *[F.col(c).alias(f"__o_{c}") for c in group],
        *[c for c in offsets.columns if c != _RANGE and c not in group],
    )
    if not group:
        renamed = F.broadcast(renamed)  # one row per range: bounded by the shuffle partition count
    same = [rows[_RANGE] == renamed["__o_range"]]
    same += [rows[c].eqNullSafe(renamed[f"__o_{c}"]) for c in group]
    joined = rows.join(renamed, reduce(lambda a, b: a & b, same))
    return joined.drop("__o_range", *[f"__o_{c}" for c in group])


def number_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    group: Sequence[str] = (),
    *,
    index: str = "row_no",
    size: str | None = None,
) -> DataFrame:
    """Add ``index`` = row_number() over (partition by group order by order), and the group size."""
    rows = _ranged(df, group, order)
    parts = rows.groupBy(_RANGE, *group).agg(
        F.count(F.lit(1)).alias("__n"), F.min(_LOCAL).alias("__first")
    )
    across = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = across.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumns(
        {
            "__before": F.coalesce(F.sum("__n").over(before), F.lit(0)),
            "__total": F.sum("__n").over(across),
        }
    ).drop("__n")
    numbered = _attach(rows, offsets, group).withColumn(
        index, F.col(_LOCAL) - F.col("__first") + F.col("__before") + 1
    )
    if size is not None:
        numbered = numbered.withColumn(size, F.col("__total"))
    return numbered.drop(_RANGE, _LOCAL, "__first", "__before", "__total")


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    totals: dict[str, str],
    group: Sequence[str] = (),
    grand: dict[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sums ``totals = {new: source}`` and group sums ``grand = {new: source}``."""
    grand = grand or {}
    sources = sorted({*totals.values(), *grand.values()})
    rows = _ranged(df, group, order)
    parts = rows.groupBy(_RANGE, *group).agg(*[F.sum(s).alias(f"__s_{s}") for s in sources])
    across = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = across.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        _RANGE,
        *group,
        *[
            F.coalesce(F.sum(f"__s_{s}").over(before), F.lit(0)).alias(f"__b_{s}")
            for s in sorted(set(totals.values()))
        ],
        *[F.sum(f"__s_{s}").over(across).alias(g) for g, s in grand.items()],
    )
    inside = (
        Window.partitionBy(_RANGE, *group)
        .orderBy(_LOCAL)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.withColumns({new: F.sum(s).over(inside) for new, s in totals.items()})
    joined = _attach(local, offsets, group)
    joined = joined.withColumns({new: F.col(new) + F.col(f"__b_{s}") for new, s in totals.items()})
    return joined.drop(_RANGE, _LOCAL, *[f"__b_{s}" for s in set(totals.values())])


def ntile_of(row_no: Column, total: Column, buckets: int) -> Column:
    """NTILE from a row number and the row count: the first ``total mod n`` buckets hold one more."""
    small = F.floor(total / F.lit(buckets))
    extra = total % buckets
    wide = extra * (small + 1)
    in_wide = F.floor((row_no - 1) / (small + 1)) + 1
    in_small = F.floor((row_no - 1 - extra) / F.nullif(small, F.lit(0).cast("long"))) + 1
    return F.when(row_no <= wide, in_wide).otherwise(in_small).cast("long")


def add_ntile(
    df: DataFrame, buckets: int, order: Sequence[Column | str], name: str
) -> DataFrame:
    """Add NTILE over the whole frame; ``order`` ends in a unique column."""
    numbered = number_rows(df, order, index="__rn", size="__all")
    return numbered.withColumn(name, ntile_of(F.col("__rn"), F.col("__all"), buckets)).drop(
        "__rn", "__all"
    )


def add_rank(
    df: DataFrame, value: str, unique: str, *, rank: str, size: str | None = None
) -> DataFrame:
    """Add rank() over (order by value) with ties sharing the smallest position.

    Rows are numbered on (value, unique). Ties are told apart per range, and a tie that spans
    ranges takes the position of its first row, so a value held by most rows costs one small row
    per range rather than one large group.
    """
    rows = _ranged(df, [], [value, unique])
    parts = rows.groupBy(_RANGE, value).agg(
        F.count(F.lit(1)).alias("__n"), F.min(_LOCAL).alias("__first")
    )
    per_range = parts.groupBy(_RANGE).agg(F.sum("__n").alias("__rows"))
    before = Window.partitionBy(F.lit(0)).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select(
        F.col(_RANGE),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
        F.sum("__rows").over(Window.partitionBy(F.lit(0))).alias("__all"),
    )
    first_seen = parts.join(F.broadcast(starts), _RANGE).select(
        _RANGE,
        value,
        F.min(F.col("__start") + F.col("__first"))
        .over(Window.partitionBy(value))
        .alias("__position"),
        "__all",
    )
    ranked = _attach(rows, first_seen, [value]).withColumn(rank, F.col("__position") + 1)
    if size is not None:
        ranked = ranked.withColumn(size, F.col("__all"))
    return ranked.drop(_RANGE, _LOCAL, "__position", "__all")
