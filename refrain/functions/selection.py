"""Exact quantile cuts of whole numbers by refining histograms, without sorting.

Each pass counts the rows of a narrow frame in a fixed number of bins around every cut that is
looked for, all of them in one aggregation, and goes on inside the bin that holds the cut. The
bins shrink by ``BINS`` each time, so a few passes find the value; ties on it are then cut by the
unique column in the same way. Rows never move, and what reaches the driver is at most ``BINS``
counts for each cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
SMALLEST = -(1 << 62)  # stands for a missing value, which comes first


@dataclass
class _Cut:
    """The row of a rank, searched for by its value first and then by its unique column."""

    column: str
    rank: int
    low: int
    high: int
    value: int | None = None
    unique: int | None = None

    @property
    def shift(self) -> int:
        return ((self.high - self.low) // BINS).bit_length()


def _whole(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(SMALLEST))


def quantile_cuts(df: DataFrame, columns: Sequence[str], unique: str, buckets: int) -> dict[str, list[tuple[int, int]]]:
    """For each column the (value, unique) of the last row of every NTILE bucket but the last.

    Columns hold whole numbers. ``df`` is read once per pass, so pass one that is cheap to read.
    """
    bounds = [f(_whole(c)).alias(f"{name}_{c}") for c in (*columns, unique) for name, f in (("lo", F.min), ("hi", F.max))]
    first = df.agg(F.count(F.lit(1)).alias("n"), *bounds).first()
    total = first["n"]
    if not total:
        return {c: [] for c in columns}
    small, extra = divmod(total, buckets)
    ranks = [min(total, k * small + min(k, extra)) for k in range(1, buckets)]
    cuts = [_Cut(c, rank, first[f"lo_{c}"], first[f"hi_{c}"]) for c in columns for rank in ranks]
    while searched := [(i, c) for i, c in enumerate(cuts) if c.unique is None]:
        marks = []
        for i, cut in searched:
            key = _whole(cut.column) if cut.value is None else _whole(unique)
            inside = key.between(cut.low, cut.high)
            inside = inside if cut.value is None else inside & (_whole(cut.column) == cut.value)
            place = F.shiftright(key - F.lit(cut.low), cut.shift)
            marks.append(F.when(inside, F.struct(F.lit(i).alias("cut"), place.alias("bin"))))
        counted = df.select(F.inline(F.filter(F.array(*marks), lambda m: m.isNotNull()))).groupBy("cut", "bin").agg(F.count(F.lit(1)).alias("n"))
        bins: dict[int, dict[int, int]] = {}
        for r in counted.collect():
            bins.setdefault(r["cut"], {})[r["bin"]] = r["n"]
        for i, cut in searched:
            shift = cut.shift
            for place, n in sorted(bins[i].items()):
                if cut.rank <= n:
                    break
                cut.rank -= n
            low = cut.low + (place << shift)
            cut.low, cut.high = low, min(cut.high, low + (1 << shift) - 1)
            if cut.low == cut.high:
                if cut.value is None:
                    cut.value, cut.low, cut.high = low, first[f"lo_{unique}"], first[f"hi_{unique}"]
                else:
                    cut.unique = low
    return {c: [(cut.value, cut.unique) for cut in cuts if cut.column == c] for c in columns}


def add_ntiles(df: DataFrame, columns: Mapping[str, str], unique: str, buckets: int) -> DataFrame:
    """Add NTILE over (column, unique) for each of ``columns = {new: column}`` of whole numbers."""
    cuts = quantile_cuts(df, list(columns.values()), unique, buckets)

    def tile(column: str) -> Column:
        value, other = _whole(column), _whole(unique)
        behind = [F.when((value > v) | ((value == v) & (other > u)), 1).otherwise(0) for v, u in cuts[column]]
        return sum(behind, F.lit(1)).cast("long")

    return df.withColumns({new: tile(column) for new, column in columns.items()})
