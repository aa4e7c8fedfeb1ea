"""Exact ratios, sums and the scaling used by the metrics.

Counts and money are divided as decimals, the way the reports round them: a double carries
12.345 as 12.3449999..., and two engines then disagree on its second digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT_TYPE = "decimal(20,0)"
MONEY_TYPE = "decimal(18,2)"


def ratio(numerator: Column, denominator: Column, places: int, factor: int = 1) -> Column:
    """round(factor * numerator / denominator, places) on whole numbers; NULL for a zero divisor."""
    scaled = numerator.cast(COUNT_TYPE) * F.lit(factor)
    return F.round(F.try_divide(scaled, denominator.cast("decimal(18,0)")), places).cast("double")


def percent(numerator: Column, denominator: Column, places: int) -> Column:
    return ratio(numerator, denominator, places, factor=100)


def money_sum(column: Column | str) -> Column:
    """Sum of amounts with two decimals, independent of the order of the rows."""
    return F.sum(F.col(column).cast(MONEY_TYPE) if isinstance(column, str) else column.cast(MONEY_TYPE))


def micro(column: Column) -> Column:
    """A score of six decimals as a whole number of millionths, so that sums are exact."""
    return F.round(column * 1_000_000).cast("long")


def mean_of_scores(column: Column) -> Column:
    """Mean of six-decimal scores over a group, summed and rounded exactly to six decimals."""
    return ratio(F.sum(micro(column)), F.count(column) * 1_000_000, 6)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Min-max scaling to 0..1; 0 where all values are equal."""
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.0))


def with_scaled_mean(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Add the mean of the min-max scaled columns, six decimals.

    The bounds are one scalar struct that is attached once and dropped again, so the plan holds
    a single subquery however many columns there are.
    """
    fields = [F.min(c).cast("double").alias(f"lo_{c}") for c in columns]
    fields += [F.max(c).cast("double").alias(f"hi_{c}") for c in columns]
    box = df.agg(F.struct(*fields).alias("bounds")).scalar()
    parts = [
        min_max(F.col(c).cast("double"), F.col(f"__box.lo_{c}"), F.col(f"__box.hi_{c}")) for c in columns
    ]
    mean = F.round(sum(parts[1:], parts[0]) / F.lit(float(len(columns))), 6)
    return df.withColumn("__box", box).withColumn(name, mean).drop("__box")
