"""Calendar expressions. No wall clock: the day to report on is a parameter of the warehouse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refrain.functions import labels


def since(moment: Column, day: Column, days: int) -> Column:
    """``moment`` is on or after the day ``days`` before ``day``; bare column, so it is pushed to the scan."""
    return moment >= F.date_sub(day, days).cast("timestamp_ntz")


def monday(day: Column) -> Column:
    """First day of the Monday-based week."""
    return F.date_sub(day, F.weekday(day))


def year_week(day: Column) -> Column:
    """YYYYWW with weeks that start on Sunday; week 1 holds the first Sunday of the year."""
    sunday = F.date_sub(day, F.dayofweek(day) - 1)
    return (F.year(sunday) * 100 + F.ceil(F.dayofyear(sunday) / 7)).cast("long")


def day_period(moment: Column) -> Column:
    """Four periods of the day; a missing time counts as the last one."""
    hour = F.hour(moment)
    night, morning, afternoon, evening = labels.DAY_PERIODS
    return (
        F.when(hour < 6, night).when(hour < 12, morning).when(hour < 18, afternoon).otherwise(evening)
    )


def season(month: Column) -> Column:
    spring, summer, autumn, winter = labels.SEASONS
    return (
        F.when(month.between(3, 5), spring)
        .when(month.between(6, 8), summer)
        .when(month.between(9, 11), autumn)
        .otherwise(winter)
    )
