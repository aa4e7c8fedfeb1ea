"""Daily song metrics, ranks, lifecycle stages and time patterns.

Facts are always grouped to (day, song), (hour) ... before any window or join, so a song that
holds a third of all comments is folded on the map side and costs one row per day afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.calendar import season
from refrain.functions.numbers import micro, min_max, ratio
from refrain.functions.ordering import number_rows

HEAT_WEIGHTS = {"comment_count": 0.5, "like_total": 0.3, "reply_count": 0.2}


def song_daily(comment: DataFrame, weights: dict[str, float] = HEAT_WEIGHTS) -> DataFrame:
    """Per day and song: comments, likes, replies and a heat score in 0..1 (six decimals).

    heat = weighted mean of the per-day min-max scaled log counts. The daily bounds are a
    second aggregation over the same shuffled groups, joined back; there is one row per day.
    """
    daily = (
        comment.filter(F.col("comment_time").isNotNull())
        .groupBy(F.to_date("comment_time").alias("dt"), "song_id")
        .agg(
            F.count(F.lit(1)).alias("comment_count"),
            F.sum("like_count").alias("like_total"),
            F.sum("reply_count").alias("reply_count"),
        )
    )
    bounds = daily.groupBy("dt").agg(
        *[F.min(c).alias(f"lo_{c}") for c in weights], *[F.max(c).alias(f"hi_{c}") for c in weights]
    )
    heat = [
        F.lit(weight)
        * min_max(F.log1p(F.col(c)), F.log1p(F.col(f"lo_{c}")), F.log1p(F.col(f"hi_{c}")))
        for c, weight in weights.items()
    ]
    return daily.join(bounds, "dt").select(
        "dt",
        "song_id",
        "comment_count",
        "like_total",
        "reply_count",
        F.round(sum(heat[1:], heat[0]), 6).alias("heat_score"),
    )


def daily_rank(daily: DataFrame) -> DataFrame:
    """Position of every song within its day by heat; ties go to the smaller song id."""
    return number_rows(daily, [F.desc("heat_score"), "song_id"], ["dt"], index="heat_rank")


def daily_rank_with_ties(daily: DataFrame) -> DataFrame:
    """As ``daily_rank``, but equal heat shares the smallest position (RANK)."""
    ranked = daily_rank(daily)
    first = ranked.groupBy("dt", "heat_score").agg(F.min("heat_rank").alias("tied_rank"))
    return ranked.join(first, ["dt", "heat_score"]).withColumn("heat_rank", F.col("tied_rank")).drop("tied_rank")


def lifecycle_stage(
    daily: DataFrame, *, burst: float = 0.7, growth: float = 1.1, decline: float = 0.9, days: int = 7
) -> DataFrame:
    """Add the stage of each song-day: mean heat of the last ``days`` against the ``days`` before.

    The window runs over one row per day of a song, so its partitions are bounded by the calendar.
    """
    day_no = F.datediff("dt", F.lit("1970-01-01").cast("date"))
    by_day = Window.partitionBy("song_id").orderBy("__day")
    recent = by_day.rangeBetween(-(days - 1), 0)
    earlier = by_day.rangeBetween(-(2 * days - 1), -days)
    score = F.col("heat_score")
    change = F.round(F.try_divide(F.col("__recent"), F.col("__earlier")), 6)
    return (
        daily.withColumn("__day", day_no)
        .withColumns(
            {
                "__recent": mean_over(score, recent),
                "__earlier": mean_over(score, earlier),
            }
        )
        .withColumn("heat_change", change)
        .withColumn(
            "lifecycle_stage",
            F.when(score >= burst, L.STAGE_BURST)
            .when(F.col("heat_change") > growth, L.STAGE_GROWTH)
            .when(F.col("heat_change") < decline, L.STAGE_DECLINE)
            .otherwise(L.STAGE_STABLE),
        )
        .drop("__day", "__recent", "__earlier")
    )


def mean_over(score: Column, window) -> Column:
    """Mean of six-decimal scores over a window, summed exactly."""
    total = F.sum(micro(score)).over(window).cast("double")
    return total / (F.count(score).over(window).cast("double") * 1_000_000)


def song_rank(daily: DataFrame) -> DataFrame:
    """The rank table that the reports read: daily rank plus lifecycle stage."""
    return lifecycle_stage(daily_rank(daily)).select(
        "dt", "song_id", "heat_rank", "heat_score", "comment_count", "like_total", "lifecycle_stage"
    )


def hourly(comment: DataFrame, *, extremes: int = 3) -> DataFrame:
    """24 rows at most; the busiest and quietest hours are labelled."""
    grouped = (
        comment.filter(F.col("comment_time").isNotNull())
        .groupBy(F.hour("comment_time").cast("long").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("comment_count"),
            F.sum("reply_count").alias("reply_count"),
            F.sum("like_count").alias("like_total"),
            F.countDistinct("user_id").alias("user_count"),
        )
    )
    everything = Window.partitionBy(F.lit(0))  # over at most 24 rows
    busiest = F.row_number().over(everything.orderBy(F.desc("comment_count"), "hour"))
    quietest = F.row_number().over(everything.orderBy("comment_count", "hour"))
    label = F.when(busiest <= extremes, L.PEAK_HIGH).when(quietest <= extremes, L.PEAK_LOW)
    return grouped.withColumns(
        {
            "pct": ratio(F.col("comment_count"), F.sum("comment_count").over(everything), 4),
            "peak_label": label.otherwise(L.PEAK_NORMAL),
        }
    )


def weekday(comment: DataFrame) -> DataFrame:
    """One row per weekday, Monday = 0."""
    grouped = (
        comment.filter(F.col("comment_time").isNotNull())
        .groupBy(F.weekday("comment_time").cast("long").alias("weekday"))
        .agg(F.count(F.lit(1)).alias("comment_count"), F.countDistinct("user_id").alias("user_count"))
    )
    names = F.array(*[F.lit(n) for n in L.WEEKDAYS])
    total = F.sum("comment_count").over(Window.partitionBy(F.lit(0)))  # over at most 7 rows
    return grouped.select(
        "weekday",
        F.element_at(names, (F.col("weekday") + 1).cast("int")).alias("weekday_name"),
        "comment_count",
        "user_count",
        ratio(F.col("comment_count"), total, 4).alias("pct"),
        F.when(F.col("weekday") >= 5, 1).otherwise(0).cast("long").alias("is_weekend"),
    )


def monthly(facts: DataFrame, moment: str) -> DataFrame:
    """One row per calendar month with its season."""
    return (
        facts.filter(F.col(moment).isNotNull())
        .groupBy(F.month(moment).cast("long").alias("month"))
        .agg(F.count(F.lit(1)).alias("comment_count"))
        .withColumn("season", season(F.col("month")))
    )
