"""Sentiment over labelled or scored comments: joins, weekly movement, shifts per song, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.calendar import monday
from refrain.functions.ordering import number_rows
from refrain.session import cut_lineage


def sentiment_facts(sentiment: DataFrame, comment: DataFrame, song: DataFrame) -> DataFrame:
    """Scored comments with song name and time (inner joins on comment and song)."""
    return (
        sentiment.join(comment.select("comment_id", "comment_time"), "comment_id")
        .join(song.select("song_id", "song_name"), "song_id")
        .select("song_id", "song_name", "comment_id", "positive_prob", "sentiment", "comment_time")
    )


def _share(sentiment: str) -> Column:
    return F.count_if(F.col("sentiment") == sentiment) / F.count(F.lit(1))


def timed_scores(scored: DataFrame) -> DataFrame:
    """Scored comments that have a time; the others are left out."""
    return scored.filter(F.col("comment_time").isNotNull())


def weekly_movement(timed: DataFrame, song: DataFrame, *, keep: int = 30) -> DataFrame:
    """Shares per Monday week, their velocity and acceleration; the last ``keep`` weeks.

    Anything that is neither positive nor negative counts as neutral, a missing probability as 0.
    Comments are folded to (week, song) before songs that are not in the dimension are taken out,
    so a hot song does not meet the join with its comments. (An inner join: the optimizer would
    push a semi join on the grouping key back down to the comments.) Differences are taken over the weeks
    that are present, before the cut to the last ones; the windows run over one row per week.
    """
    per_song = timed.groupBy(monday(F.to_date("comment_time")).alias("week"), "song_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("sentiment") == L.POSITIVE).alias("pos"),
        F.count_if(F.col("sentiment") == L.NEGATIVE).alias("neg"),
        F.sum(F.coalesce("positive_prob", F.lit(0.0))).alias("prob"),
    )
    total, positive, negative = F.sum("n"), F.sum("pos"), F.sum("neg")
    weeks = (
        per_song.join(song.select("song_id"), "song_id")
        .groupBy("week")
        .agg(
            (positive / total).alias("positive_ratio"),
            (negative / total).alias("negative_ratio"),
            ((total - positive - negative) / total).alias("neutral_ratio"),
            (F.sum("prob") / total).alias("avg_positive_prob"),
            total.alias("comment_count"),
        )
    )
    in_order = Window.partitionBy(F.lit(0)).orderBy("week")
    velocity = F.col("positive_ratio") - F.lag("positive_ratio").over(in_order)
    acceleration = F.col("__v") - F.lag("__v").over(in_order)
    latest = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("week")))
    moved = weeks.withColumn("__v", velocity).withColumns({"__a": acceleration, "__latest": latest})
    return moved.filter(F.col("__latest") <= keep).select(
        "week",
        *[
            F.round(c, 6).alias(c)
            for c in ("positive_ratio", "negative_ratio", "neutral_ratio", "avg_positive_prob")
        ],
        "comment_count",
        F.round(F.coalesce("__v", F.lit(0.0)), 6).alias("velocity"),
        F.round(F.coalesce("__a", F.lit(0.0)), 6).alias("acceleration"),
    )


def shift_per_song(
    timed: DataFrame, song: DataFrame, *, minimum: int = 10, share: float = 0.3
) -> DataFrame:
    """Early against recent positive share of every song with at least ``minimum`` comments.

    Comments are folded to song-days first. Running counts over the days of a song (bounded by the
    calendar) tell which days are early or recent as a whole, and which one or two the slices cut;
    only the comments of those days are ranked, in ranges, so a hot song or day is never sorted in
    one task. Names are joined to the one row per song that is left.
    """
    slim = timed.select(
        "song_id",
        F.to_date("comment_time").alias("__day"),
        "comment_id",
        "comment_time",
        F.coalesce(F.col("sentiment") == L.POSITIVE, F.lit(False)).cast("long").alias("__pos"),
        F.coalesce("positive_prob", F.lit(0.0)).alias("__prob"),
    )
    totals = slim.groupBy("song_id", "__day").agg(F.count(F.lit(1)).alias("__in_day"), F.sum("__pos").alias("__pos"), F.sum("__prob").alias("__prob"))
    days = Window.partitionBy("song_id").orderBy("__day")
    counted = totals.withColumns(
        {
            "__n": F.sum("__in_day").over(Window.partitionBy("song_id")),
            "__until": F.sum("__in_day").over(days.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    ).filter(F.col("__n") >= minimum)
    slice_size = F.greatest(F.lit(1).cast("long"), F.floor(F.col("__n") * F.lit(share)))
    # comments of the day that belong to a slice: 0 to all of them
    first = F.greatest(F.lit(0), F.least(F.col("__in_day"), slice_size - (F.col("__until") - F.col("__in_day"))))
    last = F.greatest(F.lit(0), F.least(F.col("__in_day"), slice_size - (F.col("__n") - F.col("__until"))))
    cut = cut_lineage(counted.withColumns({"__heads": first, "__tails": last}).filter("__heads > 0 or __tails > 0"))
    all_early, all_recent = F.col("__heads") == F.col("__in_day"), F.col("__tails") == F.col("__in_day")
    whole = cut.select(
        "song_id",
        F.col("__n"),
        F.when(all_early, F.col("__heads")).alias("early_n"),
        F.when(all_early, F.col("__pos")).alias("early_pos"),
        F.when(all_recent, F.col("__tails")).alias("recent_n"),
        F.when(all_recent, F.col("__pos")).alias("recent_pos"),
        F.when(all_recent, F.col("__prob")).alias("recent_prob"),
    )
    parted = cut.select(
        "song_id", "__day", "__n", "__in_day", F.when(all_early, 0).otherwise(F.col("__heads")).alias("__heads"), F.when(all_recent, 0).otherwise(F.col("__tails")).alias("__tails")
    ).filter("__heads > 0 or __tails > 0")
    ranked = number_rows(slim.join(parted, ["song_id", "__day"]), ["comment_time", "comment_id"], ["song_id", "__day"], index="__rn")
    is_early, is_recent = F.col("__rn") <= F.col("__heads"), F.col("__rn") > F.col("__in_day") - F.col("__tails")
    single = ranked.select(
        "song_id",
        F.col("__n"),
        F.when(is_early, F.lit(1).cast("long")).alias("early_n"),
        F.when(is_early, F.col("__pos")).alias("early_pos"),
        F.when(is_recent, F.lit(1).cast("long")).alias("recent_n"),
        F.when(is_recent, F.col("__pos")).alias("recent_pos"),
        F.when(is_recent, F.col("__prob")).alias("recent_prob"),
    )
    grouped = whole.unionByName(single).groupBy("song_id").agg(
        (F.sum("early_pos") / F.sum("early_n")).alias("early"),
        (F.sum("recent_pos") / F.sum("recent_n")).alias("recent"),
        (F.sum("recent_prob") / F.sum("recent_n")).alias("prob"),
        F.first("__n").alias("comment_count"),
    )
    change = (F.col("recent") - F.col("early")) * 100
    change = F.when(F.col("early") <= 1e-6, change).otherwise(
        F.try_divide(F.col("recent") - F.col("early"), F.col("early")) * 100
    )
    return grouped.join(song.select("song_id", "song_name"), "song_id").select(
        "song_id",
        "song_name",
        F.round("early", 6).alias("early_positive_ratio"),
        F.round("recent", 6).alias("recent_positive_ratio"),
        F.round(change, 6).alias("change_rate"),
        F.round("prob", 6).alias("recent_avg_prob"),
        "comment_count",
    )


def song_sentiment(sentiment: DataFrame) -> DataFrame:
    """Shares per song; satisfaction is the positive minus the negative share."""
    return sentiment.groupBy("song_id").agg(*_summary())


def _summary() -> list[Column]:
    positive, neutral, negative = (_share(s) for s in (L.POSITIVE, L.NEUTRAL, L.NEGATIVE))
    return [
        F.round(positive, 6).alias("positive"),
        F.round(neutral, 6).alias("neutral"),
        F.round(negative, 6).alias("negative"),
        F.round(positive - negative, 6).alias("satisfaction_score"),
        F.count(F.lit(1)).alias("total_comments"),
    ]


def sentiment_summary(sentiment: DataFrame, updated: Column) -> DataFrame:
    """One row: three-way shares, satisfaction, and the positive share among decided comments."""
    decided = F.try_divide(
        F.count_if(F.col("sentiment") == L.POSITIVE),
        F.count_if(F.col("sentiment").isin(L.POSITIVE, L.NEGATIVE)),
    )
    row = sentiment.agg(*_summary(), F.round(decided, 6).alias("positive_among_decided"))
    return row.select(
        F.col("positive").alias("positive_ratio"),
        F.col("neutral").alias("neutral_ratio"),
        F.col("negative").alias("negative_ratio"),
        "satisfaction_score",
        "positive_among_decided",
        "total_comments",
        updated.alias("update_time"),
    )
