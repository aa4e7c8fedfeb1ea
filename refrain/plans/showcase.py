"""The five end-to-end analyses: ranking, segmentation, growth, funnel, artist matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.calendar import since, year_week
from refrain.functions.numbers import percent, ratio
from refrain.operators import daily, segments
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse


def heat_ranking(ranked: DataFrame, song: DataFrame, *, top: int = 10) -> DataFrame:
    """Top songs per day with the change against the previous present day of each song.

    The previous rank is looked up before the cut to ``top``: a song may have come from below it.
    The window holds one row per day of a song.
    """
    per_song = Window.partitionBy("song_id").orderBy("dt")
    change = F.col("heat_rank") - F.col("prev_rank")
    return (
        ranked.join(song.select("song_id", "song_name"), "song_id")
        .withColumn("prev_rank", F.lag("heat_rank", 1).over(per_song))
        .filter(F.col("heat_rank") <= top)
        .select(
            "dt",
            "song_id",
            "song_name",
            "comment_count",
            "like_total",
            "heat_score",
            "heat_rank",
            "prev_rank",
            change.alias("rank_change"),
            F.when(change < 0, L.TREND_UP)
            .when(change > 0, L.TREND_DOWN)
            .otherwise(L.TREND_FLAT)
            .alias("rank_trend"),
        )
        .orderBy(F.desc("dt"), "heat_rank", "song_id")
    )


def recent_daily(w: Warehouse, days: int = 7) -> DataFrame:
    """Song-days of the last days; comments are cut to them before anything is aggregated.

    Unknown songs are taken out of the song-days by an inner join; a semi join would be pushed
    down to the comments, where a hot song is a hot key.
    """
    comment = w.comment.filter(since(F.col("comment_time"), w.comment_day, days))
    return daily.song_daily(comment).join(w.song.select("song_id"), "song_id")


@query("sq1_daily_heat_rank")
def sq1(w: Warehouse) -> DataFrame:
    return heat_ranking(daily.daily_rank(recent_daily(w)), w.song)


@query("sq1_daily_heat_rank_ties")
def sq1_ties(w: Warehouse) -> DataFrame:
    return heat_ranking(daily.daily_rank_with_ties(recent_daily(w)), w.song)


def segment_report(rfm: DataFrame) -> DataFrame:
    """Users, share and means per segment, from one aggregation."""
    groups = rfm.groupBy(F.col("rfm_label").alias("user_segment")).agg(
        F.count(F.lit(1)).alias("user_count"),
        F.sum("frequency").alias("__f"),
        F.sum("monetary").cast("decimal(24,2)").alias("__m"),
        F.sum("recency").alias("__r"),
    )
    count = F.col("user_count")
    all_users = F.sum("user_count").over(Window.partitionBy(F.lit(0)))  # over at most five rows
    money = F.round(F.try_divide(F.col("__m"), count.cast("decimal(12,0)")), 2).cast("double")
    return groups.select(
        "user_segment",
        "user_count",
        percent(count, all_users, 2).alias("pct"),
        ratio(F.col("__f"), count, 2).alias("avg_frequency"),
        money.alias("avg_monetary"),
        ratio(F.col("__r"), count, 1).alias("avg_recency"),
    ).orderBy(F.desc("user_count"), "user_segment")


@query("sq2_rfm_segments")
def sq2(w: Warehouse) -> DataFrame:
    return segment_report(w.user_rfm)


@query("rfm_r_literal")
def sq2_literal(w: Warehouse) -> DataFrame:
    rfm = segments.user_rfm(w.purchases, w.order_day, literal_recency=True)
    return segment_report(rfm)


def weekly_growth(comment: DataFrame) -> DataFrame:
    """Per song and week: comments, running total, the previous present week and the growth."""
    per_song = Window.partitionBy("song_id").orderBy("year_week")
    weekly = comment.groupBy(
        year_week(F.to_date("comment_time")).alias("year_week"), "song_id"
    ).agg(F.count(F.lit(1)).alias("weekly_comments"))
    now, before = F.col("weekly_comments"), F.col("prev_week_comments")
    return weekly.withColumns(
        {
            "cumulative_comments": F.sum("weekly_comments").over(per_song),
            "prev_week_comments": F.lag("weekly_comments", 1).over(per_song),
        }
    ).withColumns(
        {
            "growth_pct": percent(now - before, F.nullif(before, F.lit(0).cast("long")), 2),
            "growth_state": F.when(now * 10 > before * 11, L.GROWTH_FASTER)
            .when(now * 10 < before * 9, L.GROWTH_SLOWER)
            .otherwise(L.GROWTH_STEADY),
        }
    )


@query("sq3_weekly_growth")
def sq3(w: Warehouse) -> DataFrame:
    recent = w.comment.filter(since(F.col("comment_time"), w.comment_day, 30))
    return (
        weekly_growth(recent)
        .filter(F.col("prev_week_comments").isNotNull())
        .join(w.song, "song_id")
        .select(
            "year_week",
            "song_id",
            "song_name",
            "artist_name",
            "weekly_comments",
            "cumulative_comments",
            "prev_week_comments",
            "growth_pct",
            "growth_state",
        )
        .orderBy(F.desc("year_week"), F.desc("weekly_comments"), "song_id")
        .limit(20)
    )


def funnel_counts(comment: DataFrame) -> DataFrame:
    """One row; ``comment`` carries content_length."""
    likes = F.col("like_count")
    return comment.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(likes > 0).alias("liked"),
        F.count_if(likes >= 10).alias("high"),
        F.count_if(likes >= 100).alias("viral"),
        F.count_if((F.col("content_length") > 50) & (likes > 0)).alias("quality"),
    )


def _funnel_steps() -> list[tuple[str, str, Column, str]]:
    full = F.lit(100.0)
    return [
        (L.FUNNEL_LEVELS[0], "total", full, ""),
        (L.FUNNEL_LEVELS[1], "liked", percent(F.col("liked"), F.col("total"), 2), L.FUNNEL_DOWN),
        (L.FUNNEL_LEVELS[2], "high", percent(F.col("high"), F.col("liked"), 2), L.FUNNEL_DOWN),
        (L.FUNNEL_LEVELS[3], "viral", percent(F.col("viral"), F.col("high"), 2), L.FUNNEL_DOWN),
        (L.FUNNEL_LEVELS[4], "quality", percent(F.col("quality"), F.col("total"), 2), L.FUNNEL_SIDE),
    ]


@query("sq4_interaction_funnel")
def sq4(w: Warehouse) -> DataFrame:
    """One scan, one aggregation, then the single row is unfolded into the five levels."""
    rows = [
        F.struct(
            F.lit(level).alias("funnel_level"),
            F.col(column).alias("comment_count"),
            rate.alias("conversion_rate"),
            F.lit(mark).alias("trend"),
        )
        for level, column, rate, mark in _funnel_steps()
    ]
    return funnel_counts(w.comment_lengths).select(F.inline(F.array(*rows)))


@query("set_union_all")
def union_all(w: Warehouse) -> DataFrame:
    """The same funnel stated as UNION ALL of five reads of the one-row aggregate."""
    counts = funnel_counts(w.comment_lengths)
    levels = [
        counts.select(
            F.lit(level).alias("funnel_level"),
            F.col(column).alias("comment_count"),
            rate.alias("conversion_rate"),
            F.lit(mark).alias("trend"),
        )
        for level, column, rate, mark in _funnel_steps()
    ]
    united = levels[0]
    for level in levels[1:]:
        united = united.unionByName(level)
    return united


def artist_matrix(
    comment: DataFrame,
    song: DataFrame,
    *,
    more_than: int,
    approximate: bool = False,
    collation: str | None = None,
    top: int | None = 15,
) -> DataFrame:
    """Interaction profile per artist. Shares divide row counts by distinct comments.

    Names are told apart byte by byte; a collation such as UNICODE_CI_AI groups those that differ
    in case or accents only.

    The distinct counts expand the rows by (artist, comment) and (artist, user), so an artist
    with most of the comments is spread over many tasks before the per-artist merge.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    length, likes = F.col("content_length"), F.col("like_count")
    name = F.collate("artist_name", collation) if collation else F.col("artist_name")
    grouped = (
        comment.join(song.select("song_id", name.alias("artist_name")), "song_id")
        .groupBy("artist_name")
        .agg(
            distinct("comment_id").alias("comment_count"),
            distinct("user_id").alias("user_count"),
            F.sum(likes).alias("like_total"),
            F.count(likes).alias("__likes"),
            F.count_if(length <= 5).alias("short_count"),
            F.count_if(length >= 50).alias("deep_count"),
            F.count_if(likes >= 100).alias("viral_count"),
        )
        .filter(F.col("comment_count") > more_than)
    )
    n = F.col("comment_count")
    profile = (
        grouped.select(
            "artist_name",
            "comment_count",
            "user_count",
            "like_total",
            ratio(F.col("like_total"), F.col("__likes"), 1).alias("avg_likes"),
            ratio(F.col("like_total"), n, 1).alias("interaction_depth"),
            ratio(n, F.col("user_count"), 2).alias("comments_per_user"),
            "short_count",
            percent(F.col("short_count"), n, 1).alias("short_pct"),
            "deep_count",
            percent(F.col("deep_count"), n, 1).alias("deep_pct"),
            "viral_count",
            percent(F.col("viral_count"), n, 2).alias("viral_pct"),
        )
        .orderBy(F.desc("interaction_depth"), "artist_name")
    )
    return profile if top is None else profile.limit(top)


ARTIST_MATRIX_MINIMUM = 100


@query("sq5_artist_matrix")
def sq5(w: Warehouse) -> DataFrame:
    return artist_matrix(w.comment_lengths, w.song, more_than=ARTIST_MATRIX_MINIMUM)


@query("sq5_artist_matrix_approx")
def sq5_approx(w: Warehouse) -> DataFrame:
    return artist_matrix(w.comment_lengths, w.song, more_than=ARTIST_MATRIX_MINIMUM, approximate=True)
