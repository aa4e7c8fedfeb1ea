"""Sentiment queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.operators import sentiment as S
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse
from refrain.sources.model import timed_sentiment


@query("tx_song_sentiment")
def song_sentiment(w: Warehouse) -> DataFrame:
    return w.song_sentiment


@query("tx_sentiment_summary")
def summary(w: Warehouse) -> DataFrame:
    return w.sentiment_summary


@query("io_latest_row")
def latest_row(w: Warehouse) -> DataFrame:
    """The most recent summary: one is built per month of activity, the newest is kept."""
    scored = timed_sentiment(w.comment, w.table("labels"))
    daily = scored.groupBy(F.to_date("comment_time").alias("update_time")).agg(
        F.count(F.lit(1)).alias("total_comments"),
        F.count_if(F.col("sentiment") == "positive").alias("positive_comments"),
    )
    return daily.orderBy(F.desc("update_time")).limit(1)


@query("fd_sentiment_summary")
def summary_row(w: Warehouse) -> DataFrame:
    return w.sentiment_summary.orderBy(F.desc("update_time")).limit(1)


@query("gd_sentiment_summary")
def summary_page(w: Warehouse) -> DataFrame:
    columns = ["positive_ratio", "neutral_ratio", "negative_ratio", "satisfaction_score"]
    return summary_row(w).select(*columns)


@query("fd_song_sentiment_avg")
def song_sentiment_means(w: Warehouse) -> DataFrame:
    return w.song_sentiment.agg(
        F.round(F.avg("positive") * 100, 1).alias("pos_pct"),
        F.round(F.avg("negative") * 100, 1).alias("neg_pct"),
        F.round(F.avg("neutral") * 100, 1).alias("neu_pct"),
        F.round(F.avg("satisfaction_score"), 2).alias("sat_score"),
    )


@query("gd_song_sentiment_map")
def sentiment_by_song(w: Warehouse) -> DataFrame:
    """Every song with its shares, missing where it has no scored comment."""
    return w.song.select("song_id").join(
        w.song_sentiment.select("song_id", "positive", "neutral", "negative"), "song_id", "left"
    )


@query("gd_song_sentiment15")
def best_songs(w: Warehouse) -> DataFrame:
    return (
        w.song_sentiment.join(w.song, "song_id")
        .select("song_id", "song_name", "positive", "neutral", "negative", "satisfaction_score")
        .orderBy(F.desc("satisfaction_score"), "song_id")
        .limit(15)
    )


@query("gd_sentiment_join")
def sentiment_join(w: Warehouse) -> DataFrame:
    return w.sentiment_facts


@query("gd_sentiment_weekly")
def weekly(w: Warehouse) -> DataFrame:
    return S.weekly_movement(w.timed_scores, w.song).orderBy("week")


@query("js_sentiment_cards")
def cards(w: Warehouse) -> DataFrame:
    """Total over the shown weeks and the unweighted means of their shares."""
    return S.weekly_movement(w.timed_scores, w.song).agg(
        F.sum("comment_count").alias("total_comments"),
        F.round(F.avg("positive_ratio") * 100, 1).alias("avg_positive_pct"),
        F.round(F.avg("negative_ratio") * 100, 1).alias("avg_negative_pct"),
        F.round(F.avg("avg_positive_prob") * 100, 1).alias("avg_prob_pct"),
    )


@query("gd_sentiment_shift")
def shift(w: Warehouse) -> DataFrame:
    return S.shift_per_song(w.timed_scores, w.song)


@query("gd_rising10")
def rising(w: Warehouse) -> DataFrame:
    return shift(w).orderBy(F.desc("change_rate"), "song_id").limit(10)


@query("gd_falling10")
def falling(w: Warehouse) -> DataFrame:
    """The last ten of the descending order, worst first; with few songs they overlap the risers."""
    return shift(w).orderBy("change_rate", F.desc("song_id")).limit(10)


@query("gd_shift_scatter")
def scatter(w: Warehouse) -> DataFrame:
    columns = ["song_id", "song_name", "early_positive_ratio", "recent_positive_ratio", "change_rate", "comment_count"]
    return shift(w).select(*columns)


@query("js_shift_band")
def shift_band(w: Warehouse) -> DataFrame:
    """Band of the change and the marker size, between 8 and 28."""
    rate = F.col("change_rate")
    band = (
        F.when(rate >= 20, "strong_rise").when(rate >= 0, "rise").when(rate >= -20, "fall").otherwise("strong_fall")
    )
    size = F.greatest(F.lit(8.0), F.least(F.lit(28.0), 8 + F.col("comment_count") / 8))
    return shift(w).select("song_id", "change_rate", band.alias("band"), size.alias("marker_size"))
