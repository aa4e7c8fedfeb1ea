"""User segmentation: RFM, portraits, cohorts, churn labels and clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.calendar import day_period, monday
from refrain.functions.numbers import money_sum, with_scaled_mean
from refrain.functions.selection import add_ntiles
from refrain.session import cut_lineage


def rfm_base(activity: DataFrame, as_of: Column) -> DataFrame:
    """Per user: days since the last action, distinct actions, amount.

    ``activity`` has user_id, action_id, moment, amount.
    """
    return activity.groupBy("user_id").agg(
        F.datediff(as_of, F.to_date(F.max("moment"))).cast("long").alias("recency"),
        F.countDistinct("action_id").alias("frequency"),
        money_sum("amount").alias("monetary"),
    )


def rfm_scores(base: DataFrame, *, literal_recency: bool = False) -> DataFrame:
    """Quartile scores 1..4 per dimension; ties are broken by user id. Users are never sorted.

    A nearer last action scores higher. ``literal_recency`` instead compares the days with one,
    two and three times the quartile number, a rule kept for users who depend on its output.
    """
    narrow = cut_lineage(base.withColumn("__cents", (F.col("monetary") * 100).cast("long")))
    scored = add_ntiles(narrow, {"r_quartile": "recency", "f_score": "frequency", "m_score": "__cents"}, "user_id", 4).drop("__cents")
    days, quartile = F.col("recency"), F.col("r_quartile")
    if literal_recency:
        score = (
            F.when(days <= quartile, 4).when(days <= quartile * 2, 3).when(days <= quartile * 3, 2).otherwise(1)
        ).cast("long")
    else:
        score = 5 - quartile
    return scored.withColumn("r_score", score).drop("r_quartile")


def rfm_segment() -> Column:
    """First rule that holds wins."""
    recent, loyal, valued = F.col("r_score") >= 3, F.col("f_score") >= 3, F.col("m_score") >= 3
    return (
        F.when(recent & loyal & valued, L.SEGMENT_HIGH_VALUE)
        .when(recent & ~loyal, L.SEGMENT_NEW)
        .when(~recent & loyal & valued, L.SEGMENT_AT_RISK)
        .when(~recent & ~loyal, L.SEGMENT_SILENT)
        .otherwise(L.SEGMENT_GROWING)
    )


def user_rfm(activity: DataFrame, as_of: Column, *, literal_recency: bool = False) -> DataFrame:
    scored = rfm_scores(rfm_base(activity, as_of), literal_recency=literal_recency)
    return scored.withColumn("rfm_label", rfm_segment())


def portrait(comment: DataFrame, sentiment: DataFrame) -> DataFrame:
    """One row per commenting user: totals, mean sentiment, favourite period, value and type.

    One aggregation: the favourite period comes from four counters instead of a second grouping.
    ``sentiment`` has doc_id, positive_prob.
    """
    periods = [F.count_if(day_period(F.col("comment_time")) == p) for p in L.DAY_PERIODS]
    totals = (
        comment.join(sentiment.select("doc_id", "positive_prob"), "doc_id", "left")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("comment_count_total"),
            F.sum("reply_count").alias("reply_count_total"),
            F.sum("like_count").alias("like_received_total"),
            F.round(F.avg("positive_prob"), 6).alias("avg_sentiment"),
            *[p.alias(f"__p{i}") for i, p in enumerate(periods)],
        )
    )
    totals = cut_lineage(totals)  # the bounds below are read from the users, not from the facts
    counters = [F.col(f"__p{i}") for i in range(len(periods))]
    most = F.greatest(*counters)
    favourite = F.coalesce(*[F.when(c == most, name) for c, name in zip(counters, L.DAY_PERIODS)])
    mood = (
        F.when(F.col("avg_sentiment") >= 0.6, L.USER_POSITIVE)
        .when(F.col("avg_sentiment") <= 0.4, L.USER_NEGATIVE)
        .otherwise(L.USER_NEUTRAL)
    )
    valued = with_scaled_mean(
        totals, ["comment_count_total", "reply_count_total", "like_received_total"], "user_value"
    )
    core, consumer, light = L.USER_TYPES
    kind = F.when(F.col("user_value") >= 0.6, core).when(F.col("user_value") >= 0.3, consumer).otherwise(light)
    return (
        valued.withColumns({"active_period": favourite, "sentiment_type": mood})
        .withColumn("user_type", kind)
        .drop(*[f"__p{i}" for i in range(len(periods))])
    )


def cohort_retention(activity: DataFrame) -> DataFrame:
    """Cohorts by week of first action: size, users active per week offset, retained share.

    The weeks of a user are folded into a set on the map side (bounded by the calendar), so the
    facts are shuffled once and a very active user costs one row.
    """
    weeks = (
        activity.filter(F.col("moment").isNotNull())
        .groupBy("user_id")
        .agg(F.collect_set(monday(F.to_date("moment"))).alias("weeks"))
        .select("user_id", F.array_min("weeks").alias("cohort_week"), F.explode("weeks").alias("week"))
    )
    offset = F.floor(F.datediff("week", "cohort_week") / 7).cast("long")
    counts = weeks.groupBy("cohort_week", offset.alias("week_offset")).agg(
        F.count(F.lit(1)).alias("active_users")
    )
    sizes = counts.filter(F.col("week_offset") == 0).select(
        "cohort_week", F.col("active_users").alias("cohort_size")
    )
    return counts.join(sizes, "cohort_week").select(
        "cohort_week",
        "cohort_size",
        "week_offset",
        "active_users",
        F.round(F.col("active_users") / F.col("cohort_size"), 6).alias("retention"),
    )


def churn_label(activity: DataFrame, as_of: Column, *, horizon: int = 90) -> DataFrame:
    """Label 1 for users seen up to ``horizon`` days before the last day but not after."""
    cutoff = F.date_sub(as_of, horizon)
    day = F.to_date("moment")
    return (
        activity.groupBy("user_id")
        .agg(
            F.max(F.when(day <= cutoff, day)).alias("last_before"),
            F.count_if(day > cutoff).alias("actions_after"),
        )
        .filter(F.col("last_before").isNotNull())
        .select(
            "user_id",
            F.datediff(cutoff, F.col("last_before")).cast("long").alias("recency_days"),
            F.when(F.col("actions_after") == 0, 1).otherwise(0).cast("long").alias("churned"),
        )
    )


def recency_risk(churn: DataFrame, *, half_life: int = 90) -> DataFrame:
    """Closed-form churn probability days / (days + half_life), for use before a model is trained."""
    days = F.col("recency_days").cast("double")
    return churn.withColumn("churn_prob", F.round(days / (days + half_life), 6))


def risk_level(probability: Column) -> Column:
    """Below 0.3 low, above 0.7 high, the edges belong to the middle."""
    low, middle, high = L.RISK_LEVELS
    return F.when(probability < 0.3, low).when(probability > 0.7, high).otherwise(middle)


def churn_risk(scored: DataFrame) -> DataFrame:
    return scored.withColumn("risk_level", risk_level(F.col("churn_prob")))
