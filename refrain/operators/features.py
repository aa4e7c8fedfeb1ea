"""Item and user features, labels, and the forecast of item heat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions.numbers import mean_of_scores, money_sum, with_scaled_mean
from refrain.functions.ordering import add_rank
from refrain.session import cut_lineage

HOT_SHARE = 0.9

ITEM_FEATURES = [
    "total_comment_count",
    "total_reply_count",
    "total_like_total",
    "valid_comment_count",
    "negative_ratio",
    "positive_ratio",
    "avg_heat_score",
    "max_heat_score",
    "days_since_release",
    "release_year",
    "release_month",
    "artist_comment_count",
    "artist_reply_count",
    "artist_like_total",
    "topic_count",
    "like_per_comment",
    "reply_per_comment",
    "like_trend_slope",
    "comment_trend_slope",
    "heat_trend_slope",
    "heat_volatility",
]


def interactions(lineitem: DataFrame) -> DataFrame:
    """Long-range interactions per item: a line stands for a comment, its quantity for likes,
    a returned line for a reply and a negative voice, an accepted one for a positive voice."""
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.col("l_partkey").alias("song_id"),
        F.to_date("l_shipdate").alias("dt"),
        F.col("l_quantity").cast("long").alias("likes"),
        (flag == "R").cast("int").alias("negative"),
        (flag == "A").cast("int").alias("positive"),
        (F.col("l_linestatus") == "F").cast("int").alias("valid"),
        F.expr("shiftleft(1, l_linenumber)").alias("topic_bit"),
        F.col("l_extendedprice").alias("amount"),
    )


def _log_heat() -> Column:
    """Heat of one month of an item, not scaled."""
    return F.round(
        0.5 * F.log1p("comments") + 0.3 * F.log1p("likes") + 0.2 * F.log1p("replies"), 6
    )


def song_features(facts: DataFrame, song: DataFrame, as_of: Column) -> DataFrame:
    """21 features per item with interactions.

    The facts are dealt out by item once, as narrow as they are, and folded to item-months and items
    where they then lie: an item has few facts in a month, so folding them first would shuffle nearly
    as many and wider rows, twice. Artist totals are summed from the item rows and joined back.
    """
    narrow = facts.select("song_id", "dt", "likes", "negative", "positive", "valid", "topic_bit").repartition("song_id")
    monthly = narrow.groupBy(
        "song_id", (F.year("dt") * 12 + F.month("dt")).cast("long").alias("month_no")
    ).agg(
        F.count(F.lit(1)).alias("comments"),
        F.sum("likes").alias("likes"),
        F.sum("negative").alias("replies"),
        F.sum("positive").alias("positives"),
        F.sum("valid").alias("valid"),
        F.min("dt").alias("first_day"),
        F.bit_or("topic_bit").alias("topics"),
    )
    month = F.col("month_no").cast("double")

    def slope(column: str) -> Column:
        return F.round(F.regr_slope(F.col(column).cast("double"), month), 6)

    items = cut_lineage(  # read twice below: one row per item instead of the facts
        monthly.withColumn("heat", _log_heat())
        .groupBy("song_id")
        .agg(
            F.sum("comments").alias("total_comment_count"),
            F.sum("replies").alias("total_reply_count"),
            F.sum("likes").alias("total_like_total"),
            F.sum("valid").alias("valid_comment_count"),
            F.sum("positives").alias("__positives"),
            mean_of_scores(F.col("heat")).alias("avg_heat_score"),
            F.max("heat").alias("max_heat_score"),
            F.min("first_day").alias("__first"),
            F.bit_count(F.bit_or("topics")).cast("long").alias("topic_count"),
            slope("likes").alias("like_trend_slope"),
            slope("comments").alias("comment_trend_slope"),
            slope("heat").alias("heat_trend_slope"),
            F.round(F.try_divide(F.stddev_samp("heat"), F.avg("heat")), 6).alias("heat_volatility"),
        )
        .join(song.select("song_id", "artist_id"), "song_id")
    )
    artist = items.groupBy("artist_id").agg(
        F.sum("total_comment_count").alias("artist_comment_count"),
        F.sum("total_reply_count").alias("artist_reply_count"),
        F.sum("total_like_total").alias("artist_like_total"),
    )
    n = F.col("total_comment_count")
    return items.join(artist, "artist_id").select(
        "song_id",
        *[
            {
                "negative_ratio": F.round(F.col("total_reply_count") / n, 6),
                "positive_ratio": F.round(F.col("__positives") / n, 6),
                "days_since_release": F.datediff(as_of, F.col("__first")).cast("long"),
                "release_year": F.year("__first").cast("long"),
                "release_month": F.month("__first").cast("long"),
                "like_per_comment": F.round(F.col("total_like_total") / n, 6),
                "reply_per_comment": F.round(F.col("total_reply_count") / n, 6),
            }.get(name, F.col(name)).alias(name)
            for name in ITEM_FEATURES
        ],
    )


def hot_label(facts: DataFrame, *, share: float = HOT_SHARE) -> DataFrame:
    """Composite heat per item, its percent rank and the label of the hottest items.

    The composite is the mean of the scaled log counts of lines, likes and money.
    """
    totals = cut_lineage(  # read for the bounds, for the ranges and for the ranks: one row per item instead of the facts
        facts.groupBy("song_id").agg(
            F.log1p(F.count(F.lit(1))).alias("a"),
            F.log1p(F.sum("likes")).alias("b"),
            F.log1p(money_sum("amount").cast("double")).alias("c"),
        )
    )
    scored = with_scaled_mean(totals, ["a", "b", "c"], "composite").select("song_id", "composite")
    ranked = add_rank(scored, "composite", "song_id", rank="__rank", size="__n")
    place = F.coalesce(F.try_divide(F.col("__rank") - 1, F.col("__n") - 1), F.lit(0.0))
    return ranked.select(
        "song_id",
        "composite",
        F.round(place, 6).alias("hot_prob"),
        F.when(place >= share, 1).otherwise(0).cast("long").alias("is_hot"),
    )


def flag_hot(scored: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    flag = F.when(F.col("hot_prob") >= threshold, 1).otherwise(0).cast("long")
    return scored.withColumn("is_hot_predicted", flag)


USER_FEATURES = [
    "frequency",
    "monetary",
    "recency_days",
    "tenure_days",
    "mean_amount",
    "recent_90",
    "recent_180",
    "recent_365",
    "active_months",
]


def user_features(activity: DataFrame, as_of: Column, *, horizon: int = 90) -> DataFrame:
    """Features of every user from the actions up to the cutoff, and the churn label after it."""
    cutoff = F.date_sub(as_of, horizon)
    day = F.to_date("moment")
    before = day <= cutoff

    def within(days: int) -> Column:
        return F.count_if(before & (day > F.date_sub(cutoff, days)))

    grouped = activity.groupBy("user_id").agg(
        F.count_if(before).alias("frequency"),
        F.sum(F.when(before, F.col("amount").cast("decimal(18,2)"))).cast("double").alias("monetary"),
        F.datediff(cutoff, F.max(F.when(before, day))).cast("long").alias("recency_days"),
        F.datediff(cutoff, F.min(F.when(before, day))).cast("long").alias("tenure_days"),
        within(90).alias("recent_90"),
        within(180).alias("recent_180"),
        within(365).alias("recent_365"),
        # A set bounded by the calendar folds on the map side; a distinct count would shuffle twice.
        F.size(F.collect_set(F.when(before, F.trunc(day, "month")))).alias("active_months"),
        F.when(F.count_if(~before) == 0, 1).otherwise(0).cast("long").alias("label"),
    )
    known = grouped.filter(F.col("frequency") > 0)
    return known.withColumn("mean_amount", F.col("monetary") / F.col("frequency"))


def forecastable(daily: DataFrame, *, minimum: int = 14) -> DataFrame:
    """(song_id) of the series that are long enough for a forecast."""
    return daily.groupBy("song_id").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= minimum).select("song_id")


def forecast(daily: DataFrame, *, horizon: int = 30, minimum: int = 14) -> DataFrame:
    """Daily heat per item for the next days: linear trend plus mean residual of the weekday.

    Bounds are 1.96 residual deviations, heat is never negative. The item-days are shuffled once
    by item; the trend, the weekday means and the spread are windows over that partitioning,
    whose partitions are bounded by the days of the series.
    """
    item = Window.partitionBy("song_id")
    by_weekday = Window.partitionBy("song_id", "wd")
    day_no = F.datediff("dt", F.lit("1970-01-01").cast("date")).cast("double")
    series = (
        daily.select("song_id", "dt", "heat_score")
        .repartition("song_id")
        .withColumns({"x": day_no, "wd": F.weekday("dt")})
        .withColumns(
            {
                "n": F.count(F.lit(1)).over(item),
                "start": F.min("x").over(item),
            }
        )
        .filter(F.col("n") >= minimum)
        .withColumn("x", F.col("x") - F.col("start"))
        .withColumns(
            {
                "slope": F.regr_slope("heat_score", "x").over(item),
                "base": F.regr_intercept("heat_score", "x").over(item),
            }
        )
        .withColumn("gap", F.col("heat_score") - (F.col("base") + F.col("slope") * F.col("x")))
        .withColumn("season", F.avg("gap").over(by_weekday))
    )
    models = series.groupBy("song_id").agg(
        F.max("dt").alias("last"),
        F.max("x").alias("last_x"),
        F.first("slope").alias("slope"),
        F.first("base").alias("base"),
        F.stddev_samp(F.col("gap") - F.col("season")).alias("sd"),
        F.map_from_entries(F.collect_set(F.struct("wd", "season"))).alias("seasons"),
    )
    ahead = models.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    target = F.date_add("last", F.col("h"))
    season = F.coalesce(F.try_element_at("seasons", F.weekday(target)), F.lit(0.0))
    level = F.col("base") + F.col("slope") * (F.col("last_x") + F.col("h")) + season
    zero = F.lit(0.0)
    return ahead.select("song_id", target.alias("forecast_date"), level.alias("y"), "sd").select(
        "song_id",
        "forecast_date",
        F.round(F.greatest("y", zero), 6).alias("heat_score"),
        F.round(F.greatest(F.col("y") - 1.96 * F.col("sd"), zero), 6).alias("heat_score_lower"),
        F.round(F.greatest(F.col("y") + 1.96 * F.col("sd"), zero), 6).alias("heat_score_upper"),
    )
