"""The result bundle behind the report pages: counts, trends, songs, users, sentiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.calendar import day_period, since
from refrain.functions.numbers import mean_of_scores, percent, ratio
from refrain.operators import daily
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse


def one_row(w: Warehouse, **values: Column) -> DataFrame:
    """A single row of scalar subqueries."""
    return w.spark.range(1).select(*[c.alias(n) for n, c in values.items()])


def count_of(frame: DataFrame) -> Column:
    return frame.agg(F.count(F.lit(1)).alias("n")).scalar()


# Counts and rates --------------------------------------------------------------------------


@query("fd_core_counts")
def core_counts(w: Warehouse) -> DataFrame:
    return one_row(
        w,
        song_count=count_of(w.song),
        user_count=count_of(w.user),
        comment_count=count_of(w.table("events")),
        artist_count=count_of(w.artist),
    )


@query("gd_counts")
def page_counts(w: Warehouse) -> DataFrame:
    comments = count_of(w.table("events"))
    return one_row(
        w,
        count_users=count_of(w.user),
        count_songs=count_of(w.song),
        count_comments=comments,
        count_artists=count_of(w.artist),
        total_comments=comments,
    )


@query("fd_interaction_rate")
def interaction_rate(w: Warehouse) -> DataFrame:
    """Likes and replies per hundred comments."""
    totals = w.comment.agg(
        F.coalesce(F.sum("like_count"), F.lit(0)).alias("total_likes"),
        F.coalesce(F.sum("reply_count"), F.lit(0)).alias("total_replies"),
        F.greatest(F.count(F.lit(1)), F.lit(1).cast("long")).alias("__n"),
    )
    touched = F.col("total_likes") + F.col("total_replies")
    return totals.select(
        "total_likes", "total_replies", percent(touched, F.col("__n"), 2).alias("interaction_rate")
    )


@query("gd_like_rate")
def like_rate(w: Warehouse) -> DataFrame:
    """Likes per comment as a fraction; replies do not count here."""
    totals = w.comment.agg(
        F.coalesce(F.sum("like_count"), F.lit(0)).alias("total_likes"), F.count(F.lit(1)).alias("__n")
    )
    rate = F.coalesce(F.try_divide(F.col("total_likes"), F.col("__n")), F.lit(0.0))
    return totals.select("total_likes", F.round(rate, 6).alias("interaction_rate"))


# Trends ------------------------------------------------------------------------------------


@query("fd_trend_30d")
def trend_counts(w: Warehouse) -> DataFrame:
    """Comments per day in the 30 days up to the last comment (compared as moments, not days)."""
    last = w.table("events").agg(F.max("ts").alias("last")).scalar()
    recent = w.comment.filter(F.col("comment_time") >= last - F.expr("interval 30 days"))
    days = recent.groupBy(F.to_date("comment_time").alias("d")).agg(F.count(F.lit(1)).alias("c"))
    return days.orderBy("d")


@query("gd_trend_30d_heat")
def trend_heat(w: Warehouse) -> DataFrame:
    # the bounds of the heat are those of the day, so days that are not shown need not be read
    recent = daily.song_daily(w.comment.filter(since(F.col("comment_time"), w.comment_day, 30)))
    heat = F.sum(F.round(F.col("heat_score") * 1_000_000).cast("long")) / 1_000_000
    return (
        recent.groupBy("dt")
        .agg(
            heat.alias("total_heat"),
            F.sum("comment_count").alias("total_comment"),
            F.sum("reply_count").alias("total_reply"),
        )
        .orderBy("dt")
    )


@query("gd_heatmap")
def heatmap(w: Warehouse) -> DataFrame:
    """Weekday by hour counts of the last 30 days, all 168 cells, with the largest cell (at least 1)."""
    recent = w.comment.filter(since(F.col("comment_time"), w.comment_day, 30))
    counts = recent.groupBy(
        F.weekday("comment_time").cast("long").alias("weekday"),
        F.hour("comment_time").cast("long").alias("hour"),
    ).agg(F.count(F.lit(1)).alias("n"))
    cells = w.spark.range(7 * 24, numPartitions=1).select(
        F.floor(F.col("id") / 24).alias("weekday"), (F.col("id") % 24).alias("hour")
    )
    names = F.array(*[F.lit(n) for n in L.WEEKDAYS])
    dense = cells.join(counts, ["weekday", "hour"], "left").select(
        "weekday",
        F.element_at(names, (F.col("weekday") + 1).cast("int")).alias("weekday_name"),
        "hour",
        F.coalesce("n", F.lit(0).cast("long")).alias("comment_count"),
    )
    largest = F.max("comment_count").over(Window.partitionBy(F.lit(0)))  # over 168 rows
    return dense.withColumn("max_count", F.greatest(largest, F.lit(1).cast("long")))


@query("gd_day_period")
def period_counts(w: Warehouse) -> DataFrame:
    return w.comment.groupBy(day_period(F.col("comment_time")).alias("time_period")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


@query("js_period_dense")
def period_dense(w: Warehouse) -> DataFrame:
    """All four periods in their fixed order, missing ones as 0."""
    fixed = w.spark.range(1).select(
        F.posexplode(F.array(*[F.lit(p) for p in L.DAY_PERIODS])).alias("position", "time_period")
    )
    return (
        fixed.join(period_counts(w), "time_period", "left")
        .select(
            F.col("position").cast("long").alias("position"),
            "time_period",
            F.coalesce("cnt", F.lit(0).cast("long")).alias("cnt"),
        )
        .orderBy("position")
    )


@query("fd_hourly")
def hourly_short(w: Warehouse) -> DataFrame:
    return w.hourly.select("hour", "comment_count", "user_count", "pct").orderBy("hour")


@query("gd_hourly")
def hourly_page(w: Warehouse) -> DataFrame:
    columns = ["hour", "comment_count", "reply_count", "like_total", "peak_label"]
    return w.hourly.select(*columns).orderBy("hour")


@query("fd_weekday")
def weekday_short(w: Warehouse) -> DataFrame:
    columns = ["weekday", "weekday_name", "comment_count", "user_count", "pct"]
    return w.weekday.select(*columns).orderBy("weekday")


@query("gd_weekday")
def weekday_page(w: Warehouse) -> DataFrame:
    return w.weekday.select("weekday", "weekday_name", "comment_count", "is_weekend").orderBy("weekday")


@query("gd_monthly")
def monthly_page(w: Warehouse) -> DataFrame:
    return w.monthly.orderBy("month")


@query("gd_peak_hour")
def peak_hour(w: Warehouse) -> DataFrame:
    """Busiest hour as HH:00, the smallest hour among equals, '-' without data."""
    best = F.max_by("hour", F.struct(F.col("comment_count"), -F.col("hour")))
    return w.hourly.agg(best.alias("hour")).select(
        F.when(F.col("hour").isNull(), "-")
        .otherwise(F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00")))
        .alias("peak_hour")
    )


# Songs -------------------------------------------------------------------------------------


@query("fd_hot_songs")
def hot_songs(w: Warehouse) -> DataFrame:
    """Hottest song-days over all dates."""
    columns = ["dt", "song_id", "heat_rank", "heat_score", "comment_count", "like_total", "lifecycle_stage"]
    return (
        w.song_rank.join(w.song, "song_id")
        .select(*columns, "song_name", "artist_name")
        .orderBy(F.desc("heat_score"), "dt", "song_id")
        .limit(10)
    )


@query("gd_song_top5")
def song_top5(w: Warehouse) -> DataFrame:
    means = w.song_daily.groupBy("song_id").agg(mean_of_scores(F.col("heat_score")).alias("heat"))
    named = means.join(w.song.select("song_id", F.col("song_name").alias("name")), "song_id")
    return named.select("song_id", "name", "heat").orderBy(F.desc("heat"), "song_id").limit(5)


@query("fd_lifecycle_dist")
def lifecycle_distribution(w: Warehouse) -> DataFrame:
    """Song-days per stage; the stage needs no rank, so days are not ranked."""
    return daily.lifecycle_stage(w.song_daily).groupBy("lifecycle_stage").agg(F.count(F.lit(1)).alias("cnt"))


@query("gd_song_list")
def song_list(w: Warehouse) -> DataFrame:
    """All songs with artist and number of comments (0 kept); comments are counted before the join."""
    counts = w.comment.groupBy("song_id").agg(F.count("comment_id").alias("n"))
    return (
        w.song.select("song_id", "song_name", "artist_id")
        .join(w.artist, "artist_id", "left")
        .join(counts, "song_id", "left")
        .select(
            "song_id",
            "song_name",
            "artist_name",
            F.coalesce("n", F.lit(0).cast("long")).alias("comment_count"),
        )
        .orderBy(F.desc("comment_count"), "song_id")
    )


def lifecycle_series(song_daily: DataFrame) -> DataFrame:
    """One row per song with its days in order; the array is bounded by the calendar."""
    point = F.struct("dt", "heat_score", "comment_count", "reply_count")
    return song_daily.groupBy("song_id").agg(F.array_sort(F.collect_list(point)).alias("lifecycle"))


@query("gd_lifecycle_series")
def lifecycle_page(w: Warehouse) -> DataFrame:
    flat = lifecycle_series(w.song_daily).select("song_id", F.posexplode("lifecycle").alias("pos", "point"))
    return flat.select("song_id", F.col("pos").cast("long").alias("day_index"), "point.*")


def top_comments(comment: DataFrame, *, per_song: int = 10) -> DataFrame:
    """Best comments per song. Each task keeps its own best rows before the shuffle, so a hot
    song sends at most ``per_song`` rows per task."""
    best = Window.partitionBy("song_id").orderBy(
        F.desc("like_count"), F.desc("comment_time"), "comment_id"
    )
    return comment.withColumn("position", F.row_number().over(best)).filter(
        F.col("position") <= per_song
    )


@query("gd_top_comments10")
def top_comments_page(w: Warehouse) -> DataFrame:
    """The texts are joined to the selected comments only."""
    text = w.table("documents").select("doc_id", F.col("text").alias("content"))
    return (
        top_comments(w.comment)
        .join(text, "doc_id")
        .select(
            "song_id",
            F.col("position").cast("long").alias("position"),
            "comment_id",
            "content",
            "like_count",
            "comment_time",
        )
    )


@query("fd_top_artists")
def top_artists(w: Warehouse) -> DataFrame:
    return (
        w.comment.join(w.song.select("song_id", "artist_name"), "song_id")
        .groupBy("artist_name")
        .agg(
            F.countDistinct("comment_id").alias("comments"),
            F.sum("like_count").alias("likes"),
            F.countDistinct("user_id").alias("users"),
        )
        .orderBy(F.desc("likes"), "artist_name")
        .limit(5)
    )


@query("js_text_search")
def text_search(w: Warehouse, keyword: str = "Brand#1") -> DataFrame:
    """Songs whose "name artist" contains the keyword, ignoring case."""
    haystack = F.lower(F.concat_ws(" ", "song_name", F.coalesce("artist_name", F.lit(""))))
    return (
        w.song.filter(haystack.contains(keyword.strip().lower()))
        .select("song_id", "song_name", "artist_name")
    )


# Users -------------------------------------------------------------------------------------


@query("fd_user_type_pct")
def user_type_share(w: Warehouse) -> DataFrame:
    typed = w.portrait.filter(F.col("user_type").isNotNull())
    counts = typed.groupBy("user_type").agg(F.count(F.lit(1)).alias("user_count"))
    total = F.sum("user_count").over(Window.partitionBy(F.lit(0)))  # over one row per type
    return counts.withColumn("pct", percent(F.col("user_count"), total, 1))


@query("gd_user_type_dist")
def user_type_counts(w: Warehouse) -> DataFrame:
    return w.portrait.groupBy("user_type").agg(F.count(F.lit(1)).alias("cnt"))


@query("fd_user_value_levels")
def user_value_levels(w: Warehouse) -> DataFrame:
    """A missing value counts as low."""
    value = F.col("user_value")
    level = F.when(value >= 0.7, "high").when(value >= 0.4, "medium").otherwise("low")
    return w.portrait.groupBy(level.alias("value_level")).agg(F.count(F.lit(1)).alias("cnt"))


@query("fd_rfm_dist")
def rfm_counts(w: Warehouse) -> DataFrame:
    return w.user_rfm.groupBy("rfm_label").agg(F.count(F.lit(1)).alias("user_count"))


@query("gd_rfm_dist")
def rfm_page(w: Warehouse) -> DataFrame:
    counts = w.user_rfm.groupBy("rfm_label").agg(F.count(F.lit(1)).alias("cnt"))
    total = F.sum("cnt").over(Window.partitionBy(F.lit(0)))  # over one row per label
    return counts.withColumn("rfm_total", total).orderBy(F.desc("cnt"), "rfm_label")


@query("gd_top_users")
def top_users(w: Warehouse) -> DataFrame:
    return (
        w.portrait.join(w.user, "user_id")
        .select(
            "user_id",
            "nickname",
            "user_value",
            F.col("comment_count_total").alias("total_comment"),
            F.col("reply_count_total").alias("total_reply"),
            F.col("like_received_total").alias("total_like"),
            "avg_sentiment",
            "active_period",
            "sentiment_type",
            "user_type",
        )
        .orderBy(F.desc("user_value"), "user_id")
        .limit(15)
    )


def value_histogram(values: DataFrame, column: str, *, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max], all of them; the largest value falls into the last bin."""
    present = values.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    low, high = F.min("v"), F.max("v")
    top = F.when(high - low < 1e-9, low + 1).otherwise(high)
    edges = present.agg(F.struct(low.alias("lo"), ((top - low) / bins).alias("step")).alias("e")).scalar()
    low, step = F.col("__e.lo"), F.col("__e.step")
    index = F.least(F.floor((F.col("v") - low) / step), F.lit(bins - 1).cast("long"))
    counts = (
        present.withColumn("__e", edges).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    spine = present.sparkSession.range(bins, numPartitions=1).withColumnRenamed("id", "bin")
    text = F.format_string("%.3f - %.3f", low + F.col("bin") * step, low + (F.col("bin") + 1) * step)
    return (
        spine.join(counts, "bin", "left")
        .withColumn("__e", edges)
        .filter(low.isNotNull())
        .select(
            "bin",
            text.alias("value_range"),
            F.round(low + (F.col("bin") + 0.5) * step, 6).alias("mid"),
            F.coalesce("n", F.lit(0).cast("long")).alias("user_count"),
        )
    )


@query("gd_value_hist")
def value_histogram_page(w: Warehouse) -> DataFrame:
    return value_histogram(w.portrait, "user_value")


@query("js_nonzero_bins")
def nonzero_bins(w: Warehouse) -> DataFrame:
    return value_histogram(w.portrait, "user_value").filter(F.col("user_count") > 0)


@query("fd_cohort_avg")
def cohort_means(w: Warehouse) -> DataFrame:
    """Unweighted mean over cohorts per offset, the first nine offsets."""
    mean = F.sum(F.round(F.col("retention") * 1_000_000).cast("long"))
    return (
        w.cohort.groupBy("week_offset")
        .agg(mean.alias("__r"), F.count(F.lit(1)).alias("cohort_count"))
        .select(
            "week_offset",
            ratio(F.col("__r"), F.col("cohort_count") * 10_000, 2).alias("avg_retention"),
            "cohort_count",
        )
        .orderBy("week_offset")
        .limit(9)
    )


@query("gd_cohort_matrix")
def cohort_matrix(w: Warehouse) -> DataFrame:
    return w.cohort.filter(F.col("week_offset") <= 8).orderBy("cohort_week", "week_offset")


@query("js_cohort_dense")
def cohort_dense(w: Warehouse, weeks: int = 20, offsets: int = 9) -> DataFrame:
    """The last cohort weeks by offsets 0..8, missing cells as 0, in percent."""
    matrix = w.cohort.filter(F.col("week_offset") < offsets)
    last = matrix.select("cohort_week").distinct().orderBy(F.desc("cohort_week")).limit(weeks)
    cells = last.withColumn("week_offset", F.explode(F.sequence(F.lit(0), F.lit(offsets - 1)).cast("array<bigint>")))
    share = ratio(F.col("active_users"), F.col("cohort_size"), 1, factor=100)
    return cells.join(matrix, ["cohort_week", "week_offset"], "left").select(
        "cohort_week", "week_offset", F.coalesce(share, F.lit(0.0)).alias("retention_pct")
    )


@query("fd_churn_risk")
def churn_risk_counts(w: Warehouse) -> DataFrame:
    return w.churn_risk.groupBy("risk_level").agg(F.count(F.lit(1)).alias("user_count"))


@query("gd_churn_risk")
def churn_risk_page(w: Warehouse) -> DataFrame:
    """Counts in the order low, middle, high, with the total and the number at high risk."""
    counts = w.churn_risk.groupBy("risk_level").agg(F.count(F.lit(1)).alias("cnt"))
    everything = Window.partitionBy(F.lit(0))  # over three rows
    order = F.array_position(F.array(*[F.lit(r) for r in L.RISK_LEVELS]), F.col("risk_level"))
    high = F.sum(F.when(F.col("risk_level") == L.RISK_LEVELS[2], F.col("cnt")).otherwise(0)).over(everything)
    return counts.select(
        "risk_level",
        order.alias("risk_order"),
        "cnt",
        F.sum("cnt").over(everything).alias("churn_total"),
        high.alias("churn_high_count"),
    ).orderBy("risk_order")
