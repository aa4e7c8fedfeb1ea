"""Hypothesis tests and the A/B report over the warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.numbers import mean_of_scores
from refrain.operators import statistics as T
from refrain.plans.registry import query
from refrain.plans.showcase import weekly_growth
from refrain.plans.warehouse import Warehouse

SALT = "push-2024"


def growth_sample(w: Warehouse) -> DataFrame:
    """Growth of every song-week against its previous present week."""
    grown = weekly_growth(w.comment).filter(F.col("prev_week_comments") > 0)
    return grown.select((F.col("weekly_comments") / F.col("prev_week_comments") - 1).alias("value"))


def weekend_sample(w: Warehouse) -> DataFrame:
    part = F.when(F.weekday("comment_time") >= 5, "weekend").otherwise("weekday")
    return w.comment.select(part.alias("grp"), F.col("like_count").alias("value"))


def heat_sample(w: Warehouse) -> DataFrame:
    """Daily comments of songs whose mean heat is at or above the mean of all songs, and the others."""
    means = w.song_daily.groupBy("song_id").agg(mean_of_scores(F.col("heat_score")).alias("mean_heat"))
    middle = means.agg(mean_of_scores(F.col("mean_heat")).alias("m")).scalar()
    side = F.when(F.col("mean_heat") >= F.col("__m"), "high").otherwise("low")
    grouped = means.withColumn("__m", middle).select("song_id", side.alias("grp"))
    return w.song_daily.join(grouped, "song_id").select("grp", F.col("comment_count").alias("value"))


def type_sample(w: Warehouse) -> DataFrame:
    return w.comment.select(F.col("event_type").alias("grp"), F.col("like_count").alias("value"))


@query("st_t_one_sample")
def one_sample(w: Warehouse) -> DataFrame:
    return T.t_one_sample(growth_sample(w), test_id=1, name="评论增长率是否显著异于0", metric="growth_rate")


@query("st_mannwhitney")
def rank_sum(w: Warehouse) -> DataFrame:
    return T.mann_whitney(
        heat_sample(w), "high", "low", test_id=2, name="高热度组vs低热度组评论数差异", metric="comment_count"
    )


@query("st_chi2_gof")
def goodness(w: Warehouse) -> DataFrame:
    counts = w.comment_sentiment.agg(
        F.count_if(F.col("sentiment") == L.POSITIVE).alias("x"),
        F.count_if(F.col("sentiment") == L.NEGATIVE).alias("y"),
    )
    return T.chi2_even(counts, test_id=3, name="正面vs负面评论比例是否偏离50/50", metric="sentiment")


@query("st_t_two_sample")
def two_sample(w: Warehouse) -> DataFrame:
    return T.t_two_sample(
        weekend_sample(w), "weekday", "weekend", test_id=4, name="工作日vs周末获赞差异", metric="like_count"
    )


@query("st_chi2_independence")
def independence(w: Warehouse) -> DataFrame:
    part = F.when(F.weekday("comment_time") >= 5, "weekend").otherwise("weekday")
    table = w.comment.groupBy(F.col("event_type").alias("a"), part.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return T.chi2_independence(table, test_id=5, name="互动类型与周末是否独立", metric="event_type")


@query("st_kruskal")
def kruskal(w: Warehouse) -> DataFrame:
    return T.kruskal(type_sample(w), test_id=6, name="各互动类型获赞差异", metric="like_count")


@query("st_pvalue")
def all_tests(w: Warehouse) -> DataFrame:
    """Statistic and p-value of every test."""
    return stat_tests(w).select("test_id", "test_type", "statistic", "p_value")


def stat_tests(w: Warehouse) -> DataFrame:
    tests = [one_sample, rank_sum, goodness, two_sample, independence, kruskal]
    return reduce(DataFrame.unionByName, [test(w) for test in tests])


@query("fd_stat_tests")
def stat_tests_short(w: Warehouse) -> DataFrame:
    return stat_tests(w).select("test_name", "test_type", "p_value", "effect_size", "conclusion")


@query("gd_stat_tests")
def stat_tests_page(w: Warehouse) -> DataFrame:
    return stat_tests(w).orderBy("test_id").drop("test_id")


@query("js_significance")
def significance(w: Warehouse) -> DataFrame:
    return stat_tests(w).select("test_name", "p_value", T.verdict(F.col("p_value")).alias("significance"))


def assigned_users(w: Warehouse) -> DataFrame:
    return T.assign(w.user.select("user_id"), SALT)


def ab_sample(w: Warehouse) -> DataFrame:
    """Orders per user and group; users without orders count as 0."""
    orders = w.purchases.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return assigned_users(w).join(orders, "user_id", "left").select(
        "user_id", "grp", F.coalesce("n", F.lit(0).cast("long")).alias("value")
    )


@query("ab_assign")
def ab_assign(w: Warehouse) -> DataFrame:
    return assigned_users(w)


@query("ab_balance")
def ab_balance(w: Warehouse) -> DataFrame:
    return T.balance(assigned_users(w))


@query("ab_sample_size")
def ab_sample_size(w: Warehouse) -> DataFrame:
    return T.sample_size(ab_sample(w))


def ab_report(w: Warehouse) -> DataFrame:
    return T.ab_test(ab_sample(w), name="推送通知对评论数的影响", metric="comment_count")


@query("ab_test")
def ab_test(w: Warehouse) -> DataFrame:
    return ab_report(w)


@query("fd_ab_test")
def ab_short(w: Warehouse) -> DataFrame:
    return ab_report(w).drop("sample_size", "statistic").limit(1)


@query("gd_ab_report")
def ab_page(w: Warehouse) -> DataFrame:
    return ab_report(w)
