"""Queries over trained models.

Models of a warehouse are trained once per session, the way their result tables are written once
per run of the pipeline; the reports only read them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.operators import attribution, features, models, segments
from refrain.plans.predictions import hot_training
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse
from refrain.session import cut_lineage
from refrain.sources.model import document_sentiment

_kept: dict[tuple, object] = {}


def once(w: Warehouse, what: str, build: Callable[[], object]):
    """One result for each state of the warehouse; other days, choices or files build anew."""
    key = (w.spark.sparkContext.applicationId, *w.identity, what)
    if key not in _kept:
        _kept[key] = build()
    return _kept[key]


@dataclass
class Suite:
    """Rows with known outcome up to an earlier cutoff, and the rows of the last day to be predicted.

    The latter are built when they are first asked for: metrics and importances never read them.
    """

    frame: DataFrame
    scoring: Callable[[], DataFrame]
    features: list[str]

    @cached_property
    def ahead(self) -> DataFrame:
        return self.scoring()


def hot_suite(w: Warehouse, horizon: int = 180) -> Suite:
    """Features up to ``horizon`` days before the last day; label: among the hottest after that."""

    def build() -> Suite:
        data = hot_training(w, horizon)
        frame = models.training_frame(data, "song_id", features.ITEM_FEATURES)
        now = lambda: features.song_features(w.interactions, w.song, w.ship_day)
        return Suite(frame, lambda: models.scoring_frame(now(), "song_id", features.ITEM_FEATURES), features.ITEM_FEATURES)

    return once(w, f"hot:{horizon}", build)


def churn_suite(w: Warehouse) -> Suite:
    def build() -> Suite:
        data = features.user_features(w.purchases, w.order_day)
        frame = models.training_frame(data, "user_id", features.USER_FEATURES)
        now = features.user_features(w.purchases, w.order_day, horizon=0)
        return Suite(frame, lambda: models.scoring_frame(now, "user_id", features.USER_FEATURES), features.USER_FEATURES)

    return once(w, "churn", build)


def suite_of(w: Warehouse, kind: str) -> Suite:
    return hot_suite(w) if kind == "hot" else churn_suite(w)


def trained(w: Warehouse, kind: str, name: str):
    """The model fitted on all rows whose outcome is known."""
    return once(w, f"{kind}:{name}", lambda: models.fit(suite_of(w, kind).frame, name))


def predictions(w: Warehouse, kind: str, name: str) -> DataFrame:
    """What is to come after the last day, from features up to it."""
    return models.predict(trained(w, kind, name), suite_of(w, kind).ahead)


def metrics(w: Warehouse, kind: str) -> DataFrame:
    """Quality of all models of one target; a few rows, kept like a written table."""

    def build() -> DataFrame:
        return cut_lineage(models.quality(models.out_of_fold(suite_of(w, kind).frame, models.MODELS)))

    return once(w, f"{kind}:metrics", build)


def hot_predictions(w: Warehouse, name: str) -> DataFrame:
    scored = predictions(w, "hot", name).select(
        F.col("row_id").alias("song_id"), F.round("score", 6).alias("hot_prob")
    )
    return features.flag_hot(scored)


def churn_predictions(w: Warehouse, name: str) -> DataFrame:
    scored = predictions(w, "churn", name).select(
        F.col("row_id").alias("user_id"), F.round("score", 6).alias("churn_prob")
    )
    return segments.churn_risk(scored)


@query("ml_hot_lr")
def hot_lr(w: Warehouse) -> DataFrame:
    return hot_predictions(w, "LogisticRegression")


@query("ml_hot_rf")
def hot_rf(w: Warehouse) -> DataFrame:
    return hot_predictions(w, "RandomForest")


@query("ml_hot_gbt")
def hot_gbt(w: Warehouse) -> DataFrame:
    return hot_predictions(w, "GradientBoosting")


@query("ml_churn_lr")
def churn_lr(w: Warehouse) -> DataFrame:
    return churn_predictions(w, "LogisticRegression")


@query("ml_churn_rf")
def churn_rf(w: Warehouse) -> DataFrame:
    return churn_predictions(w, "RandomForest")


@query("ml_churn_gbt")
def churn_gbt(w: Warehouse) -> DataFrame:
    return churn_predictions(w, "GradientBoosting")


@query("ml_cv5")
def cross_validation(w: Warehouse) -> DataFrame:
    columns = ["model_name", "auc", "auc_std", "auc_holdout"]
    both = [
        metrics(w, kind).select(F.lit(kind).alias("target"), *columns) for kind in ("hot", "churn")
    ]
    return both[0].unionByName(both[1])


@query("fd_model_metrics")
def model_metrics(w: Warehouse) -> DataFrame:
    return metrics(w, "hot").drop("support_pos", "support_neg")


@query("gd_model_metrics")
def model_metrics_page(w: Warehouse) -> DataFrame:
    return metrics(w, "hot").select("model_name", "auc", "f1", "accuracy").orderBy(F.desc("auc"))


@query("fd_churn_metrics")
def churn_metrics(w: Warehouse) -> DataFrame:
    return metrics(w, "churn").drop("auc_ci_lower", "auc_ci_upper")


@query("gd_churn_metrics")
def churn_metrics_page(w: Warehouse) -> DataFrame:
    columns = ["model_name", "auc", "auc_std", "f1", "accuracy"]
    return metrics(w, "churn").select(*columns).orderBy(F.desc("auc"))


@query("ml_feature_importance")
def importance(w: Warehouse) -> DataFrame:
    forest = trained(w, "hot", "RandomForest")
    return models.tree_importance(w.spark, forest, hot_suite(w).features)


@query("fd_feature_top8")
def importance_top8(w: Warehouse) -> DataFrame:
    return importance(w).orderBy(F.desc("importance"), "feature").limit(8)


@query("gd_feature_top15")
def importance_top15(w: Warehouse) -> DataFrame:
    return importance(w).orderBy(F.desc("importance"), "feature").limit(15)


@query("ml_permutation_importance")
def permutation(w: Warehouse) -> DataFrame:
    suite = hot_suite(w)
    return models.permutation_importance(suite.frame, trained(w, "hot", "RandomForest"), suite.features)


@query("ml_linear_attribution")
def linear_attribution(w: Warehouse) -> DataFrame:
    suite = hot_suite(w)
    return models.linear_attribution(suite.frame, trained(w, "hot", "LogisticRegression"), suite.features)


@query("ml_tree_attribution")
def tree_attribution(w: Warehouse) -> DataFrame:
    """Exact Shapley values of the forest's predictions for the songs of the last day, per feature."""
    suite = hot_suite(w)
    return attribution.mean_attribution(attribution.tree_attribution(suite.ahead, trained(w, "hot", "RandomForest")), suite.features)


@query("gd_hot_top10")
def hot_top10(w: Warehouse) -> DataFrame:
    named = hot_gbt(w).join(w.song.select("song_id", "song_name"), "song_id")
    return named.select("song_id", "song_name", "hot_prob").orderBy(F.desc("hot_prob"), "song_id").limit(10)


@query("gd_hot_predict20")
def hot_predict20(w: Warehouse) -> DataFrame:
    named = (
        hot_gbt(w)
        .join(w.song.select("song_id", "song_name", "artist_id"), "song_id")
        .join(w.artist, "artist_id", "left")
    )
    return (
        named.select("song_id", "song_name", "artist_name", "hot_prob", "is_hot_predicted")
        .orderBy(F.desc("hot_prob"), "song_id")
        .limit(20)
    )


def churn_table(w: Warehouse) -> DataFrame:
    """Probability and risk of every user, with the recency of the last day, like the features that were scored."""
    known = features.user_features(w.purchases, w.order_day, horizon=0).select("user_id", "recency_days")
    return churn_gbt(w).join(known, "user_id").select("user_id", "churn_prob", "risk_level", "recency_days")


@query("gd_churn_high10")
def churn_high10(w: Warehouse) -> DataFrame:
    """The ten users most likely to leave among those at high risk."""
    risky = churn_table(w).filter(F.col("risk_level") == L.RISK_LEVELS[2])
    return risky.orderBy(F.desc("churn_prob"), "user_id").limit(10)


@query("bd_rfm_kmeans")
def rfm_clusters(w: Warehouse) -> DataFrame:
    base = segments.rfm_base(w.purchases, w.order_day)
    return models.clusters(
        base, "user_id", ["recency", "frequency", "monetary"], [-1, 1, 1], L.RFM_CLUSTERS
    )


@query("bd_user_kmeans")
def user_clusters(w: Warehouse) -> DataFrame:
    totals = ["comment_count_total", "reply_count_total", "like_received_total"]
    return models.clusters(w.portrait, "user_id", totals, [1, 1, 1], L.USER_TYPES)


def topics(w: Warehouse) -> models.Topics:
    return once(w, "topics", lambda: models.fit_topics(w.texts))


@query("tx_lda")
def lda(w: Warehouse) -> DataFrame:
    """The topics with their strongest words; a few rows, kept like a written table."""
    return once(w, "topic-table", lambda: cut_lineage(models.topic_table(topics(w))))


@query("fd_topics")
def topics_short(w: Warehouse) -> DataFrame:
    return lda(w).select("topic_id", "topic_name", "keywords").orderBy("topic_id")


@query("gd_topics")
def topics_page(w: Warehouse) -> DataFrame:
    return lda(w).orderBy("topic_id")


@query("tx_topic_assign")
def topic_assign(w: Warehouse) -> DataFrame:
    return models.topic_counts(topics(w))


def topic_counts_dense(w: Warehouse) -> DataFrame:
    """Comments per source and topic, 0 where a source has none of a topic."""
    sources = w.table("documents").select("source").distinct()
    spine = sources.join(F.broadcast(lda(w).select("topic_id")))  # five topics
    counts = topic_assign(w).withColumnRenamed("source", "__source")
    same = spine["source"].eqNullSafe(counts["__source"]) & (spine["topic_id"] == counts["topic_id"])
    return spine.join(counts, same, "left").select("source", spine["topic_id"], F.coalesce("comment_num", F.lit(0).cast("long")).alias("comment_num"))


@query("gd_topic_dist_lda")
def topic_dist_lda(w: Warehouse) -> DataFrame:
    return models.topic_distribution(topic_assign(w), lda(w))


@query("gd_topic_dist")
def topic_dist(w: Warehouse) -> DataFrame:
    """The distribution over a topic that needs no model: the language of the document.

    Languages are numbered in alphabetical order; only those of at least a tenth of the documents
    get a name, so the made-up name of the others is exercised as well.
    """
    per_language = w.table("documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("comment_num"))
    languages = per_language.groupBy("lang").agg(F.sum("comment_num").alias("n"))
    everything = Window.partitionBy(F.lit(0))  # over one row per language
    numbered = languages.select(
        "lang",
        (F.row_number().over(everything.orderBy("lang")) - 1).cast("long").alias("topic_id"),
        (F.col("n") * 10 >= F.sum("n").over(everything)).alias("named"),
    )
    counts = per_language.join(numbered, "lang").select("source", "topic_id", "comment_num")
    names = numbered.filter("named").select("topic_id", F.col("lang").alias("topic_name"))
    return models.topic_distribution(counts, names)


@query("tx_sentiment_model")
def sentiment_model(w: Warehouse) -> DataFrame:
    model = once(
        w, "sentiment", lambda: models.fit_sentiment(w.texts, document_sentiment(w.table("labels")))
    )
    return models.predict_sentiment(model, w.texts)
