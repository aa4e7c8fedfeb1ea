"""What can be said of the results of trained models without training them.

Each query ``<name>_facts`` gives one row about the query ``<name>``: how many rows and different keys it
has, and how many rows keep to the rules of their columns. These are the same whatever the model
learned, so that they can be compared with SQL over the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.operators import features, segments
from refrain.plans import learning, showcase
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse


def _row(frame: DataFrame, key: str, valid: Column) -> DataFrame:
    return frame.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_keys"), F.count_if(F.coalesce(valid, F.lit(False))).alias("n_valid")
    )


def _unit(*columns: str) -> Column:
    """All columns are shares or probabilities."""
    valid = F.lit(True)
    for c in columns:
        valid = valid & F.col(c).between(0, 1)
    return valid


def _facts(name: str, result: Callable[[Warehouse], DataFrame], key: str, valid: Callable[[], Column], known: Callable[[Warehouse], DataFrame] | None = None) -> None:
    """Register the facts of a query; with ``known``, only rows whose key it holds are valid."""

    @query(f"{name}_facts")
    def facts(w: Warehouse) -> DataFrame:
        frame = result(w)
        if known is None:
            return _row(frame, key, valid())
        keys = known(w).select(F.col(key).alias("__key")).distinct().withColumn("__known", F.lit(True))
        return _row(frame.join(keys, F.col(key) == F.col("__key"), "left"), key, valid() & F.col("__known"))


def _hot(probability: str = "hot_prob") -> Column:
    return _unit(probability) & (F.col("is_hot_predicted") == (F.col(probability) >= 0.5).cast("long"))


def _risk() -> Column:
    return _unit("churn_prob") & (F.col("risk_level") == segments.risk_level(F.col("churn_prob")))


for _name, _result in (("lr", learning.hot_lr), ("rf", learning.hot_rf), ("gbt", learning.hot_gbt)):
    _facts(f"ml_hot_{_name}", _result, "song_id", _hot, lambda w: w.interactions)
for _name, _result in (("lr", learning.churn_lr), ("rf", learning.churn_rf), ("gbt", learning.churn_gbt)):
    _facts(f"ml_churn_{_name}", _result, "user_id", _risk, lambda w: w.purchases)


def _best(result: Callable[[Warehouse], DataFrame], every: Callable[[Warehouse], DataFrame], key: str, value: str, n: int) -> Callable[[Warehouse], DataFrame]:
    """The rows of a report with the place that all rows give them, in ``__place``."""

    def placed(w: Warehouse) -> DataFrame:
        top = every(w).orderBy(F.desc(value), key).limit(n).select(F.col(key).alias("__k"), F.col(value).alias("__v"))
        place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("__v"), "__k"))  # over n rows
        return result(w).join(top.withColumn("__place", place), F.col(key) == F.col("__k"), "left")

    return placed


_named = lambda w: learning.hot_gbt(w).join(w.song.select("song_id"), "song_id")
_facts("gd_hot_top10", _best(learning.hot_top10, _named, "song_id", "hot_prob", 10), "song_id", lambda: _unit("hot_prob") & (F.col("__place") <= 10))
_facts("gd_hot_predict20", _best(learning.hot_predict20, _named, "song_id", "hot_prob", 20), "song_id", lambda: _hot() & (F.col("__place") <= 20) & F.col("artist_name").isNotNull())


@query("gd_churn_high10_facts")
def churn_high(w: Warehouse) -> DataFrame:
    """All are at high risk, with the recency of the last day; there are ten, or as many as the risk table has."""
    risky = learning.churn_gbt(w).filter(F.col("risk_level") == L.RISK_LEVELS[2]).agg(F.least(F.count(F.lit(1)), F.lit(10)).alias("n"))
    seen = features.user_features(w.purchases, w.order_day, horizon=0).select("user_id", F.col("recency_days").alias("__days"))
    row = _row(learning.churn_high10(w).join(seen, "user_id", "left"), "user_id", _risk() & (F.col("recency_days") == F.col("__days")))
    return row.join(risky).select(*[(F.col(c) - F.col("n")).alias(c) for c in ("n_rows", "n_keys", "n_valid")])


def _scores() -> Column:
    return _unit("auc", "auc_holdout", "pr_auc", "f1", "accuracy") & (F.col("auc_std") >= 0)


_facts("fd_model_metrics", learning.model_metrics, "model_name", lambda: _scores() & (F.col("auc_ci_lower") <= F.col("auc_ci_upper")))
_facts("gd_model_metrics", learning.model_metrics_page, "model_name", lambda: _unit("auc", "f1", "accuracy"))
_facts("gd_churn_metrics", learning.churn_metrics_page, "model_name", lambda: _unit("auc", "f1", "accuracy"))
_facts("ml_cv5", lambda w: learning.cross_validation(w).withColumn("key", F.concat_ws("/", "target", "model_name")), "key", lambda: _unit("auc", "auc_holdout"))


@query("fd_churn_metrics_facts")
def churn_support(w: Warehouse) -> DataFrame:
    """With the support of both classes, which the holdout alone decides."""
    frame = learning.churn_metrics(w)
    return frame.groupBy("support_pos", "support_neg").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("model_name").alias("n_keys"), F.count_if(_scores()).alias("n_valid"))


def _feature() -> Column:
    return F.col("feature").isin(features.ITEM_FEATURES)


_facts("ml_feature_importance", learning.importance, "feature", lambda: _feature() & _unit("importance"))
_facts("ml_permutation_importance", learning.permutation, "feature", lambda: _feature() & F.col("auc_drop").between(-1, 1))
_facts("ml_tree_attribution", learning.tree_attribution, "feature", lambda: _feature() & (F.col("mean_abs_attribution") >= F.abs("mean_attribution")))
_facts("ml_linear_attribution", learning.linear_attribution, "feature", lambda: _feature() & (F.col("mean_abs_attribution") >= 0))
_facts("fd_feature_top8", _best(learning.importance_top8, learning.importance, "feature", "importance", 8), "feature", lambda: _feature() & (F.col("__place") <= 8))
_facts("gd_feature_top15", _best(learning.importance_top15, learning.importance, "feature", "importance", 15), "feature", lambda: _feature() & (F.col("__place") <= 15))
_facts("bd_rfm_kmeans", learning.rfm_clusters, "user_id", lambda: F.col("cluster_label").isin(L.RFM_CLUSTERS), lambda w: w.purchases)
_facts("bd_user_kmeans", learning.user_clusters, "user_id", lambda: F.col("cluster_label").isin(L.USER_TYPES), lambda w: w.comment)


def _topic() -> Column:
    return (F.col("topic_name") == F.concat(F.lit(L.TOPIC_PREFIX), (F.col("topic_id") + 1).cast("string"))) & (F.size(F.array_distinct(F.split("keywords", ","))) == 10)


_facts("tx_lda", learning.lda, "topic_id", lambda: _topic() & (F.col("keyword_count") == 10))
_facts("gd_topics", learning.topics_page, "topic_id", lambda: _topic() & (F.col("keyword_count") == 10))
_facts("fd_topics", learning.topics_short, "topic_id", _topic)


@query("tx_topic_assign_facts")
def assigned(w: Warehouse) -> DataFrame:
    """Documents of all topics per source."""
    return learning.topic_assign(w).filter(F.col("topic_id").between(0, 4)).groupBy("source").agg(F.sum("comment_num").alias("documents"))


@query("gd_topic_dist_lda_facts")
def distributed(w: Warehouse) -> DataFrame:
    return learning.topic_dist_lda(w).agg(F.sum("cnt").alias("documents"), F.count_if(~F.col("topic_name").startswith(L.TOPIC_PREFIX)).alias("odd_names"))


def _class() -> Column:
    p = F.col("positive_prob")
    return F.when(p >= 0.6, L.POSITIVE).when(p <= 0.4, L.NEGATIVE).otherwise(L.NEUTRAL)


_facts("tx_sentiment_model", learning.sentiment_model, "doc_id", lambda: _unit("positive_prob") & (F.col("sentiment") == _class()), lambda w: w.table("documents"))


@query("sq5_artist_matrix_approx_facts")
def approximate(w: Warehouse) -> DataFrame:
    """The exact matrix, with whether the sketched counts are near it: within a fifth, four standard errors of the sketch, or three.

    Both are made for all artists, as a sketched count may fall on the other side of the least number of comments.
    """
    exact = showcase.artist_matrix(w.comment_lengths, w.song, more_than=0, top=None)
    sketched = showcase.artist_matrix(w.comment_lengths, w.song, more_than=0, top=None, approximate=True)
    near = [F.abs(F.col(f"s.{c}") - F.col(f"e.{c}")) <= F.greatest(F.col(f"e.{c}") * 0.2, F.lit(3)) for c in ("comment_count", "user_count")]
    both = exact.alias("e").join(sketched.alias("s"), F.col("e.artist_name") == F.col("s.artist_name"))
    return both.select(F.col("e.artist_name").alias("artist_name"), F.col("e.comment_count").alias("comment_count"), F.col("e.user_count").alias("user_count"), (near[0] & near[1]).cast("long").alias("near"))
