"""Labels, features, evaluation and forecasts that need no trained model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.numbers import ratio
from refrain.operators import evaluate, features, forecasting, models
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse


@query("bd_song_features")
def song_features(w: Warehouse) -> DataFrame:
    return w.song_features


@query("bd_hot_label")
def hot_label(w: Warehouse) -> DataFrame:
    return w.hot_label


@query("ml_threshold_flag")
def threshold_flag(w: Warehouse) -> DataFrame:
    return features.flag_hot(w.hot_label).select("song_id", "hot_prob", "is_hot_predicted")


@query("js_prob_scaled")
def scaled_probability(w: Warehouse) -> DataFrame:
    """Ten most probable items, scaled to the largest probability (at least 0.01)."""
    top = w.hot_label.orderBy(F.desc("hot_prob"), "song_id").limit(10)
    units = F.round(F.col("hot_prob") * 1_000_000).cast("long")
    largest = F.greatest(F.max(units).over(Window.partitionBy(F.lit(0))), F.lit(10_000).cast("long"))
    return top.select("song_id", "hot_prob", ratio(units, largest, 1, factor=100).alias("width_pct"))


@query("js_label_map")
def feature_labels(w: Warehouse) -> DataFrame:
    """Mean of every feature under its display name; a code without one is shown as it is."""
    names = w.spark.createDataFrame(
        [*L.FEATURE_NAMES.items(), *L.MODEL_NAMES.items()], "code string, label string"
    )
    means = w.song_features.agg(
        *[F.round(F.avg(F.col(c).cast("double")), 4).alias(c) for c in features.ITEM_FEATURES]
    )
    rows = means.unpivot([], features.ITEM_FEATURES, "feature", "mean_value")
    return rows.join(F.broadcast(names), rows["feature"] == names["code"], "left").select(
        "feature", F.coalesce("label", "feature").alias("label"), "mean_value"
    )


def scored_users(w: Warehouse) -> DataFrame:
    """Churn label against the closed-form probability."""
    return w.churn_risk.select(
        F.col("user_id").alias("row_id"), F.col("churned").alias("label"), F.col("churn_prob").alias("score")
    )


@query("ml_auc")
def auc(w: Warehouse) -> DataFrame:
    result = evaluate.auc(scored_users(w))
    return result.select(F.round("auc", 6).alias("auc"), "positives", "negatives")


@query("ml_pr_auc")
def pr_auc(w: Warehouse) -> DataFrame:
    return evaluate.average_precision(scored_users(w)).select(F.round("pr_auc", 6).alias("pr_auc"))


@query("ml_f1_accuracy")
def f1_accuracy(w: Warehouse) -> DataFrame:
    return evaluate.confusion(scored_users(w)).select(
        F.round("f1", 6).alias("f1"), F.round("accuracy", 6).alias("accuracy"), "support_pos", "support_neg"
    )


@query("ml_bootstrap_ci")
def bootstrap(w: Warehouse) -> DataFrame:
    return evaluate.bootstrap_auc(scored_users(w))


@query("ml_forecast")
def forecast(w: Warehouse) -> DataFrame:
    return w.forecast


@query("ml_forecast_piecewise")
def forecast_piecewise(w: Warehouse) -> DataFrame:
    """Trend with change points and a weekly season, by ridge regression per song."""
    return forecasting.forecast_piecewise(w.song_daily)


@query("ml_forecast_gram")
def forecast_gram(w: Warehouse) -> DataFrame:
    """The sums of products that the piecewise forecast is fitted from, one row for each pair of terms.

    The last term (number ``size``) is the value itself.
    """
    shape = forecasting.Shape()
    sums = forecasting.gram_sums(w.song_daily, "song_id", "dt", "heat_score", shape)
    pairs = [(i, j) for i in range(shape.size) for j in range(i, shape.size)] + [(i, shape.size) for i in range(shape.size + 1)]
    listed = F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i, j in pairs])
    values = F.concat("gram", "moments", F.array("squares"))
    each = sums.select("song_id", F.col("n").cast("long").alias("days"), F.inline(F.arrays_zip(listed.alias("p"), values.alias("v"))))
    return each.select("song_id", "days", "p.i", "p.j", F.round("v", 6).alias("product"))


@query("gd_forecast_songs")
def forecast_songs(w: Warehouse) -> DataFrame:
    """Songs with enough days for a forecast, which need not be made to know them."""
    return w.song.select("song_id", "song_name").join(features.forecastable(w.song_daily), "song_id").orderBy("song_name", "song_id")


@query("gd_forecast_series")
def forecast_series(w: Warehouse) -> DataFrame:
    """Per item and day: the forecast with its bounds, and the item's first and last date."""
    own = Window.partitionBy("song_id")  # the days ahead of one song
    dated = w.forecast.withColumns(
        {"days": F.count(F.lit(1)).over(own), "first_date": F.min("forecast_date").over(own), "last_date": F.max("forecast_date").over(own)}
    )
    return dated.join(w.song.select("song_id", "song_name"), "song_id").select(
        "song_id", "song_name", "days", "first_date", "last_date", "forecast_date", "heat_score", "heat_score_lower", "heat_score_upper"
    )


def hot_training(w: Warehouse, horizon: int = 180) -> DataFrame:
    """Features up to ``horizon`` days before the last day; label: among the hottest after that."""
    cutoff = F.date_sub(w.ship_day, horizon)
    facts = w.interactions.withColumn("__cutoff", cutoff)
    before = facts.filter(F.col("dt") <= F.col("__cutoff"))
    after = facts.filter(F.col("dt") > F.col("__cutoff"))
    label = features.hot_label(after).select("song_id", F.col("is_hot").alias("label"))
    data = features.song_features(before, w.song, cutoff).join(label, "song_id", "left")
    return data.withColumn("label", F.coalesce("label", F.lit(0).cast("long")))


@query("ml_churn_frame")
def churn_frame(w: Warehouse) -> DataFrame:
    """What the churn models learn from: features up to the cutoff, label after it, fold."""
    data = features.user_features(w.purchases, w.order_day)
    rounded = [F.round("monetary", 2).alias("monetary"), F.round("mean_amount", 6).alias("mean_amount")]
    counted = [F.col(c).cast("long").alias(c) for c in features.USER_FEATURES if c not in ("monetary", "mean_amount")]
    return data.select("user_id", "label", models.fold_of(F.col("user_id")).cast("long").alias("fold"), *counted, *rounded)


@query("ml_hot_frame")
def hot_frame(w: Warehouse) -> DataFrame:
    """Label and fold of every song that the hot-song models learn from."""
    return hot_training(w).select("song_id", "label", models.fold_of(F.col("song_id")).cast("long").alias("fold"))
