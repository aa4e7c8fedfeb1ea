"""The metric tables themselves, as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.operators.daily import lifecycle_stage
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse


@query("bd_song_daily")
def song_daily(w: Warehouse) -> DataFrame:
    return w.song_daily


@query("bd_song_rank")
def song_rank(w: Warehouse) -> DataFrame:
    return w.song_rank


@query("bd_lifecycle_stage")
def lifecycle(w: Warehouse) -> DataFrame:
    columns = ["dt", "song_id", "heat_score", "heat_change", "lifecycle_stage"]
    return lifecycle_stage(w.song_daily).select(*columns)


@query("bd_hourly")
def hourly(w: Warehouse) -> DataFrame:
    return w.hourly


@query("bd_weekday")
def weekday(w: Warehouse) -> DataFrame:
    return w.weekday


@query("bd_monthly")
def monthly(w: Warehouse) -> DataFrame:
    return w.monthly


@query("bd_cohort")
def cohort(w: Warehouse) -> DataFrame:
    return w.cohort


@query("bd_user_portrait")
def portrait(w: Warehouse) -> DataFrame:
    return w.portrait


@query("bd_churn_label")
def churn_label(w: Warehouse) -> DataFrame:
    return w.churn_label


@query("bd_churn_risk")
def churn_risk(w: Warehouse) -> DataFrame:
    return w.churn_risk.select("user_id", "recency_days", "churn_prob", "risk_level")


@query("bd_user_rfm")
def user_rfm(w: Warehouse) -> DataFrame:
    columns = ["user_id", "recency", "frequency", "r_score", "f_score", "m_score", "rfm_label"]
    return w.user_rfm.select(*columns, F.col("monetary").cast("double").alias("monetary"))
