"""Keeping written layers up to date: late days are recomputed alone, distinct users come from sketches,
and facts laid out by user serve the tables of users without a shuffle."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.operators import daily, sketches
from refrain.plans.layers import read_layer, write_layers
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse
from refrain.session import cut_lineage, remove_path, scratch_path
from refrain.sources.writers import write_layer

STAGE_DAYS = 14  # a day's stage looks at so many days, itself included


def touched_days(rows: DataFrame, moment: str = "comment_time") -> list[dt.date]:
    """The different days of late rows; as many as the calendar has, not as the rows."""
    return sorted(r[0] for r in rows.select(F.to_date(moment).alias("d")).filter("d is not null").distinct().collect())


def refresh_days(w: Warehouse, target: str, days: Iterable[dt.date]) -> None:
    """Write the days again in the written daily and rank tables; other days' files are not touched.

    Heat is scaled within a day, so a day needs its own comments only. Stages look back, so the ranks of the
    days behind a late one are written again as well, from the stored daily table.
    """
    days = sorted(set(days))
    if not days:
        return
    late = w.comment.filter(F.to_date("comment_time").isin(days))
    write_layer(daily.song_daily(late), f"{target}/dws/dws_song_daily", "dt")
    stored = read_layer(w.spark, target, "dws_song_daily")
    reach = dt.timedelta(days=STAGE_DAYS - 1)
    changed = sorted({d + dt.timedelta(days=k) for d in days for k in range(STAGE_DAYS)})
    near = stored.filter(F.col("dt").between(days[0] - reach, days[-1] + reach))
    ranks = daily.song_rank(near).filter(F.col("dt").isin(changed))
    write_layer(cut_lineage(ranks), f"{target}/ads/ads_song_rank", "dt")


@query("io_layers_refresh")
def late_days(w: Warehouse) -> DataFrame:
    """Build the daily and rank tables without a third of the comments of two days, let those arrive, refresh, read back."""
    last = w.comment.agg(F.to_date(F.max("comment_time")).alias("d")).first()["d"]
    picked = [last - dt.timedelta(days=k) for k in (3, 20)] if last else []
    is_late = F.coalesce(F.to_date("comment_time").isin(picked) & (F.col("comment_id") % 3 == 0), F.lit(False))
    target = scratch_path(w.spark, "refresh")
    first = Warehouse(w.spark, w.root, as_of=w._as_of)
    first.comment = w.comment.filter(~is_late)
    write_layers(first, target, ["dws_song_daily", "ads_song_rank"])
    refresh_days(w, target, touched_days(w.comment.filter(is_late)))
    ranks = read_layer(w.spark, target, "ads_song_rank")
    per_day = ranks.groupBy(F.col("dt").cast("date").alias("dt"), "lifecycle_stage").agg(
        F.count(F.lit(1)).alias("songs"),
        F.sum("comment_count").alias("comments"),
        F.sum("like_total").alias("likes"),
        F.sum(F.col("heat_rank") * F.round(F.col("heat_score") * 1_000_000).cast("long")).alias("ranked_heat"),
    )
    result = cut_lineage(per_day)
    remove_path(w.spark, target)
    return result


@query("bd_song_users_sketch")
def song_users(w: Warehouse) -> DataFrame:
    """Different users per song over all days, from merged daily sketches, beside the exact number.

    ``near`` says whether the estimate is within four standard errors, or two.
    """
    stored = cut_lineage(sketches.daily_sketches(w.comment, "comment_time", ["song_id"], "user_id"))
    exact = w.comment.filter("comment_time is not null").groupBy("song_id").agg(F.countDistinct("user_id").alias("user_count"))
    both = sketches.merged_counts(stored, ["song_id"]).join(exact, "song_id")
    error = F.abs(F.col("distinct_count") - F.col("user_count"))
    near = error <= F.greatest(F.lit(2.0), 0.065 * F.col("user_count"))
    return both.select("song_id", F.col("row_count").alias("comment_count"), "user_count", near.cast("long").alias("near"))


class UserFacts:
    """A table of facts bucketed and sorted by user, in the shared folder; ``close`` deletes it."""

    def __init__(self, facts: DataFrame, buckets: int | None = None) -> None:
        spark = facts.sparkSession
        self.spark, self.name, self.path = spark, f"refrain_users_{uuid.uuid4().hex}", scratch_path(spark, "users")
        count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        facts.write.bucketBy(count, "user_id").sortBy("user_id").option("path", self.path).saveAsTable(self.name)

    @property
    def frame(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_path(self.spark, self.path)


