"""Scans, raw loading, layered writes, export and key checks."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.operators.quality import orphans
from refrain.plans.pages import lifecycle_series, song_list, top_comments
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse
from refrain.session import cut_lineage, remove_path, scratch_path
from refrain.sources import writers
from refrain.sources.tables import bound_query


@query("io_table_scan")
def table_scan(w: Warehouse) -> DataFrame:
    """A scan with bound parameters; both conditions and the three columns reach the files."""
    text = """
        SELECT o_orderpriority AS priority, count(*) AS orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM {orders}
        WHERE o_orderstatus = :status AND o_orderdate >= CAST(:since AS TIMESTAMP_NTZ)
        GROUP BY o_orderpriority
    """
    args = {"status": "F", "since": dt.date(1997, 1, 1)}
    return bound_query(w.spark, text, args, {"orders": w.table("orders")})


@query("io_load_raw")
def load_raw(w: Warehouse) -> DataFrame:
    """Events as collected lines, those of type error cut off in the middle, loaded into a raw table."""
    line = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value"))
    half = F.substring(line, F.lit(1), (F.char_length(line) / 2).cast("int"))
    collected = w.table("events").select(F.when(F.col("event_type") == "error", half).otherwise(line).alias("value"))
    source, target = scratch_path(w.spark, "collected"), scratch_path(w.spark, "raw")
    collected.write.text(source)
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    writers.write_layer(writers.load_raw(w.spark, source, schema), target)
    loaded = w.spark.read.schema(f"{schema}, {writers.CORRUPT} string").parquet(target)
    broken = F.col(writers.CORRUPT).isNotNull()
    counts = loaded.groupBy(
        F.when(~broken, F.col("event_type")).alias("event_type"),
        broken.cast("int").cast("long").alias("is_corrupt"),
    ).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~broken, F.col("ts"))).alias("with_time"))
    return _read_and_removed(counts, source, target)


def _read_and_removed(result: DataFrame, *paths: str) -> DataFrame:
    """A small result cut from the files it was read from, which are then deleted."""
    kept = cut_lineage(result)
    for path in paths:
        remove_path(result.sparkSession, path)
    return kept


@query("io_layer_write")
def layer_write(w: Warehouse) -> DataFrame:
    """Write the daily table by day, rewrite the last day only, and read it back."""
    target = scratch_path(w.spark, "song-daily")
    daily = w.song_daily
    writers.write_layer(daily, target, "dt")
    again = daily.withColumn("__last", w.comment_day).filter(F.col("dt") == F.col("__last")).drop("__last")
    writers.write_layer(again.withColumn("comment_count", F.col("comment_count") + 1), target, "dt")
    written = w.spark.read.schema(daily.schema).parquet(target)
    per_day = written.groupBy("dt").agg(
        F.count(F.lit(1)).alias("songs"), F.sum("comment_count").alias("comments")
    )
    return _read_and_removed(per_day, target)


@query("io_json_export")
def json_export(w: Warehouse) -> DataFrame:
    """Orders as JSON lines under both policies for decimals, times and bytes."""
    rows = w.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("moment"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    priority = w.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("moment"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderpriority").cast("binary").alias("priority"),
    )
    strings = writers.to_json_rows(rows, "as_string").withColumn("policy", F.lit("as_string"))
    floats = writers.to_json_rows(priority, "as_float").withColumn("policy", F.lit("as_float"))
    return strings.unionByName(floats)


@query("gd_song_details")
def song_details(w: Warehouse) -> DataFrame:
    """One nested record per song; missing parts are empty lists and a missing struct.

    Every part is folded to one row per song before it is joined: the days are bounded by the
    calendar, keywords and comments by their numbers.
    """
    daily = lifecycle_series(w.song_daily)
    # A source of documents stands for the songs with the same number.
    number = F.regexp_extract("source", "([0-9]+)$", 1).cast("long")
    word = F.struct("keyword_rank", "word", "score")
    words = (
        w.song_keywords.filter(F.col("keyword_rank") <= 12)
        .groupBy(number.alias("song_id"))
        .agg(F.array_sort(F.collect_list(word)).alias("keywords"))
    )
    sentiment = w.song_sentiment.select(
        "song_id", F.struct("positive", "neutral", "negative").alias("sentiment")
    )
    text = w.table("documents").select("doc_id", F.col("text").alias("content"))
    entry = F.struct("position", "content", "like_count", "comment_time")
    best = (
        top_comments(w.comment)
        .join(text, "doc_id")
        .groupBy("song_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("top_comments"))
    )
    parts = [daily, words, sentiment, best]
    joined = reduce(lambda left, right: left.join(right, "song_id", "left"), parts, song_list(w))
    return joined.select(
        "song_id",
        "song_name",
        "artist_name",
        "comment_count",
        F.coalesce("lifecycle", F.array()).alias("lifecycle"),
        F.coalesce("keywords", F.array()).alias("keywords"),
        "sentiment",
        F.coalesce("top_comments", F.array()).alias("top_comments"),
    )


@query("gd_song_details_parts")
def song_detail_parts(w: Warehouse) -> DataFrame:
    """The nested records laid out flat: one row for each day, keyword, share and comment."""

    def part(name: str, position: Column, key: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("part"), position.cast("long").alias("position"), key.cast("string").alias("key"), value.cast("double").alias("value"))

    rows = F.concat(
        F.transform("lifecycle", lambda x, i: part("day", i, x["dt"], x["heat_score"])),
        F.transform("keywords", lambda x: part("keyword", x["keyword_rank"], x["word"], x["score"])),
        F.transform("top_comments", lambda x: part("comment", x["position"], F.md5(x["content"]), x["like_count"])),
        F.filter(F.array(part("positive", F.lit(0), F.lit(""), F.col("sentiment.positive"))), lambda x: x["value"].isNotNull()),
        F.array(part("song", F.lit(0), F.col("song_name"), F.col("comment_count"))),
    )
    return song_details(w).select("song_id", F.inline(rows))


@query("dq_orphan_keys")
def orphan_keys(w: Warehouse) -> DataFrame:
    """Rows and keys without a match, per foreign key; every table is read once for all of its keys."""
    part, customer, orders = w.table("part"), w.table("customer"), w.table("orders")
    comment = [
        ("comment.song_id", "song_id", part, "p_partkey"),
        ("comment.user_id", "user_id", customer, "c_custkey"),
        ("comment.doc_id", "doc_id", w.table("documents"), "doc_id"),
        ("comment.doc_id->labels", "doc_id", w.table("labels"), "doc_id"),
    ]
    line = [("lineitem.l_orderkey", "l_orderkey", orders, "o_orderkey"), ("lineitem.l_partkey", "l_partkey", part, "p_partkey")]
    purchase = [("orders.o_custkey", "o_custkey", customer, "c_custkey")]
    return reduce(DataFrame.unionByName, [orphans(w.comment, comment), orphans(orders, purchase), orphans(w.table("lineitem"), line)])
