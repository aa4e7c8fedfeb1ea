"""The logical model (comments, songs, users, labels) bound to the physical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.functions import labels as L


def comments(events: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per comment. ``doc_id`` points at the text, which is joined only where it is read."""
    document_count = documents.agg(F.count(F.lit(1))).scalar()
    return events.select(
        F.col("event_id").alias("comment_id"),
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("song_id"),
        F.floor("value").cast("long").alias("like_count"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).cast("long").alias("reply_count"),
        F.col("ts").alias("comment_time"),
        F.pmod(F.col("event_id"), document_count).alias("doc_id"),
        "event_type",
    )


def with_length(comment: DataFrame, documents: DataFrame) -> DataFrame:
    """Add the length of the text in characters.

    Documents carry it in n_chars, so the text column, nearly all of the table, is not read.
    """
    return comment.join(documents.select("doc_id", F.col("n_chars").alias("content_length")), "doc_id")


def songs(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_name").alias("song_name"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
    )


def artists(part: DataFrame) -> DataFrame:
    brand = part.select(F.col("p_brand").alias("artist_id")).distinct()
    return brand.withColumn("artist_name", F.col("artist_id"))


def users(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("nickname"))


def document_sentiment(labels: DataFrame) -> DataFrame:
    """Sentiment class and probability of every labelled document."""
    sentiment = (
        F.when(F.col("toxic") == 1, L.NEGATIVE).when(F.col("quality") == 1, L.POSITIVE).otherwise(L.NEUTRAL)
    )
    probability = (
        F.when(sentiment == L.POSITIVE, 1.0).when(sentiment == L.NEGATIVE, 0.0).otherwise(0.5)
    )
    return labels.select("doc_id", sentiment.alias("sentiment"), probability.alias("positive_prob"))


def comment_sentiment(comment: DataFrame, labels: DataFrame) -> DataFrame:
    """Sentiment of every comment whose text is labelled."""
    return timed_sentiment(comment, labels).drop("comment_time")


def timed_sentiment(comment: DataFrame, labels: DataFrame) -> DataFrame:
    """The same with the comment's time, so that no one has to join the comments again for it."""
    return comment.join(document_sentiment(labels), "doc_id").select(
        "comment_id", "song_id", "positive_prob", "sentiment", "comment_time"
    )
