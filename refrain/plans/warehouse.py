"""Warehouse: the lazily built layers that named queries read.

Properties are built when they are first asked for. Most are plans only; those that need exact
ranks over all rows, or that several results share, run jobs then and cut their lineage on reliable
storage. ``as_of`` fixes the
day to report on; by default it is the last day found in the facts. ``cleaned`` restricts comments
to those whose text passes the cleaning steps; the named queries use all of them.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.operators import daily, features, keywords, segmentation, segments, sentiment
from refrain.operators.survivors import kept_documents
from refrain.operators.tokens import IDEOGRAPH
from refrain.session import cut_lineage
from refrain.sources import model
from refrain.sources.tables import read_table, spread


class Warehouse:
    def __init__(
        self, spark: SparkSession, root: str, as_of: dt.date | None = None, cleaned: bool = False
    ):
        self.spark = spark
        self.root = root
        self._as_of = as_of
        self._cleaned = cleaned

    @cached_property
    def identity(self) -> tuple:
        """What trained models depend on: the place, the day, and the files of their tables.

        They use orders, lines, parts and documents as they are, whichever comments are chosen.
        """
        files = [f for name in ("documents", "orders", "lineitem", "labels", "part") for f in self.table(name).inputFiles()]
        return (self.root, self._as_of, tuple(sorted(files)))

    def restricted(self) -> Warehouse:
        """The same place and day over cleaned comments only."""
        return Warehouse(self.spark, self.root, as_of=self._as_of, cleaned=True)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    def last_day(self, frame: DataFrame, moment: str) -> Column:
        """The reporting day: the given one, or the last day of the facts as a scalar subquery."""
        if self._as_of is not None:
            return F.lit(self._as_of)
        return frame.agg(F.to_date(F.max(moment)).alias("day")).scalar()

    @property
    def comment_day(self) -> Column:
        return self.last_day(self.table("events"), "ts")

    @property
    def order_day(self) -> Column:
        return self.last_day(self.table("orders"), "o_orderdate")

    @cached_property
    def comment(self) -> DataFrame:
        comment = model.comments(self.table("events"), self.table("documents"))
        if self._cleaned:
            comment = comment.join(kept_documents(self.texts), "doc_id", "left_semi")
        return comment

    @property
    def comment_detail(self) -> DataFrame:
        """Comments with their texts; only the table of comment details holds these."""
        return self.comment.join(self.table("documents").select("doc_id", F.col("text").alias("content")), "doc_id")

    @cached_property
    def comment_lengths(self) -> DataFrame:
        return model.with_length(self.comment, self.table("documents"))

    @cached_property
    def texts(self) -> DataFrame:
        """Documents for work that is heavy per text."""
        return spread(self.table("documents").select("doc_id", "source", "text"))

    @cached_property
    def word_shares(self) -> dict[str, float]:
        """Weights of the words that the ideographs of the texts make up; empty where there are none."""
        runs = self.texts.filter(F.col("text").rlike(IDEOGRAPH)).select(F.explode(segmentation.ideograph_runs(F.col("text"))).alias("run"))
        return segmentation.weights(segmentation.learn(runs)) if runs.limit(1).count() else {}

    @cached_property
    def joined_lexicon(self) -> DataFrame:
        runs = self.texts.select(F.explode_outer(segmentation.joined_runs(F.col("text"))).alias("run"))
        return segmentation.learn(runs)

    @cached_property
    def song(self) -> DataFrame:
        return model.songs(self.table("part"))

    @cached_property
    def artist(self) -> DataFrame:
        return model.artists(self.table("part"))

    @cached_property
    def user(self) -> DataFrame:
        return model.users(self.table("customer"))

    @cached_property
    def comment_sentiment(self) -> DataFrame:
        return model.comment_sentiment(self.comment, self.table("labels"))

    @cached_property
    def sentiment_facts(self) -> DataFrame:
        return sentiment.sentiment_facts(self.comment_sentiment, self.comment, self.song)

    @cached_property
    def timed_scores(self) -> DataFrame:
        """Scored comments with their time; comments without one are left out."""
        return sentiment.timed_scores(model.timed_sentiment(self.comment, self.table("labels")))

    @cached_property
    def song_sentiment(self) -> DataFrame:
        return sentiment.song_sentiment(self.comment_sentiment)

    @cached_property
    def sentiment_summary(self) -> DataFrame:
        return sentiment.sentiment_summary(self.comment_sentiment, self.comment_day)

    @cached_property
    def purchases(self) -> DataFrame:
        """Long-range activity: one row per order."""
        return self.table("orders").select(
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderkey").alias("action_id"),
            F.col("o_orderdate").alias("moment"),
            F.col("o_totalprice").alias("amount"),
        )

    @cached_property
    def song_daily(self) -> DataFrame:
        return daily.song_daily(self.comment)

    @cached_property
    def song_rank(self) -> DataFrame:
        return daily.song_rank(self.song_daily)

    @cached_property
    def hourly(self) -> DataFrame:
        return daily.hourly(self.comment)

    @cached_property
    def weekday(self) -> DataFrame:
        return daily.weekday(self.comment)

    @cached_property
    def monthly(self) -> DataFrame:
        return daily.monthly(self.table("orders"), "o_orderdate")

    @cached_property
    def portrait(self) -> DataFrame:
        return segments.portrait(self.comment, model.document_sentiment(self.table("labels")))

    @cached_property
    def user_rfm(self) -> DataFrame:
        return segments.user_rfm(self.purchases, self.order_day)

    @cached_property
    def cohort(self) -> DataFrame:
        return segments.cohort_retention(self.purchases)

    @cached_property
    def churn_label(self) -> DataFrame:
        return segments.churn_label(self.purchases, self.order_day)

    @cached_property
    def churn_risk(self) -> DataFrame:
        return segments.churn_risk(segments.recency_risk(self.churn_label))

    @cached_property
    def source_words(self) -> DataFrame:
        """(source, word, tf, df), from one reading of the texts."""
        return cut_lineage(keywords.group_counts(self.texts, ["source"]))

    @cached_property
    def song_keywords(self) -> DataFrame:
        """Keywords per source; a source of documents stands for a song."""
        return keywords.group_keywords(self.texts, "source", counts=self.source_words)

    @cached_property
    def global_keywords(self) -> DataFrame:
        """Of the counts by source if those are known; by themselves they are counted without sources, in fewer rows."""
        return keywords.corpus_keywords(self.texts, counts=vars(self).get("source_words"))

    @property
    def ship_day(self) -> Column:
        return self.last_day(self.table("lineitem"), "l_shipdate")

    @cached_property
    def interactions(self) -> DataFrame:
        return features.interactions(self.table("lineitem"))

    @cached_property
    def song_features(self) -> DataFrame:
        return features.song_features(self.interactions, self.song, self.ship_day)

    @cached_property
    def hot_label(self) -> DataFrame:
        return features.hot_label(self.interactions)

    @cached_property
    def forecast(self) -> DataFrame:
        return features.forecast(self.song_daily)
