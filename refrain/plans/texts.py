"""Cleaning, copies and text queries over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.operators import clean, keywords, nearcopies, segmentation, survivors
from refrain.plans.registry import query
from refrain.plans.warehouse import Warehouse
from refrain.session import cut_lineage
from refrain.sources.model import document_sentiment


@query("clean_blacklist")
def blacklist(w: Warehouse) -> DataFrame:
    """Documents that hit no listed term."""
    return w.texts.filter(~clean.has_term(F.col("text"), clean.BLACKLIST)).select("doc_id", "source")


@query("clean_blacklist_table")
def blacklist_table(w: Warehouse) -> DataFrame:
    """The same with the list given as a table, which may be of any size."""
    listed = w.spark.createDataFrame([(t,) for t in clean.BLACKLIST], "word string")
    return clean.drop_listed(w.texts, listed).select("doc_id", "source")


@query("clean_spam_regex")
def spam(w: Warehouse) -> DataFrame:
    rules = clean.spam_rules(F.col("text"))
    flags = [hit.cast("int").cast("long").alias(name) for name, hit in rules.items()]
    return w.texts.select("doc_id", *flags)


@query("dedup_exact")
def exact(w: Warehouse) -> DataFrame:
    return clean.exact_groups(clean.digests(w.texts))


@query("dedup_simhash")
def near(w: Warehouse) -> DataFrame:
    groups = nearcopies.near_groups(nearcopies.signatures(w.texts))
    return groups.withColumn("is_kept", (F.col("doc_id") == F.col("keep_id")).cast("int").cast("long"))


@query("dedup_simhash_pairs")
def near_pairs(w: Warehouse) -> DataFrame:
    """Pairs of distinct signatures at most three bits apart."""
    distinct = nearcopies.signatures(w.texts).select("signature").distinct()
    pairs = nearcopies.close_pairs(cut_lineage(distinct))  # read several times; the texts once
    distance = F.bit_count(F.col("low").bitwiseXOR(F.col("high"))).cast("long")
    return pairs.select("low", "high", distance.alias("distance"))


@query("clean_report")
def report(w: Warehouse) -> DataFrame:
    """Rows in and out of every cleaning step: the rules, exact copies, near copies."""
    return clean.retention_report(survivors.cleaning_steps(w.texts))


@query("tx_tokenize")
def tokenize(w: Warehouse) -> DataFrame:
    """Words of every document; runs of ideographs are cut into words of a lexicon learned from them."""
    return keywords.word_counts(segmentation.document_words(w.texts, w.word_shares))


@query("tx_word_lexicon")
def word_lexicon(w: Warehouse) -> DataFrame:
    """The lexicon that the texts would give if they were written without spaces."""
    return w.joined_lexicon


@query("tx_segment_score")
def segment_score(w: Warehouse) -> DataFrame:
    """How many of the words' ends are found again when phrases lose their spaces and are cut."""
    return segmentation.boundary_scores(w.texts, segmentation.weights(w.joined_lexicon))


@query("tx_tfidf_song")
def song_keywords(w: Warehouse) -> DataFrame:
    return w.song_keywords


@query("gd_song_keywords12")
def song_keywords_page(w: Warehouse) -> DataFrame:
    kept = w.song_keywords.filter(F.col("keyword_rank") <= 12)
    return kept.select("source", "word", "score", "keyword_rank")


@query("tx_tfidf_global")
def global_keywords(w: Warehouse) -> DataFrame:
    return w.global_keywords


@query("gd_global_keywords20")
def global_keywords_page(w: Warehouse) -> DataFrame:
    return w.global_keywords.orderBy("keyword_rank").limit(20).select("word", "score")


@query("tx_sentiment_lexicon")
def lexicon(w: Warehouse) -> DataFrame:
    documents = w.texts
    words = keywords.sentiment_lexicon(documents, document_sentiment(w.table("labels")))
    return keywords.lexicon_score(documents, words)
