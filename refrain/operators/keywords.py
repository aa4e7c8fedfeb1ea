"""Word frequencies, TF-IDF keywords and a sentiment lexicon learned from labelled texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.joins import join_heavy
from refrain.functions.numbers import micro, ratio
from refrain.operators.tokens import STOP_WORDS, is_stop_word, segments
from refrain.session import cut_lineage


def word_counts(documents: DataFrame, words: str = "words") -> DataFrame:
    """(doc_id, word, tf) of (doc_id, words) without stop words.

    A document is one row, so its words are counted inside the row: sorted, equal ones lie together,
    and the places where they change give the counts. Nothing is shuffled.
    """
    listed = F.array(*[F.lit(w) for w in STOP_WORDS])
    kept = F.array_sort(F.filter(words, lambda w: ~F.array_contains(listed, w)))
    starts = documents.select("doc_id", F.transform(F.array(kept), _runs_of_equal)[0].alias("counted"))
    return starts.select("doc_id", F.inline("counted"))


def _runs_of_equal(ordered: Column) -> Column:
    """array of (word, tf) of a sorted list."""
    last = F.size(ordered) - 1
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    firsts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))

    def counted(at: Column) -> Column:
        return F.transform(at, lambda x, i: F.struct(F.get(ordered, x).alias("word"), (F.coalesce(F.get(at, i + 1), F.size(ordered)) - x).cast("long").alias("tf")))

    return F.transform(F.array(firsts), counted)[0]


def group_counts(documents: DataFrame, group: list[str]) -> DataFrame:
    """Per group and word: occurrences and number of documents, in one pass.

    A text is unfolded into its words (kind 0) and its distinct words (kind 1); both counters are
    sums, so (group, word) folds on the map side and no (document, word) pair is shuffled.
    """
    found = documents.withColumn("__words", segments(F.col("text")))
    lists = found.select(
        *group, F.posexplode(F.array("__words", F.array_distinct("__words"))).alias("kind", "listed")
    )
    marks = lists.select(*group, "kind", F.explode("listed").alias("word"))
    return (
        marks.filter(~is_stop_word(F.col("word")))
        .groupBy(*group, "word")
        .agg(F.count_if(F.col("kind") == 0).alias("tf"), F.count_if(F.col("kind") == 1).alias("df"))
    )


def inverse_frequency(documents: Column, containing: Column) -> Column:
    """Smoothed inverse document frequency."""
    return F.log((documents + 1) / (containing + 1)) + 1


def group_keywords(documents: DataFrame, group: str, *, top: int = 20, counts: DataFrame | None = None) -> DataFrame:
    """The highest TF-IDF words of every group; ``counts`` are the ``group_counts``, if they are at hand.

    Document frequencies are joined back with the frequent words treated as heavy keys: a word
    that occurs in nearly every group is broadcast, not shuffled to one task. The cut to ``top``
    is applied per task before the shuffle.
    """
    if counts is None:
        counts = cut_lineage(group_counts(documents, [group]))  # the texts are read once
    frequency = cut_lineage(
        counts.groupBy("word").agg(F.sum("df").alias("document_count"), F.count(F.lit(1)).alias("groups"))
    )
    totals = cut_lineage(counts.groupBy(group).agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("words")))
    all_documents = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    # a group with a third of all words is a heavy key as well
    scored = (
        join_heavy(join_heavy(counts, frequency, "word", "groups"), totals, group, "words")
        .withColumn("__documents", all_documents)
        .withColumn(
            "score",
            F.round(
                F.col("tf") / F.col("total") * inverse_frequency(F.col("__documents"), F.col("document_count")), 6
            ),
        )
    )
    best = Window.partitionBy(group).orderBy(F.desc("score"), "word")
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .select(
            group, "word", "tf", "document_count", "score", F.col("rank").cast("long").alias("keyword_rank")
        )
    )


def corpus_keywords(documents: DataFrame, *, top: int = 20, counts: DataFrame | None = None) -> DataFrame:
    """The highest TF-IDF words of the whole corpus.

    Each text is in one group, so ``group_counts`` of any groups add up to those of the corpus;
    where they are at hand, the texts are not read again.
    """
    folded = group_counts(documents, []) if counts is None else counts.groupBy("word").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    counts = cut_lineage(folded)
    totals = counts.agg(F.sum("tf").alias("n")).scalar()
    all_documents = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    score = F.col("tf") / F.col("__total") * inverse_frequency(F.col("__documents"), F.col("df"))
    scored = counts.withColumns({"__total": totals, "__documents": all_documents}).select(
        "word", "tf", F.col("df").alias("document_count"), F.round(score, 6).alias("score")
    )
    best = scored.orderBy(F.desc("score"), "word").limit(top)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), "word"))
    return best.withColumn("keyword_rank", rank.cast("long"))


def sentiment_lexicon(documents: DataFrame, sentiment: DataFrame) -> DataFrame:
    """(word, weight, occurrences): log odds (add-one smoothing) of every word of the labelled texts.

    ``sentiment`` has doc_id, sentiment. Words that lean to neither side are listed as well.
    """
    decided = documents.join(
        sentiment.filter(F.col("sentiment").isin(L.POSITIVE, L.NEGATIVE)), "doc_id"
    ).select("sentiment", F.explode(segments(F.col("text"))).alias("word"))
    counts = cut_lineage(
        decided.filter(~is_stop_word(F.col("word")))
        .groupBy("word")
        .agg(
            F.count_if(F.col("sentiment") == L.POSITIVE).alias("positive"),
            F.count_if(F.col("sentiment") == L.NEGATIVE).alias("negative"),
        )
    )
    totals = counts.agg(
        F.struct(
            F.sum("positive").alias("p"), F.sum("negative").alias("n"), F.count(F.lit(1)).alias("v")
        ).alias("t")
    ).scalar()
    odds = F.log((F.col("positive") + 1) / (F.col("t.p") + F.col("t.v"))) - F.log(
        (F.col("negative") + 1) / (F.col("t.n") + F.col("t.v"))
    )
    occurrences = F.col("positive") + F.col("negative")
    weighed = counts.withColumn("t", totals).select("word", F.round(odds, 6).alias("weight"), occurrences.alias("occurrences"))
    return cut_lineage(weighed)


FREQUENT = 1 << 16  # words of a lexicon that every task is given


def matched_words(documents: DataFrame, frequent: list[tuple[str, int]], rest: bool) -> DataFrame:
    """(doc_id, word, tf, w) of (doc_id, words): a row of each text without word, with the number and the sum of its frequent words.

    With ``rest``, every other word of the text that is no stop word follows in a row of its own, where w is NULL.
    """
    listed = pa.array([word for word, _ in frequent], pa.string())
    weights = np.array([*(w for _, w in frequent), 0], np.int64)
    stop = pa.array(STOP_WORDS, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                ids, lists = batch.slice(start, 1024).columns
                rows = np.repeat(np.arange(len(lists), dtype=np.int64), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                coded = lists.flatten().dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                places = pc.index_in(coded.dictionary, value_set=listed).fill_null(len(listed)).to_numpy(zero_copy_only=False)
                found = places[codes] < len(listed)
                n = np.bincount(rows[found], minlength=len(lists))
                # sums of doubles, exact below 2**53
                w = np.rint(np.bincount(rows, weights[places][codes], minlength=len(lists))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([ids, pa.nulls(len(ids), pa.string()), pa.array(n.astype(np.int64)), pa.array(w)], names=names)
                if rest:
                    kept = ~found & ~pc.is_in(coded.dictionary, value_set=stop).to_numpy(zero_copy_only=False)[codes]
                    pairs, tf = np.unique(rows[kept] << 32 | codes[kept].astype(np.int64), return_counts=True)
                    words = coded.dictionary.take(pa.array(pairs & 0xFFFFFFFF))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(pairs >> 32)), words, pa.array(tf.astype(np.int64)), pa.nulls(len(pairs), pa.int64())], names=names)

    names = ["doc_id", "word", "tf", "w"]
    return documents.select("doc_id", "words").mapInArrow(run, "doc_id bigint, word string, tf bigint, w bigint")


def lexicon_score(documents: DataFrame, lexicon: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Mean weight of the listed words of every text, NULL where none occurs.

    The texts are read once. Their frequent words, a fixed number of the lexicon's, are summed where they are
    read; the lexicon may be of any size, and what is left of it is joined to the words that are left of the texts,
    of which none is a hot key of the lexicon. Texts without listed words keep their row.
    """
    weighed = lexicon.select("word", micro(F.col("weight")).alias("weight"), "occurrences")
    top = [(r.word, r.weight) for r in weighed.orderBy(F.desc("occurrences"), "word").limit(frequent).collect()]  # a fixed number
    rest = len(top) == frequent
    found = matched_words(documents.select("doc_id", segments(F.col("text")).alias("words")), top, rest)
    if rest:
        # a row of a text gets a key that is no word, so that these rows are dealt out evenly
        own = F.concat(F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        joined = found.withColumn("word", F.coalesce("word", own)).join(weighed.drop("occurrences"), "word", "left")
        found = joined.select("doc_id", "tf", F.coalesce("w", F.col("tf") * F.col("weight")).alias("w")).filter("w is not null")
    sums = found.groupBy("doc_id").agg(F.sum("tf").alias("__n"), F.sum("w").alias("__w"))
    joined = documents.select("doc_id").join(sums, "doc_id", "left").withColumn("matched", F.coalesce("__n", F.lit(0).cast("long")))
    score = ratio(F.col("__w"), F.col("matched") * 1_000_000, 6)
    mood = F.when(score > 0, L.POSITIVE).when(score < 0, L.NEGATIVE).otherwise(L.NEUTRAL)
    return joined.select("doc_id", "matched", score.alias("score"), mood.alias("sentiment"))
