"""Trained models: classifiers with cross-validation, clusters, topics, sentiment.

Training runs on Spark ML. Model inputs are cut to reliable storage once, because every fold
and every iteration reads them again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.ordering import number_rows
from refrain.operators import evaluate
from refrain.operators.tokens import is_stop_word, segments
from refrain.session import cut_lineage

SEED = 42
FOLDS = 5


def classifier(name: str):
    if name == "LogisticRegression":
        return LogisticRegression(maxIter=30, regParam=0.01, weightCol="weight")
    if name == "RandomForest":
        return RandomForestClassifier(numTrees=20, maxDepth=5, seed=SEED, weightCol="weight")
    if name == "GradientBoosting":
        return GBTClassifier(maxIter=10, maxDepth=4, seed=SEED, weightCol="weight")
    raise ValueError(f"unknown model {name}")


MODELS = ["LogisticRegression", "RandomForest", "GradientBoosting"]


HOLDOUT = -1


def fold_of(row_id: Column, folds: int = FOLDS) -> Column:
    """Fold by digest of the id, or ``HOLDOUT`` for a fifth of the rows that no fold contains.

    The same row is in the same part on every run and cluster.
    """
    digest = F.md5(row_id.cast("string").cast("binary"))

    def part(start: int) -> Column:
        return F.conv(F.substring(digest, start, 8), 16, 10).cast("long")

    return F.when(part(9) % 5 == 0, HOLDOUT).otherwise(part(1) % folds).cast("int")


def feature_vector(features: Sequence[str]) -> Column:
    return array_to_vector(F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]))


def scoring_frame(data: DataFrame, row_id: str, features: Sequence[str]) -> DataFrame:
    """(row_id, features) of rows whose outcome is not known yet."""
    return cut_lineage(data.select(F.col(row_id).alias("row_id"), feature_vector(features).alias("features")))


def predict(model, frame: DataFrame) -> DataFrame:
    return model.transform(frame).select("row_id", F.round(vector_to_array("probability")[1], 9).alias("score"))


def training_frame(data: DataFrame, row_id: str, features: Sequence[str]) -> DataFrame:
    """(row_id, label, fold, features, weight): missing values as 0, balanced class weights."""
    rows = cut_lineage(
        data.select(
            F.col(row_id).alias("row_id"),
            F.col("label").cast("double").alias("label"),
            fold_of(F.col(row_id)).alias("fold"),
            feature_vector(features).alias("features"),
        )
    )
    count, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    weights = [count / (2 * n) if n else 1.0 for n in (positive, count - positive)]
    return rows.withColumn("weight", F.when(F.col("label") == 1, weights[0]).otherwise(weights[1]))


def score(model, frame: DataFrame) -> DataFrame:
    probability = vector_to_array("probability")[1]
    return model.transform(frame).select(
        "row_id", "fold", F.col("label").cast("long").alias("label"), F.round(probability, 9).alias("score")
    )


def fit(frame: DataFrame, name: str):
    return classifier(name).fit(frame)


def out_of_fold(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """(model_name, row_id, fold, label, score): every row scored by a model that did not see its fold.

    The holdout is scored by a model of all folds, and no other model sees it. The fits are independent Spark jobs submitted
    side by side; those that come last in ``names``, boosted trees, take longest and start first, so that none is left alone at the end.
    """

    def fit_without(name: str, fold: int) -> DataFrame:
        model = fit(frame.filter((F.col("fold") != fold) & (F.col("fold") != HOLDOUT)), name)
        held_out = score(model, frame.filter(F.col("fold") == fold))
        return held_out.select(F.lit(name).alias("model_name"), "*")

    inherit = inheritable_thread_target(frame.sparkSession)
    with ThreadPoolExecutor(max_workers=FOLDS + 1) as pool:
        jobs = [pool.submit(inherit(fit_without), n, k) for n in reversed(names) for k in (*range(FOLDS), HOLDOUT)]
        parts = [job.result() for job in jobs]
    return cut_lineage(reduce(DataFrame.unionByName, parts))


def quality(unseen: DataFrame) -> DataFrame:
    """One row per model from its out-of-fold scores.

    AUC is the mean over the folds; the other metrics are those of the holdout, which is in no fold.
    All models are evaluated together in grouped passes.
    """
    key = ["model_name"]
    holdout = unseen.filter(F.col("fold") == HOLDOUT)
    in_fold = F.when(F.col("fold") != HOLDOUT, F.col("auc"))
    folds = (
        evaluate.auc(unseen, ["model_name", "fold"])
        .groupBy("model_name")
        .agg(
            F.avg(in_fold).alias("auc"),
            F.stddev_pop(in_fold).alias("auc_std"),
            F.max(F.when(F.col("fold") == HOLDOUT, F.col("auc"))).alias("auc_holdout"),
        )
    )
    parts = [
        evaluate.average_precision(holdout, key),
        evaluate.confusion(holdout, key),
        evaluate.bootstrap_auc(holdout, key).select("model_name", "auc_ci_lower", "auc_ci_upper"),
    ]
    joined = reduce(lambda left, right: left.join(right, "model_name"), parts, folds)
    # Nine decimals: sums of doubles differ in their last bits with the order of the rows.
    values = [F.col(c) if c.startswith("support") else F.round(c, 9).alias(c) for c in METRIC_COLUMNS]
    return joined.select("model_name", *values)


METRIC_COLUMNS = [
    "auc",
    "auc_std",
    "auc_holdout",
    "pr_auc",
    "f1",
    "accuracy",
    "auc_ci_lower",
    "auc_ci_upper",
    "support_pos",
    "support_neg",
]


def tree_importance(spark, model, features: Sequence[str]) -> DataFrame:
    weights = model.featureImportances.toArray()
    return spark.createDataFrame(
        [(f, float(v)) for f, v in zip(features, weights)], "feature string, importance double"
    )


def permutation_importance(frame: DataFrame, model, features: Sequence[str]) -> DataFrame:
    """Loss of AUC when one feature takes the value of another row.

    Rows are numbered in two digest orders and paired on the number; the pairing serves every
    feature. All features are scored in one pass: each row is unfolded once per feature.
    """
    def digest(salt: str) -> Column:
        return F.md5(F.concat(F.col("row_id").cast("string"), F.lit(salt)).cast("binary"))

    values = frame.select("row_id", "label", vector_to_array("features").alias("own"))
    left = number_rows(values.withColumn("d", digest("a")), ["d", "row_id"], index="pair").drop("d")
    right = number_rows(values.withColumn("d", digest("b")), ["d", "row_id"], index="pair")
    paired = left.join(right.select("pair", F.col("own").alias("other")), "pair")
    positions = F.sequence(F.lit(0), F.lit(len(features) - 1))
    unfolded = paired.withColumn("j", F.explode(positions)).withColumn(
        "mixed",
        F.transform("own", lambda x, i: F.when(i == F.col("j"), F.get("other", F.col("j"))).otherwise(x)),
    )
    scored = model.transform(
        unfolded.select("row_id", "label", "j", array_to_vector("mixed").alias("features"))
    ).select(
        "j", F.col("label").cast("long").alias("label"), F.round(vector_to_array("probability")[1], 9).alias("score")
    )
    label = F.col("label")
    counts = scored.groupBy("j", "score").agg(F.sum(label).alias("pos"), F.sum(1 - label).alias("neg"))
    shuffled = evaluate.auc_from_counts(counts, ["j"])
    base = evaluate.auc(score(model, frame)).select("auc").scalar()
    names = F.array(*[F.lit(f) for f in features])
    return shuffled.withColumn("base", base).select(
        F.get(names, F.col("j")).alias("feature"),
        F.round(F.col("base") - F.col("auc"), 6).alias("auc_drop"),
    )


def linear_attribution(frame: DataFrame, model, features: Sequence[str]) -> DataFrame:
    """Exact attribution of a linear model: coefficient times distance from the mean, averaged."""
    weights = [float(x) for x in model.coefficients.toArray()]
    values = frame.select(F.posexplode(vector_to_array("features")).alias("j", "x"))
    means = values.groupBy("j").agg(F.avg("x").alias("mean"))
    spread = values.join(F.broadcast(means), "j")  # one row per feature
    weight = F.get(F.array(*[F.lit(x) for x in weights]), F.col("j"))
    names = F.array(*[F.lit(f) for f in features])
    return spread.groupBy("j").agg(
        F.avg(F.abs(weight * (F.col("x") - F.col("mean")))).alias("mean_abs")
    ).select(F.get(names, F.col("j")).alias("feature"), F.round("mean_abs", 6).alias("mean_abs_attribution"))


# Clusters ----------------------------------------------------------------------------------


def clusters(
    frame: DataFrame, row_id: str, features: Sequence[str], direction: Sequence[int], names: Sequence[str]
) -> DataFrame:
    """K-means over the standardised features; clusters are named by the rank of their centre.

    ``direction`` says whether more of a feature is better (1) or worse (-1).
    """
    values = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]
    data = cut_lineage(frame.select(row_id, *values))
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
            KMeans(featuresCol="scaled", predictionCol="cluster", k=len(names), seed=SEED, maxIter=20),
        ]
    )
    fitted = pipeline.fit(data)
    centres = fitted.stages[-1].clusterCenters()
    value = [sum(d * c for d, c in zip(direction, centre)) for centre in centres]
    order = sorted(range(len(value)), key=lambda i: -value[i])
    name_of = {cluster: names[place] for place, cluster in enumerate(order)}
    label = F.coalesce(*[F.when(F.col("cluster") == c, n) for c, n in name_of.items()])
    return fitted.transform(data).select(row_id, *features, label.alias("cluster_label"))


# Topics ------------------------------------------------------------------------------------


TOPIC_BUCKETS = 1 << 14
TOPIC_STEPS = 8  # of a document towards its shares, in each round
TOPIC_PRIOR = 1e-3  # words of each bucket that every topic is given


class TopicModel:
    """Shares of the buckets in every topic, by the sums of the last round."""

    def __init__(self, weights: np.ndarray, prior: float) -> None:
        self.weights, self.prior = weights, prior  # buckets by topics

    def vocabSize(self) -> int:
        return len(self.weights)

    def topicsMatrix(self) -> DenseMatrix:
        return DenseMatrix(*self.weights.shape, self.weights.ravel(order="F").tolist())

    def transform(self, vectors: DataFrame) -> DataFrame:
        """``vectors`` with the share of every topic in ``topicDistribution``, all 0 where there are no words."""
        shares, prior = self.weights / self.weights.sum(axis=0), self.prior

        def run(bucket: pa.Array, times: pa.Array) -> pa.Array:
            parts = [topic_shares(*_entries(bucket.slice(i, 512), times.slice(i, 512)), shares, prior)[0] for i in range(0, len(bucket), 512)]
            found = np.concatenate(parts) if parts else np.zeros((0, shares.shape[1]))
            total = found.sum(axis=1, keepdims=True)
            return pa.array(list(np.divide(found, total, out=np.zeros_like(found), where=total > 0)), pa.list_(pa.float64()))

        return vectors.withColumn("topicDistribution", F.arrow_udf(run, "array<double>")(F.col("bucket"), F.col("times")))


@dataclass
class Topics:
    """A fitted model over buckets of words, the documents' bucket counts, and (word, bucket, tf)."""

    model: TopicModel
    vectors: DataFrame
    words: DataFrame


def word_bucket(word: Column, buckets: int = TOPIC_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def fold_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last column, lists of buckets, as lists of different buckets and of their numbers."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            lists = part.column(part.num_columns - 1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(lists), dtype=np.int64), sizes)
            found, times = np.unique(rows << 32 | lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
            ends = pa.array(np.searchsorted(found >> 32, np.arange(len(lists) + 1)), pa.int32())
            folded = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for v in (found & 0xFFFFFFFF, times)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *folded], names=[*part.schema.names[:-1], "bucket", "times"])


def _entries(bucket: pa.ListArray, times: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Document, bucket and count of each entry of folded lists, and the number of lists."""
    at = np.repeat(np.arange(len(bucket), dtype=np.int64), bucket.value_lengths().to_numpy(zero_copy_only=False))
    return at, bucket.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False).astype(np.float64), len(bucket)


def topic_shares(at: np.ndarray, bucket: np.ndarray, counts: np.ndarray, documents: int, shares: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Words of every document by topic (documents by topics), and of every entry by topic.

    With the topics given, a word is divided among them by topic share of the document times word
    share of the topic, and the document's shares are those of its words, until that settles.
    """
    k = shares.shape[1]
    given = np.ascontiguousarray(shares.T)[:, bucket]  # topic by topic, so that all steps run along the entries
    held = np.zeros((documents, k))
    if not len(at):
        return held, given.T
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    sizes = np.diff(np.append(starts, len(at)))
    mine = np.tile(np.add.reduceat(counts, starts) / k, (k, 1))
    for _ in range(TOPIC_STEPS):
        part = np.repeat(mine + prior, sizes, axis=1)
        part *= given
        total = part[0].copy()
        for row in part[1:]:
            total += row
        part *= counts / np.maximum(total, 1e-300)
        mine = np.add.reduceat(part, starts, axis=1)
    held[at[starts]] = mine.T
    return held, part.T


def fit_topics(documents: DataFrame, *, k: int = 5, iterations: int = 10, buckets: int = TOPIC_BUCKETS) -> Topics:
    """LDA over all words of all documents, hashed to a fixed number of buckets.

    No word is left out, and the model holds k numbers per bucket however many words there are.
    Words that share a bucket share its weight; ``topic_table`` finds the words of a bucket again.
    Every round of the expectation maximisation reads all documents where they lie; only its sums, k
    numbers per bucket and task, are shuffled and brought together.
    """
    # looked up in a hashed set; a list would be searched through for every word
    words = F.filter(segments(F.col("text")), lambda w: ~is_stop_word(w) & (F.char_length(w) > 1))
    prepared = documents.select("doc_id", "source", words.alias("words"))
    # an outer one: for the other the optimizer would ask below whether there are words, and cut the texts twice
    counted = prepared.select(F.explode_outer("words").alias("word")).filter("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("tf"))
    vocabulary = cut_lineage(counted.select("word", word_bucket(F.col("word"), buckets).alias("bucket"), "tf"))
    hashed = F.transform("words", lambda w: word_bucket(w, buckets))
    vectors = cut_lineage(prepared.select("doc_id", "source", hashed.alias("bucket")).mapInArrow(fold_buckets, "doc_id bigint, source string, bucket array<int>, times array<int>"))
    prior = 1 / k
    # rows of buckets differ a little by topic, the same on every run; the rounds make more of it
    weights = np.random.default_rng(SEED).gamma(100, 0.01, (buckets, k))

    def sums(shares: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((buckets, k))
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    at, bucket, counts, n = _entries(*batch.slice(start, 512).columns)
                    _, part = topic_shares(at, bucket, counts, n, shares, prior)
                    for topic in range(k):
                        total[:, topic] += np.bincount(bucket, part[:, topic], buckets)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["bucket", "w"])

        each = vectors.select("bucket", "times").mapInArrow(run, "bucket int, w array<double>")
        rows = each.groupBy("bucket").agg(*[F.sum(F.col("w")[i]).alias(f"w{i}") for i in range(k)]).collect()  # one row per bucket
        found = np.zeros((buckets, k))
        for r in rows:
            found[r["bucket"]] = r[1:]
        return found

    for _ in range(iterations):
        weights = sums((weights + TOPIC_PRIOR) / (weights + TOPIC_PRIOR).sum(axis=0))
    return Topics(TopicModel(weights + TOPIC_PRIOR, prior), vectors, vocabulary)


def topic_words(topics: Topics, words: int = 10) -> DataFrame:
    """(topic, word, weight, place) of the strongest words of each topic.

    A bucket's weight in a topic is divided among its words by their counts. The join is on the
    bucket, whose side has one row per bucket.
    """
    matrix = topics.model.topicsMatrix().toArray()  # buckets by topics
    shares = matrix / matrix.sum(axis=0)
    spark = topics.words.sparkSession
    weights = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(shares)], "bucket int, weights array<double>")
    held = topics.words.groupBy("bucket").agg(F.sum("tf").alias("all"))
    buckets = weights.join(held, "bucket")
    joined = topics.words.join(F.broadcast(buckets), "bucket")  # a fixed number of rows
    each = joined.select("word", (F.col("tf") / F.col("all")).alias("part"), F.posexplode("weights").alias("topic", "w"))
    scored = each.select("topic", "word", F.round(F.col("w") * F.col("part"), 9).alias("weight"))
    best = Window.partitionBy("topic").orderBy(F.desc("weight"), "word")
    return scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= words)


def topic_table(topics: Topics, *, words: int = 10) -> DataFrame:
    """Topics with their strongest words, at most k rows."""
    listed = topic_words(topics, words).groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("l"))
    keywords = F.col("l.word")
    return listed.select(
        F.col("topic").cast("long").alias("topic_id"),
        F.concat(F.lit(L.TOPIC_PREFIX), (F.col("topic") + 1).cast("string")).alias("topic_name"),
        F.array_join(keywords, ",").alias("keywords"),
        F.size(keywords).cast("long").alias("keyword_count"),
    )


def topic_counts(topics: Topics) -> DataFrame:
    """Comments per group and strongest topic."""
    weights = F.col("topicDistribution")
    strongest = (F.array_position(weights, F.array_max(weights)) - 1).cast("long")
    return (
        topics.model.transform(topics.vectors)
        .groupBy("source", strongest.alias("topic_id"))
        .agg(F.count(F.lit(1)).alias("comment_num"))
    )


def topic_distribution(counts: DataFrame, topics: DataFrame) -> DataFrame:
    """Comments per topic with its name, or a name made from the id where it has none."""
    fallback = F.concat(F.lit(L.TOPIC_PREFIX), F.col("topic_id").cast("string"))
    totals = counts.groupBy("topic_id").agg(F.sum("comment_num").alias("cnt"))
    return (
        totals.join(topics.select("topic_id", "topic_name"), "topic_id", "left")
        .select("topic_id", F.coalesce("topic_name", fallback).alias("topic_name"), "cnt")
        .orderBy(F.desc("cnt"), "topic_id")
    )


# Sentiment ---------------------------------------------------------------------------------


def fit_sentiment(documents: DataFrame, sentiment: DataFrame, *, buckets: int = 1 << 14):
    """Logistic regression on hashed TF-IDF, trained on the decided labels."""
    decided = sentiment.filter(F.col("sentiment").isin(L.POSITIVE, L.NEGATIVE)).select(
        "doc_id", (F.col("sentiment") == L.POSITIVE).cast("double").alias("label")
    )
    data = documents.select("doc_id", segments(F.col("text")).alias("words")).join(decided, "doc_id")
    pipeline = Pipeline(
        stages=[
            HashingTF(inputCol="words", outputCol="tf", numFeatures=buckets),
            IDF(inputCol="tf", outputCol="features"),
            LogisticRegression(maxIter=20, regParam=0.05),
        ]
    )
    return pipeline.fit(cut_lineage(data))


def predict_sentiment(model, documents: DataFrame) -> DataFrame:
    """Positive probability and class: from 0.6 positive, up to 0.4 negative."""
    scored = model.transform(documents.select("doc_id", segments(F.col("text")).alias("words")))
    p = F.col("positive_prob")
    return scored.select(
        "doc_id", F.round(vector_to_array("probability")[1], 6).alias("positive_prob")
    ).withColumn(
        "sentiment", F.when(p >= 0.6, L.POSITIVE).when(p <= 0.4, L.NEGATIVE).otherwise(L.NEUTRAL)
    )
