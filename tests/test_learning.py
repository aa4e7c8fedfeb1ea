"""Models find a planted signal; forecasts and clusters on literal frames."""

import datetime
import itertools
import math
import random

import pytest

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from refrain.operators import attribution, features, keywords, models
from refrain.plans import learning
from refrain.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        x, noise = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, int(x + 0.3 * rng.gauss(0, 1) > 0.5), x, noise, None if i % 50 == 0 else 1.0))
    data = spark.createDataFrame(rows, "id long, label long, x double, noise double, gap double")
    return models.training_frame(data, "id", ["x", "noise", "gap"])


def test_planted_signal(planted):
    unseen = models.out_of_fold(planted, models.MODELS)
    assert unseen.count() == 3 * planted.count()
    rows = models.quality(unseen).collect()
    assert sorted(r.model_name for r in rows) == sorted(models.MODELS)
    for row in rows:
        assert row.auc > 0.85 and row.auc_holdout > 0.8
        assert row.auc_ci_lower <= row.auc_holdout <= row.auc_ci_upper
        assert row.support_pos + row.support_neg == planted.filter("fold = -1").count()


def test_grouped_quality_equals_one_model_alone(planted):
    unseen = models.out_of_fold(planted, models.MODELS[:2])
    together = {r.model_name: r for r in models.quality(unseen).collect()}
    alone = models.quality(unseen.filter(f"model_name = '{models.MODELS[1]}'")).first()
    assert together[models.MODELS[1]] == alone


def test_importances_find_the_feature(spark, planted):
    forest = models.fit(planted, "RandomForest")
    names = ["x", "noise", "gap"]
    drop = {r.feature: r.auc_drop for r in models.permutation_importance(planted, forest, names).collect()}
    assert max(drop, key=drop.get) == "x" and abs(drop["gap"]) < 0.05
    tree = {r.feature: r.importance for r in models.tree_importance(spark, forest, names).collect()}
    assert max(tree, key=tree.get) == "x" and sum(tree.values()) == pytest.approx(1)
    linear = models.fit(planted, "LogisticRegression")
    part = {r.feature: r.mean_abs_attribution for r in models.linear_attribution(planted, linear, names).collect()}
    assert max(part, key=part.get) == "x"


def test_clusters_are_named_by_their_centres(spark):
    rows = [(i, 100.0 + i % 3, 1.0) for i in range(20)] + [(100 + i, 1.0 + i % 2, 50.0) for i in range(20)]
    frame = spark.createDataFrame(rows, "id long, amount double, days double")
    out = models.clusters(frame, "id", ["amount", "days"], [1, -1], ["best", "worst"]).collect()
    assert {r.cluster_label for r in out if r.id < 100} == {"best"}
    assert {r.cluster_label for r in out if r.id >= 100} == {"worst"}


def test_forecast_continues_a_line_and_skips_short_series(spark):
    start = datetime.date(2024, 1, 1)
    line = [(1, start + datetime.timedelta(days=i), 0.1 + 0.01 * i) for i in range(28)]
    short = [(2, start + datetime.timedelta(days=i), 0.5) for i in range(13)]
    falling = [(3, start + datetime.timedelta(days=i), max(0.0, 0.5 - 0.03 * i)) for i in range(20)]
    daily = spark.createDataFrame(line + short + falling, "song_id long, dt date, heat_score double")
    out = features.forecast(daily).collect()
    assert {r.song_id for r in out} == {1, 3}
    mine = sorted((r for r in out if r.song_id == 1), key=lambda r: r.forecast_date)
    assert len(mine) == 30 and mine[0].forecast_date == start + datetime.timedelta(days=28)
    assert mine[0].heat_score == pytest.approx(0.38) and mine[-1].heat_score == pytest.approx(0.67)
    assert all(0 <= r.heat_score_lower <= r.heat_score <= r.heat_score_upper for r in out)


def test_facts_are_dealt_out_by_item_once(spark, monkeypatch):
    monkeypatch.setattr(features, "cut_lineage", lambda df: df)
    day = datetime.date(2024, 1, 1)
    rows = [(i % 3, day + datetime.timedelta(days=i), 1, i % 2, 0, 1, 2) for i in range(90)]
    facts = spark.createDataFrame(rows, "song_id long, dt date, likes long, negative int, positive int, valid int, topic_bit int")
    song = spark.createDataFrame([(i, "a") for i in range(3)], "song_id long, artist_id string")
    frame = features.song_features(facts, song, F.lit(day))
    plan = frame._jdf.queryExecution().toString()
    assert "hashpartitioning(song_id" in plan and "_groupingexpression" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)
    assert sorted((r.song_id, r.total_comment_count, r.total_reply_count) for r in frame.collect()) == [(i, 30, 15) for i in range(3)]


def test_topics_and_sentiment_model(spark):
    music = [(i, "s1", "melody guitar chorus drum melody") for i in range(30)]
    food = [(100 + i, "s2", "noodle dumpling pepper soup noodle") for i in range(30)]
    documents = spark.createDataFrame(music + food, "doc_id long, source string, text string")
    topics = models.fit_topics(documents, k=2, iterations=20)
    table = models.topic_table(topics, words=4).collect()
    assert [r.topic_id for r in sorted(table, key=lambda r: r.topic_id)] == [0, 1]
    assert sum(r.comment_num for r in models.topic_counts(topics).collect()) == 60
    labels = spark.createDataFrame(
        [(i, "positive") for i in range(20)] + [(100 + i, "negative") for i in range(20)],
        "doc_id long, sentiment string",
    )
    model = models.fit_sentiment(documents, labels)
    mood = {r.doc_id: r.sentiment for r in models.predict_sentiment(model, documents).collect()}
    assert mood[25] == "positive" and mood[125] == "negative"


def test_buckets_hold_all_words_and_give_the_topics_of_the_full_fit(spark):
    rng = random.Random(8)
    music, food = "melody guitar chorus drum piano".split(), "noodle dumpling pepper soup garlic".split()
    rows = [(i, "s", " ".join([*(rng.choice(music if i % 2 else food) for _ in range(40)), f"only{i}"])) for i in range(120)]
    documents = spark.createDataFrame(rows, "doc_id long, source string, text string")
    wide, narrow = (models.fit_topics(documents, k=2, iterations=50, buckets=n) for n in (1 << 14, 1 << 8))
    assert wide.words.count() == narrow.words.count() == 130
    assert narrow.model.vocabSize() == 1 << 8 and wide.model.vocabSize() == 1 << 14
    prepared = documents.select("doc_id", F.split("text", " ").alias("words"))
    full = CountVectorizer(inputCol="words", outputCol="features").fit(prepared)
    described = LDA(k=2, optimizer="em", maxIter=50, seed=models.SEED).fit(full.transform(prepared)).describeTopics(5).collect()
    want = sorted(sorted(full.vocabulary[i] for i in r.termIndices) for r in described)
    assert want == sorted([sorted(music), sorted(food)])
    assert sorted(sorted(r.word for r in group) for group in by_topic(models.topic_words(wide, 5))) == want
    total = models.topic_words(wide, 1000).groupBy("topic").agg(F.sum("weight").alias("w")).collect()
    assert all(r.w == pytest.approx(1, abs=0.02) for r in total)  # what is left lies in empty buckets


def test_topic_rounds_shuffle_sums_only(spark):
    """Shares of a document are those of a plain loop; empty texts have none; the same model on every run."""
    documents = spark.createDataFrame([(1, "s", "melody guitar melody"), (2, None, ""), (3, "s", None), (4, "t", "pepper soup pepper")], "doc_id long, source string, text string")
    first, again = (models.fit_topics(documents, k=2, iterations=5, buckets=64) for _ in range(2))
    assert isinstance(first.model, models.TopicModel) and (first.model.weights == again.model.weights).all()
    assert first.model.weights.sum() == pytest.approx(6 + 64 * 2 * models.TOPIC_PRIOR)  # every word once
    assert sum(r.comment_num for r in models.topic_counts(first).collect()) == 4
    shares = first.model.weights / first.model.weights.sum(axis=0)
    for r in first.model.transform(first.vectors).collect():
        mine = [sum(r.times) / 2] * 2
        for _ in range(models.TOPIC_STEPS):
            parts = [[shares[b][t] * (mine[t] + 0.5) for t in (0, 1)] for b in r.bucket]
            mine = [sum(n * p[t] / sum(p) for n, p in zip(r.times, parts)) for t in (0, 1)]
        assert r.topicDistribution == pytest.approx([m / sum(r.times) if r.times else 0 for m in mine])


def by_topic(words):
    found = {}
    for r in words.collect():
        found.setdefault(r.topic, []).append(r)
    return found.values()


def brute_shapley(values, leaves):
    """All subsets of the features, each leaf's expectation with only the subset known."""
    n = len(values)

    def expected(known):
        total = 0.0
        for leaf in leaves:
            part = leaf.value
            for j, f in enumerate(leaf.features):
                part *= float(leaf.low[j] < values[f] <= leaf.high[j]) if f in known else leaf.shares[j]
            total += part
        return total

    out = [0.0] * n
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            for subset in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(n - 1 - size) / math.factorial(n)
                out[i] += weight * (expected({*subset, i}) - expected(set(subset)))
    return out


def test_tree_attribution_is_the_shapley_value(spark, planted):
    forest = models.fit(planted, "RandomForest")
    leaves = attribution.forest_leaves(spark, forest)
    frame = planted.limit(30)
    score = {r.row_id: r.score for r in models.predict(forest, frame).collect()}
    rows = {r.row_id: r.features.toArray() for r in frame.collect()}
    made = attribution.tree_attribution(frame, forest).collect()
    assert len(made) == 30
    for r in made:
        assert r.base + sum(r.effects) == pytest.approx(score[r.row_id], abs=1e-8)
        assert r.effects == pytest.approx(brute_shapley(rows[r.row_id], leaves), abs=1e-9)
    means = {r.feature: r.mean_abs_attribution for r in attribution.mean_attribution(attribution.tree_attribution(planted, forest), ["x", "noise", "gap"]).collect()}
    assert max(means, key=means.get) == "x"


def test_users_at_high_risk_are_those_of_the_last_day(spark, monkeypatch):
    w = Warehouse(spark, "/root/testdata/sf0.001", as_of=datetime.date(1996, 3, 1))
    late = features.user_features(w.purchases, w.order_day, horizon=0).cache()
    recency = {r.user_id: r.recency_days for r in late.collect()}
    young = {r.user_id for r in late.filter("tenure_days < 30").collect()}
    assert young
    risky = late.select("user_id", F.when(F.col("tenure_days") < 30, 0.99).otherwise(0.8).alias("churn_prob"), F.lit("高").alias("risk_level"))
    monkeypatch.setattr(learning, "churn_gbt", lambda _: risky)
    out = learning.churn_high10(w).collect()
    assert all(r.recency_days == recency[r.user_id] for r in out) and {r.user_id for r in out} & young


def test_no_word_of_the_lexicon_is_lost(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(300))) for i in range(20)] + [(90, "w0x0 w19x299 unknown"), (91, ""), (92, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    moods = spark.createDataFrame([(i, "positive" if i < 8 else "negative") for i in range(20)], "doc_id long, sentiment string")
    lexicon = keywords.sentiment_lexicon(documents, moods)
    assert lexicon.count() == 6000
    scored = {r.doc_id: (r.matched, r.sentiment) for r in keywords.lexicon_score(documents, lexicon).collect()}
    assert len(scored) == 23 and all(scored[i] == (300, "positive" if i < 8 else "negative") for i in range(20))
    assert scored[90][0] == 2 and scored[91] == scored[92] == (0, "neutral")


def test_models_of_two_days_differ(spark):
    root = "/root/testdata/sf0.001"
    default, earlier = (learning.churn_suite(Warehouse(spark, root, as_of=day)).frame for day in (None, datetime.date(1998, 1, 1)))
    assert default is learning.churn_suite(Warehouse(spark, root)).frame
    assert default.agg(F.sum("label")).first() != earlier.agg(F.sum("label")).first()


def test_holdout_is_in_no_fold_and_predictions_cover_the_last_day(spark):
    w = Warehouse(spark, "/root/testdata/sf0.001")
    suite = learning.churn_suite(w)
    parts = {r.fold: r.n for r in suite.frame.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(parts) == {-1, *range(models.FOLDS)}
    scored = learning.churn_predictions(w, "LogisticRegression")
    assert scored.count() == w.purchases.select("user_id").distinct().count() >= suite.frame.count()
    assert scored.filter("churn_prob < 0 or churn_prob > 1 or churn_prob is null").count() == 0


def test_metrics_do_not_build_the_rows_to_be_predicted(spark, monkeypatch):
    """Only predictions read the features of the last day; the bounds and ranks of the labels read totals, not facts."""
    made = []
    monkeypatch.setattr(models, "scoring_frame", lambda data, *_: made.append(data) or data)
    w = Warehouse(spark, "/root/testdata/sf0.001", as_of=datetime.date(1997, 7, 7))
    suites = [learning.suite_of(w, kind) for kind in ("hot", "churn")]
    assert all(s.frame.count() for s in suites) and not made
    assert suites[0].ahead is suites[0].ahead and suites[1].ahead is suites[1].ahead and len(made) == 2


def test_labels_read_the_facts_once(spark, monkeypatch):
    cut = []
    monkeypatch.setattr(features, "cut_lineage", lambda df: cut.append(df) or df)
    day = datetime.date(2024, 1, 1)
    facts = spark.createDataFrame([(i, day, 1, float(i + j)) for i in range(20) for j in range(3)], "song_id long, dt date, likes long, amount double")
    out = features.hot_label(facts).collect()
    assert len(cut) == 1 and cut[0].count() == 20
    assert sorted(r.song_id for r in out if r.is_hot) == [18, 19]


def test_lexicon_of_any_size_reads_the_texts_once(spark):
    texts = ["good good day the", "bad day", "the the", "", None, "音乐很好 good", "rare word bad bad"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    listed = [("good", 0.7, 9), ("day", -0.1, 8), ("bad", -0.9, 7), ("音乐", 0.3, 2), ("rare", 0.2, 1)]
    lexicon = spark.createDataFrame(listed, "word string, weight double, occurrences long")
    whole = {r.doc_id: r for r in keywords.lexicon_score(documents, lexicon).collect()}
    assert [whole[i].matched for i in range(7)] == [3, 2, 0, 0, 0, 2, 3]
    assert whole[0].score == pytest.approx(1.3 / 3, abs=1e-6) and whole[6].score == pytest.approx(-1.6 / 3, abs=1e-6) and whole[3].score is None
    for frequent in (1, 2, 5):
        frame = keywords.lexicon_score(documents, lexicon, frequent)
        assert {r.doc_id: r for r in frame.collect()} == whole
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
