"""Probabilities against published tables, tests and evaluation against hand-computed values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from refrain.functions import probability as P
from refrain.operators import evaluate, statistics as T


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("z, p", [(0.0, 1.0), (1.0, 0.317311), (1.959964, 0.05), (2.575829, 0.01), (-3.290527, 0.001)])
def test_normal(spark, z, p):
    assert value(spark, P.normal_two_sided(F.lit(z))) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("t, df, p", [(2.228, 10, 0.05), (2.042, 30, 0.05), (2.750, 30, 0.01), (1.984, 100, 0.05)])
def test_student(spark, t, df, p):
    assert value(spark, P.t_two_sided(F.lit(t), F.lit(df))) == pytest.approx(p, abs=5e-4)


@pytest.mark.parametrize("x, df, p", [(5.991, 2, 0.05), (9.488, 4, 0.05), (18.307, 10, 0.05), (23.209, 10, 0.01)])
def test_chi_square(spark, x, df, p):
    assert value(spark, P.chi2_upper(F.lit(x), F.lit(df))) == pytest.approx(p, abs=1.5e-3)
    assert value(spark, P.chi2_one(F.lit(3.841459))) == pytest.approx(0.05, abs=1e-6)


NAMES = {"test_id": 1, "name": "t", "metric": "m"}


def sample(spark, **groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "grp string, value double")


def test_mann_whitney_with_ties(spark):
    a, b = [1, 2, 2, 5, 9], [2, 3, 3, 8]
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    row = T.mann_whitney(sample(spark, a=a, b=b), "a", "b", **NAMES).first()
    assert row.statistic == u
    assert row.effect_size == pytest.approx(2 * u / (len(a) * len(b)) - 1, abs=1e-6)


def test_rank_tests_on_all_tied_values(spark):
    tied = sample(spark, a=[1, 1], b=[1, 1, 1])
    row = T.mann_whitney(tied, "a", "b", **NAMES).first()
    assert row.statistic == 3.0 and row.effect_size == 0.0
    assert T.kruskal(tied, **NAMES).first().statistic is None


def test_kruskal_three_groups(spark):
    row = T.kruskal(sample(spark, a=[1, 2, 3], b=[4, 5, 6], c=[7, 8, 9]), **NAMES).first()
    assert row.statistic == pytest.approx(7.2)
    assert row.sample_size == 9


def test_independence_counts_empty_cells(spark):
    table = spark.createDataFrame([("x", "p", 10), ("y", "q", 10)], "a string, b string, n long")
    row = T.chi2_independence(table, **NAMES).first()
    assert row.statistic == pytest.approx(20.0) and row.effect_size == pytest.approx(1.0)


def test_even_split(spark):
    counts = spark.createDataFrame([(154946, 31988)], "x long, y long")
    row = T.chi2_even(counts, **NAMES).first()
    assert row.effect_size == pytest.approx(0.657762, abs=1e-6)


def test_ab_lift_and_interval(spark):
    rng = random.Random(3)
    a = [rng.gauss(10, 2) for _ in range(400)]
    b = [rng.gauss(11, 2) for _ in range(400)]
    row = T.ab_test(sample(spark, control=a, treatment=b), name="n", metric="m").first()
    assert row.lift_ratio == pytest.approx(row.treatment_mean / row.control_mean - 1, abs=1e-5)
    assert row.ci_lower < row.lift_ratio < row.ci_upper
    assert row.is_significant == 1 and "显著高于" in row.conclusion


def test_assignment_is_stable_under_partitioning(spark):
    users = spark.range(1000).withColumnRenamed("id", "user_id")
    one = {r.user_id: r.grp for r in T.assign(users.coalesce(1), "s").collect()}
    many = {r.user_id: r.grp for r in T.assign(users.repartition(7), "s").collect()}
    assert one == many and 400 < sum(g == T.CONTROL for g in one.values()) < 600


def scored(spark, n=300, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = int(rng.random() < 0.3)
        rows.append((i, label, round(rng.random() * 0.7 + 0.3 * label, 1)))
    return rows, spark.createDataFrame(rows, "row_id long, label long, score double")


def test_auc_and_average_precision(spark):
    rows, frame = scored(spark)
    pos = [s for _, y, s in rows if y]
    neg = [s for _, y, s in rows if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert evaluate.auc(frame).first().auc == pytest.approx(want)
    ap, before = 0.0, 0.0
    for cut in sorted({s for *_, s in rows}, reverse=True):
        tp = sum(s >= cut for s in pos)
        recall = tp / len(pos)
        ap += (recall - before) * tp / (tp + sum(s >= cut for s in neg))
        before = recall
    assert evaluate.average_precision(frame).first().pr_auc == pytest.approx(ap)


def test_auc_without_one_class(spark):
    frame = spark.createDataFrame([(1, 1, 0.5)], "row_id long, label long, score double")
    assert evaluate.auc(frame).first().auc is None


def test_poisson_weights(spark):
    steps = evaluate.poisson_thresholds()
    assert steps == sorted(steps) and steps[0] == math.floor(math.exp(-1) * 2**32)
    drawn = evaluate.poisson_weights([str(i) for i in range(5000)], 4)
    assert drawn.shape == (5000, 4) and drawn.mean() == pytest.approx(1, abs=0.05) and drawn.var() == pytest.approx(1, abs=0.08)
    assert (evaluate.poisson_weights(["7"], 9)[0, :4] == drawn[7]).all()


# published two-sided 5 % points of Student's t
@pytest.mark.parametrize("df, t", [(1, 12.7062), (2, 4.30265), (3, 3.18245), (4, 2.77645), (9, 2.26216), (29, 2.04523), (120, 1.97993), (1_000_000, 1.95997)])
def test_t_quantiles(spark, df, t):
    assert value(spark, P.t_quantile_95(F.lit(df))) == pytest.approx(t, rel=1e-4)


@pytest.mark.parametrize("n, t", [(5, 2.776445), (10, 2.262157), (30, 2.045230)])
def test_interval_of_a_small_sample(spark, n, t):
    rng = random.Random(n)
    values = [rng.gauss(1, 2) for _ in range(n)]
    mean = sum(values) / n
    half = t * math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1) / n)
    row = T.t_one_sample(spark.createDataFrame([(v,) for v in values], "value double"), test_id=1, name="n", metric="m").first()
    assert (row.ci_lower, row.ci_upper) == pytest.approx((mean - half, mean + half), abs=1e-3)


def plain_bootstrap(rows, replicates):
    """AUC of every replicate by comparing all pairs."""
    out = []
    weights = evaluate.poisson_weights([str(r[0]) for r in rows], replicates)
    for b in range(replicates):
        pos = [(s, w) for (_, label, s), w in zip(rows, weights[:, b]) if label and w]
        neg = [(s, w) for (_, label, s), w in zip(rows, weights[:, b]) if not label and w]
        every = sum(w for _, w in pos) * sum(w for _, w in neg)
        won = sum(w * v * (1 if s > t else 0.5 if s == t else 0) for s, w in pos for t, v in neg)
        out.append(won / every)
    return out


@pytest.mark.parametrize("scores", [lambda r: round(r.random(), 1), lambda r: r.random(), lambda r: 0.5])
def test_bootstrap_equals_all_pairs_with_shared_scores(spark, scores):
    rng = random.Random(3)
    rows = [(i, int(rng.random() < 0.4), scores(rng)) for i in range(300)]
    frame = spark.createDataFrame([(g, *r) for g in ("a", "b") for r in rows], "g string, row_id long, label long, score double")
    want = plain_bootstrap(rows, 20)
    for row in evaluate.bootstrap_auc(frame, ["g"], replicates=20).collect():
        assert row.replicates == 20 and row.auc_mean == pytest.approx(sum(want) / 20, abs=1e-6)


def test_bootstrap_shuffles_each_row_once(spark):
    frame = spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") % 2).alias("label"), F.rand(1).alias("score"))
    plan = evaluate.bootstrap_segments(frame, [], 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan


def test_bootstrap_brackets_the_auc(spark):
    _, frame = scored(spark)
    auc = evaluate.auc(frame).first().auc
    row = evaluate.bootstrap_auc(frame, replicates=50).first()
    assert row.replicates == 50 and row.auc_ci_lower < auc < row.auc_ci_upper
