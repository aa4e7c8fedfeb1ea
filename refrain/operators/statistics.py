"""Hypothesis tests and experiment analysis.

Every test is one or two aggregations; the result is one row with a common schema. Rank tests
group equal values first and add up counts over the distinct values with range-partitioned
running totals, so neither a frequent value nor the whole sample meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.ordering import running_totals
from refrain.functions.probability import (
    Z_95,
    Z_POWER_80,
    chi2_one,
    chi2_upper,
    normal_two_sided,
    t_quantile_95,
    t_two_sided,
)

ALPHA = 0.05


def verdict(p: Column) -> Column:
    return F.when(p < ALPHA, L.SIGNIFICANT).otherwise(L.NOT_SIGNIFICANT)


def _result(
    frame: DataFrame, test_id: int, name: str, kind: str, metric: str, conclusion: Column
) -> DataFrame:
    """Common schema; ``frame`` has n, stat, p, effect, lo, hi as unrounded doubles."""
    return frame.select(
        F.lit(test_id).cast("long").alias("test_id"),
        F.lit(name).alias("test_name"),
        F.lit(kind).alias("test_type"),
        F.lit(metric).alias("metric_name"),
        F.col("n").cast("long").alias("sample_size"),
        F.round("stat", 6).alias("statistic"),
        F.round("p", 6).alias("p_value"),
        F.round("effect", 6).alias("effect_size"),
        F.round(F.col("lo").cast("double"), 6).alias("ci_lower"),
        F.round(F.col("hi").cast("double"), 6).alias("ci_upper"),
        conclusion.alias("conclusion"),
    )


def t_one_sample(sample: DataFrame, *, test_id: int, name: str, metric: str) -> DataFrame:
    """Mean of ``value`` against 0; effect is mean / sd."""
    value = F.col("value")
    row = (
        sample.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
        .withColumn("se", F.col("sd") / F.sqrt("n"))
        .withColumns({"stat": F.try_divide("mean", "se"), "effect": F.try_divide("mean", "sd")})
        .withColumns(
            {
                "p": t_two_sided(F.col("stat"), F.col("n") - 1),
                "lo": F.col("mean") - t_quantile_95(F.col("n") - 1) * F.col("se"),
                "hi": F.col("mean") + t_quantile_95(F.col("n") - 1) * F.col("se"),
            }
        )
    )
    text = F.format_string(
        "均值=%.4f, %s(p=%.4f), 95%%CI=[%.4f,%.4f]", "mean", verdict(F.col("p")), "p", "lo", "hi"
    )
    return _result(row, test_id, name, "t_test", metric, text)


def moments(sample: DataFrame, first: str, second: str) -> DataFrame:
    """One row with count, mean and variance of both groups of (grp, value)."""
    parts = []
    for tag, group in (("1", first), ("2", second)):
        value = F.when(F.col("grp") == group, F.col("value").cast("double"))
        parts += [
            F.count(value).alias(f"n{tag}"),
            F.avg(value).alias(f"m{tag}"),
            F.var_samp(value).alias(f"v{tag}"),
        ]
    return sample.agg(*parts)


def welch(row: DataFrame) -> DataFrame:
    """Welch's t of group 2 against group 1 with Cohen's d over the pooled variance."""
    n1, n2, v1, v2 = F.col("n1"), F.col("n2"), F.col("v1"), F.col("v2")
    a, b = v1 / n1, v2 / n2
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    return (
        row.withColumns({"diff": F.col("m2") - F.col("m1"), "se": F.sqrt(a + b)})
        .withColumns(
            {
                "n": n1 + n2,
                "df": (a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1)),
                "stat": F.try_divide("diff", "se"),
                "effect": F.try_divide("diff", F.sqrt(pooled)),
            }
        )
        .withColumns(
            {
                "p": t_two_sided(F.col("stat"), F.col("df")),
                "lo": F.col("diff") - t_quantile_95(F.col("df")) * F.col("se"),
                "hi": F.col("diff") + t_quantile_95(F.col("df")) * F.col("se"),
            }
        )
    )


def t_two_sample(
    sample: DataFrame, first: str, second: str, *, test_id: int, name: str, metric: str
) -> DataFrame:
    row = welch(moments(sample, first, second))
    text = F.format_string("%s均值=%.4f, %s均值=%.4f, %s(p=%.4f)", F.lit(first), "m1", F.lit(second), "m2", verdict(F.col("p")), "p")
    return _result(row, test_id, name, "welch_t", metric, text)


def _exact(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def rank_counts(sample: DataFrame) -> DataFrame:
    """Per distinct value: rows (n) and twice the average rank (rank2, a whole number)."""
    counts = sample.filter(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    summed = running_totals(counts, ["value"], {"upto": "n"})
    return summed.select("value", "n", (2 * F.col("upto") - F.col("n") + 1).alias("rank2"))


def _ties(n: Column) -> Column:
    wide = n.cast("double")
    return F.sum(wide * wide * wide - wide)


def mann_whitney(
    sample: DataFrame, first: str, second: str, *, test_id: int, name: str, metric: str
) -> DataFrame:
    """U of ``first``, tie-corrected z, rank-biserial effect (positive when ``first`` ranks higher)."""
    both = sample.filter(F.col("value").isNotNull() & F.col("grp").isin(first, second))
    counts = both.groupBy("value").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("grp") == first).alias("a"),
        F.sum(F.when(F.col("grp") == first, F.col("value"))).alias("sa"),
        F.sum(F.when(F.col("grp") == second, F.col("value"))).alias("sb"),
    )
    ranked = running_totals(counts, ["value"], {"upto": "n"})
    rank2 = _exact(2 * F.col("upto") - F.col("n") + 1)
    row = ranked.agg(
        F.sum("a").alias("na"),
        F.sum("n").alias("n"),
        F.sum(_exact(F.col("a")) * rank2).cast("double").alias("r2"),
        _ties(F.col("n")).alias("ties"),
        F.sum("sa").alias("sa"),
        F.sum("sb").alias("sb"),
    )
    na, n = F.col("na").cast("double"), F.col("n").cast("double")
    nb = n - na
    spread = F.sqrt(na * nb / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    row = (
        row.withColumns({"stat": F.col("r2") / 2 - na * (na + 1) / 2, "nb": nb})
        .withColumns(
            {
                "p": normal_two_sided(F.try_divide(F.col("stat") - na * F.col("nb") / 2, spread)),
                "effect": 2 * F.col("stat") / (na * F.col("nb")) - 1,
                "lo": F.lit(None).cast("double"),
                "hi": F.lit(None).cast("double"),
                "ma": F.col("sa") / na,
                "mb": F.col("sb") / F.col("nb"),
            }
        )
    )
    text = F.format_string(
        "高热度组均值=%.1f, 低热度组均值=%.1f, %s(p=%.4f)", "ma", "mb", verdict(F.col("p")), "p"
    )
    return _result(row, test_id, name, "mannwhitney", metric, text)


def kruskal(sample: DataFrame, *, test_id: int, name: str, metric: str) -> DataFrame:
    """Kruskal-Wallis H over all groups, tie-corrected; effect is eta squared."""
    ranks = rank_counts(sample)
    cells = sample.filter(F.col("value").isNotNull()).groupBy("value", "grp").agg(F.count(F.lit(1)).alias("k"))
    rank_sums = (
        cells.join(ranks, "value")
        .groupBy("grp")
        .agg(F.sum("k").alias("k"), F.sum(_exact(F.col("k")) * _exact(F.col("rank2"))).cast("double").alias("r2"))
    )
    r = F.col("r2") / 2
    groups = rank_sums.agg(
        F.count(F.lit(1)).alias("groups"), F.sum("k").alias("n"), F.sum(r * r / F.col("k")).alias("rr")
    )
    ties = ranks.agg(_ties(F.col("n")).alias("ties")).scalar()
    n, k = F.col("n").cast("double"), F.col("groups").cast("double")
    plain = 12 / (n * (n + 1)) * F.col("rr") - 3 * (n + 1)
    row = (
        groups.withColumn("ties", ties)
        .withColumn("stat", F.try_divide(plain, 1 - F.col("ties") / (n * n * n - n)))
        .withColumns(
            {
                "p": chi2_upper(F.greatest("stat", F.lit(0.0)), k - 1),
                "effect": (F.col("stat") - k + 1) / (n - k),
                "lo": F.lit(None).cast("double"),
                "hi": F.lit(None).cast("double"),
            }
        )
    )
    text = F.format_string("%d组, H=%.4f, %s(p=%.4f)", "groups", "stat", verdict(F.col("p")), "p")
    return _result(row, test_id, name, "kruskal", metric, text)


def chi2_even(counts: DataFrame, *, test_id: int, name: str, metric: str) -> DataFrame:
    """Goodness of fit of two counts (one row: x, y) against 50/50; effect |x - y| / (x + y)."""
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    share = x / (x + y)
    error = F.sqrt(share * (1 - share) / (x + y))
    row = counts.withColumns(
        {
            "n": F.col("x") + F.col("y"),
            "stat": (x - y) * (x - y) / (x + y),
            "effect": F.abs(x - y) / (x + y),
            "lo": share - Z_95 * error,
            "hi": share + Z_95 * error,
            "share": share * 100,
        }
    ).withColumn("p", chi2_one(F.col("stat")))
    text = F.format_string(
        "正面=%d(%.1f%%), 负面=%d(%.1f%%), %s偏离50/50(p=%.4f)",
        "x", "share", "y", 100 - F.col("share"), verdict(F.col("p")), "p",
    )
    return _result(row, test_id, name, "chi2", metric, text)


def chi2_independence(table: DataFrame, *, test_id: int, name: str, metric: str) -> DataFrame:
    """Independence of two categories; ``table`` has a, b, n with one row per cell that occurs.

    A cell that never occurs adds its expected count, which is N minus the expected counts seen.
    """
    everything = Window.partitionBy(F.lit(0))  # windows over the cells of the table only
    cells = table.withColumns(
        {
            "ra": F.sum("n").over(Window.partitionBy("a")).cast("double"),
            "rb": F.sum("n").over(Window.partitionBy("b")).cast("double"),
            "all": F.sum("n").over(everything).cast("double"),
        }
    ).withColumn("e", F.col("ra") * F.col("rb") / F.col("all"))
    gap = F.col("n") - F.col("e")
    row = (
        cells.agg(
            F.countDistinct("a").alias("rows"),
            F.countDistinct("b").alias("columns"),
            F.max("all").alias("n"),
            F.sum(gap * gap / F.col("e")).alias("seen"),
            F.sum("e").alias("expected"),
        )
        .withColumn("stat", F.col("seen") + F.col("n") - F.col("expected"))
        .withColumns(
            {
                "df": ((F.col("rows") - 1) * (F.col("columns") - 1)).cast("double"),
                "effect": F.sqrt(
                    F.greatest("stat", F.lit(0.0)) / (F.col("n") * (F.least("rows", "columns") - 1))
                ),
                "lo": F.lit(None).cast("double"),
                "hi": F.lit(None).cast("double"),
            }
        )
        .withColumn("p", chi2_upper(F.greatest("stat", F.lit(0.0)), F.col("df")))
    )
    text = F.format_string("自由度=%d, %s(p=%.4f)", F.col("df").cast("long"), verdict(F.col("p")), "p")
    return _result(row, test_id, name, "chi2_independence", metric, text)


# Experiments -------------------------------------------------------------------------------

CONTROL, TREATMENT = "control", "treatment"


def assign(users: DataFrame, salt: str) -> DataFrame:
    """Random but repeatable halves: parity of the first digit of a salted digest."""
    digest = F.md5(F.concat(F.col("user_id").cast("string"), F.lit(salt)).cast("binary"))
    digit = F.conv(F.substring(digest, 1, 1), 16, 10).cast("int")
    return users.withColumn("grp", F.when(digit % 2 == 0, CONTROL).otherwise(TREATMENT))


def balance(assigned: DataFrame) -> DataFrame:
    """Sample-ratio check of the two groups."""
    counts = assigned.agg(
        F.count_if(F.col("grp") == CONTROL).alias("control_users"),
        F.count_if(F.col("grp") == TREATMENT).alias("treatment_users"),
    )
    x, y = F.col("control_users").cast("double"), F.col("treatment_users").cast("double")
    return counts.withColumn("__s", (x - y) * (x - y) / (x + y)).select(
        "control_users",
        "treatment_users",
        F.round("__s", 6).alias("statistic"),
        F.round(chi2_one(F.col("__s")), 6).alias("p_value"),
        F.when(chi2_one(F.col("__s")) >= ALPHA, 1).otherwise(0).cast("long").alias("is_balanced"),
    )


def sample_size(sample: DataFrame, *, relative_effect: float = 0.05) -> DataFrame:
    """Users per group to detect a relative change of the mean (alpha 5 %, power 80 %)."""
    row = sample.agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    delta = F.col("mean") * relative_effect
    ratio = (Z_95 + Z_POWER_80) * F.col("sd") / delta
    return row.select(
        F.round("mean", 6).alias("mean"),
        F.round("sd", 6).alias("sd"),
        F.round(delta, 6).alias("delta"),
        F.ceil(2 * ratio * ratio).cast("long").alias("users_per_group"),
    )


def ab_test(sample: DataFrame, *, name: str, metric: str) -> DataFrame:
    """Means, relative lift with its confidence interval, Welch p and Cohen's d."""
    row = welch(moments(sample, CONTROL, TREATMENT))
    base = F.col("m1")
    row = row.withColumns(
        {
            "lift": F.try_divide("m2", "m1") - 1,
            "lo": F.try_divide(F.col("lo"), base),
            "hi": F.try_divide(F.col("hi"), base),
        }
    )
    sure = F.col("p") < ALPHA
    word = F.when(sure & (F.col("lift") > 0), "显著高于").when(sure, "显著低于").otherwise("未显著高于")
    text = F.format_string(
        "实验组评论数 %s 对照组 (提升 %.2f%%, p=%.4f, 95%%CI=[%.2f%%, %.2f%%], Cohen d=%.4f)",
        word, F.col("lift") * 100, "p", F.col("lo") * 100, F.col("hi") * 100, "effect",
    )
    return row.select(
        F.lit(name).alias("test_name"),
        F.lit(metric).alias("metric_name"),
        F.round("m1", 6).alias("control_mean"),
        F.round("m2", 6).alias("treatment_mean"),
        F.round("lift", 6).alias("lift_ratio"),
        F.col("n").cast("long").alias("sample_size"),
        F.round("stat", 6).alias("statistic"),
        F.round("p", 6).alias("p_value"),
        F.round("effect", 6).alias("effect_size"),
        F.round("lo", 6).alias("ci_lower"),
        F.round("hi", 6).alias("ci_upper"),
        sure.cast("int").cast("long").alias("is_significant"),
        text.alias("conclusion"),
    )
