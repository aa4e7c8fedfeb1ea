"""Comparison SQL of hypothesis tests and experiments."""

import math

from checks.sql import cte, exact_mean, statement

ORACLES: dict[str, str] = {}


def add(name: str, deps: str, body: str) -> None:
    ORACLES[name] = statement(deps, body)


def erfc(x: str) -> str:
    t = f"(1 / (1 + 0.3275911::DOUBLE * ({x})))"
    poly = f"((((1.061405429::DOUBLE * {t} - 1.453152027::DOUBLE) * {t} + 1.421413741::DOUBLE) * {t} - 0.284496736::DOUBLE) * {t} + 0.254829592::DOUBLE) * {t}"
    return f"({poly} * exp(-(({x}) * ({x}))))"


def p_normal(z: str) -> str:
    return erfc(f"abs({z}) / sqrt(2.0::DOUBLE)")


def p_upper(z: str) -> str:
    return f"(CASE WHEN {z} >= 0 THEN {p_normal(z)} / 2 ELSE 1 - {p_normal(z)} / 2 END)"


def p_t(t: str, df: str) -> str:
    return p_normal(f"(sqrt({df} * ln(1 + {t} * {t} / {df})) * (8 * {df} + 1) / (8 * {df} + 3))")


def p_chi2(x: str, df: str) -> str:
    return p_upper(f"((pow({x} / {df}, 1.0::DOUBLE / 3) - (1 - 2.0::DOUBLE / (9 * {df}))) / sqrt(2.0::DOUBLE / (9 * {df})))")


def t_95(df: str) -> str:
    """Two-sided 5 % point of Student's t by Hill's expansion, step by step over one-element lists."""
    p, x = 0.05, -1.959964
    far = "(((((0.4 * x * x + 6.3) * x * x + 36) * x * x + 94.5) / w - x * x - 3) / b + 1) * x".replace("x", f"({x}::DOUBLE)")
    wide = f"((((0.05 * d * ({x}) - 5) * ({x}) - 7) * ({x}) - 2) * ({x}) + b + c + CASE WHEN n < 5 THEN 0.3 * (n - 4.5) * ({x} + 0.6) ELSE 0 END)"
    near = "((1 / (((n + 6) / (n * y) - 0.089 * d - 0.822) * (n + 2) * 3) + 0.5 / (n + 4)) * y - 1) * (n + 1) / (n + 2) + 1 / y"
    steps = [
        ("n", f"CAST({df} AS DOUBLE)"),
        ("a", "1 / (n - 0.5::DOUBLE)"),
        ("b", "48 / (a * a)"),
        ("c", "((20700 * a / b - 98) * a - 16) * a + 96.36::DOUBLE"),
        ("d", f"((94.5 / (b + c) - 3) / b + 1) * sqrt(a * {math.pi / 2!r}::DOUBLE) * n"),
        ("y", f"pow(d * {p}, 2 / n)"),
        ("w", wide),
    ]
    out = f"sqrt(n * CASE WHEN y > 0.05 + a THEN exp(a * ({far}) * ({far})) - 1 ELSE {near} END)"
    for name, value in reversed(steps):
        out = f"list_transform([{value}], lambda {name}: {out})[1]"
    two, one = math.sqrt(2 / (p * (2 - p)) - 2), math.cos(p * math.pi / 2) / math.sin(p * math.pi / 2)
    return f"(CASE WHEN {df} < 1.5 THEN {one!r}::DOUBLE WHEN {df} = 2 THEN {two!r}::DOUBLE ELSE {out} END)"


VERDICT = "CASE WHEN p < 0.05 THEN '显著' ELSE '不显著' END"
Z = "1.959964::DOUBLE"


def result(test_id: int, name: str, kind: str, metric: str, source: str, text: str) -> str:
    return f"""SELECT CAST({test_id} AS BIGINT) AS test_id, '{name}' AS test_name, '{kind}' AS test_type, '{metric}' AS metric_name,
       CAST(n AS BIGINT) AS sample_size, round(stat, 6) AS statistic, round(p, 6) AS p_value, round(effect, 6) AS effect_size,
       round(CAST(lo AS DOUBLE), 6) AS ci_lower, round(CAST(hi AS DOUBLE), 6) AS ci_upper, {text} AS conclusion FROM {source}"""


cte(
    "growth_sample",
    "comment_raw",
    """SELECT cur / prev - 1 AS value FROM (
    SELECT n AS cur, lag(n) OVER (PARTITION BY song_id ORDER BY yw) AS prev FROM (
        SELECT year(s) * 100 + ceil(dayofyear(s) / 7.0) AS yw, song_id, count(*) AS n FROM (
            SELECT song_id, CAST(comment_time AS DATE) - CAST(dayofweek(comment_time) AS INTEGER) AS s FROM comment_raw)
        GROUP BY 1, 2)) WHERE prev > 0""",
)
cte(
    "t1_base",
    "growth_sample",
    "SELECT *, sd / sqrt(n) AS se, mean / (sd / sqrt(n)) AS stat, mean / sd AS effect FROM (SELECT count(*) AS n, avg(value) AS mean, stddev_samp(value) AS sd FROM growth_sample)",
)
cte(
    "t1_row",
    "t1_base",
    f"SELECT *, {p_t('stat', '(n - 1)')} AS p, mean - {t_95('(n - 1)')} * se AS lo, mean + {t_95('(n - 1)')} * se AS hi FROM t1_base",
)
cte(
    "t1",
    "t1_row",
    result(1, "评论增长率是否显著异于0", "t_test", "growth_rate", "t1_row",
           f"printf('均值=%.4f, %s(p=%.4f), 95%%CI=[%.4f,%.4f]', mean, {VERDICT}, p, lo, hi)"),
)


def ranked(prefix: str, sample: str) -> None:
    """Average ranks of every row by window functions."""
    cte(
        f"{prefix}_ranks",
        sample,
        f"""SELECT grp, value, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0::DOUBLE AS avg_rank,
       count(*) OVER (PARTITION BY value) AS tied FROM {sample} WHERE value IS NOT NULL""",
    )


cte(
    "heat_means",
    "song_daily",
    f"SELECT song_id, {exact_mean('heat_score')} AS mean_heat FROM song_daily GROUP BY 1",
)
cte(
    "heat_sample",
    "heat_means song_daily",
    f"""SELECT CASE WHEN m.mean_heat >= (SELECT {exact_mean('mean_heat')} FROM heat_means) THEN 'high' ELSE 'low' END AS grp,
       d.comment_count AS value FROM song_daily d JOIN heat_means m USING (song_id)""",
)
ranked("heat", "heat_sample")
cte(
    "mw_base",
    "heat_ranks",
    """SELECT na, nb, n, ties, ma, mb, r - na * (na + 1) / 2 AS stat FROM (
    SELECT CAST(count(*) FILTER (WHERE grp = 'high') AS DOUBLE) AS na, CAST(count(*) FILTER (WHERE grp = 'low') AS DOUBLE) AS nb,
           CAST(count(*) AS DOUBLE) AS n, sum(avg_rank) FILTER (WHERE grp = 'high') AS r,
           sum(CAST(tied AS DOUBLE) * tied - 1) AS ties,
           avg(value) FILTER (WHERE grp = 'high') AS ma, avg(value) FILTER (WHERE grp = 'low') AS mb FROM heat_ranks)""",
)
cte(
    "mw_row",
    "mw_base",
    f"""SELECT *, {p_normal('((stat - na * nb / 2) / sqrt(na * nb / 12 * (n + 1 - ties / (n * (n - 1)))))')} AS p,
       2 * stat / (na * nb) - 1 AS effect, NULL AS lo, NULL AS hi FROM mw_base""",
)
cte(
    "t2",
    "mw_row",
    result(2, "高热度组vs低热度组评论数差异", "mannwhitney", "comment_count", "mw_row",
           f"printf('高热度组均值=%.1f, 低热度组均值=%.1f, %s(p=%.4f)', ma, mb, {VERDICT}, p)"),
)
cte(
    "gof_base",
    "comment_sentiment",
    """SELECT x, y, x + y AS n, (x - y) * (x - y) / (x + y) AS stat, abs(x - y) / (x + y) AS effect, x / (x + y) AS share FROM (
    SELECT CAST(count(*) FILTER (WHERE sentiment = 'positive') AS DOUBLE) AS x, CAST(count(*) FILTER (WHERE sentiment = 'negative') AS DOUBLE) AS y
    FROM comment_sentiment)""",
)
cte(
    "gof_row",
    "gof_base",
    f"""SELECT *, {p_normal('sqrt(stat)')} AS p, share - {Z} * sqrt(share * (1 - share) / n) AS lo, share + {Z} * sqrt(share * (1 - share) / n) AS hi FROM gof_base""",
)
cte(
    "t3",
    "gof_row",
    result(3, "正面vs负面评论比例是否偏离50/50", "chi2", "sentiment", "gof_row",
           f"printf('正面=%d(%.1f%%), 负面=%d(%.1f%%), %s偏离50/50(p=%.4f)', CAST(x AS BIGINT), share * 100, CAST(y AS BIGINT), 100 - share * 100, {VERDICT}, p)"),
)


def welch(prefix: str, sample: str, first: str, second: str) -> None:
    cte(
        f"{prefix}_moments",
        sample,
        f"""SELECT CAST(count(*) FILTER (WHERE grp = '{first}') AS DOUBLE) AS n1, CAST(count(*) FILTER (WHERE grp = '{second}') AS DOUBLE) AS n2,
       avg(value) FILTER (WHERE grp = '{first}') AS m1, avg(value) FILTER (WHERE grp = '{second}') AS m2,
       var_samp(value) FILTER (WHERE grp = '{first}') AS v1, var_samp(value) FILTER (WHERE grp = '{second}') AS v2 FROM {sample}""",
    )
    cte(
        f"{prefix}_terms",
        f"{prefix}_moments",
        f"""SELECT *, n1 + n2 AS n, m2 - m1 AS diff, sqrt(v1 / n1 + v2 / n2) AS se, (m2 - m1) / sqrt(v1 / n1 + v2 / n2) AS stat,
       pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df,
       (m2 - m1) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) AS effect FROM {prefix}_moments""",
    )
    cte(
        f"{prefix}_row",
        f"{prefix}_terms",
        f"SELECT *, {p_t('stat', 'df')} AS p, diff - {t_95('df')} * se AS lo, diff + {t_95('df')} * se AS hi FROM {prefix}_terms",
    )


cte(
    "weekend_sample",
    "comment_raw",
    "SELECT CASE WHEN isodow(comment_time) > 5 THEN 'weekend' ELSE 'weekday' END AS grp, like_count AS value, event_type FROM comment_raw",
)
welch("weekend", "weekend_sample", "weekday", "weekend")
cte(
    "t4",
    "weekend_row",
    result(4, "工作日vs周末获赞差异", "welch_t", "like_count", "weekend_row",
           f"printf('weekday均值=%.4f, weekend均值=%.4f, %s(p=%.4f)', m1, m2, {VERDICT}, p)"),
)
cte(
    "cells",
    "weekend_sample",
    """SELECT a.event_type, b.grp, (SELECT count(*) FROM weekend_sample s WHERE s.event_type = a.event_type AND s.grp = b.grp) AS o,
       a.n * b.n / (SELECT CAST(count(*) AS DOUBLE) FROM weekend_sample) AS e
FROM (SELECT event_type, CAST(count(*) AS DOUBLE) AS n FROM weekend_sample GROUP BY 1) a,
     (SELECT grp, CAST(count(*) AS DOUBLE) AS n FROM weekend_sample GROUP BY 1) b""",
)
cte(
    "ind_base",
    "cells",
    """SELECT sum((o - e) * (o - e) / e) AS stat, CAST(sum(o) AS DOUBLE) AS n,
       CAST((count(DISTINCT event_type) - 1) * (count(DISTINCT grp) - 1) AS DOUBLE) AS df,
       least(count(DISTINCT event_type), count(DISTINCT grp)) - 1 AS least_dim FROM cells""",
)
cte(
    "ind_row",
    "ind_base",
    f"SELECT *, {p_chi2('stat', 'df')} AS p, sqrt(stat / (n * least_dim)) AS effect, NULL AS lo, NULL AS hi FROM ind_base",
)
cte(
    "t5",
    "ind_row",
    result(5, "互动类型与周末是否独立", "chi2_independence", "event_type", "ind_row",
           f"printf('自由度=%d, %s(p=%.4f)', CAST(df AS BIGINT), {VERDICT}, p)"),
)
cte("type_sample", "comment_raw", "SELECT event_type AS grp, like_count AS value FROM comment_raw")
ranked("type", "type_sample")
cte(
    "kw_base",
    "type_ranks",
    """SELECT groups, n, (12 / (n * (n + 1)) * rr - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS stat FROM (
    SELECT count(*) AS groups, CAST(sum(k) AS DOUBLE) AS n, sum(r * r / k) AS rr, sum(t) AS ties FROM (
        SELECT grp, count(*) AS k, sum(avg_rank) AS r, sum(CAST(tied AS DOUBLE) * tied - 1) AS t FROM type_ranks GROUP BY grp))""",
)
cte(
    "kw_row",
    "kw_base",
    f"SELECT *, {p_chi2('greatest(stat, 0.0::DOUBLE)', '(groups - 1)')} AS p, (stat - groups + 1) / (n - groups) AS effect, NULL AS lo, NULL AS hi FROM kw_base",
)
cte(
    "t6",
    "kw_row",
    result(6, "各互动类型获赞差异", "kruskal", "like_count", "kw_row",
           f"printf('%d组, H=%.4f, %s(p=%.4f)', groups, stat, {VERDICT}, p)"),
)
_ALL = "t1 t2 t3 t4 t5 t6"
cte("stat_tests", _ALL, " UNION ALL ".join(f"SELECT * FROM {t}" for t in _ALL.split()))
for _name, _table in (
    ("st_t_one_sample", "t1"),
    ("st_mannwhitney", "t2"),
    ("st_chi2_gof", "t3"),
    ("st_t_two_sample", "t4"),
    ("st_chi2_independence", "t5"),
    ("st_kruskal", "t6"),
):
    add(_name, _table, f"SELECT * FROM {_table}")
add("st_pvalue", "stat_tests", "SELECT test_id, test_type, statistic, p_value FROM stat_tests")
add("fd_stat_tests", "stat_tests", "SELECT test_name, test_type, p_value, effect_size, conclusion FROM stat_tests")
add("gd_stat_tests", "stat_tests", "SELECT * EXCLUDE (test_id) FROM stat_tests")
add(
    "js_significance",
    "stat_tests",
    "SELECT test_name, p_value, CASE WHEN p_value < 0.05 THEN '显著' ELSE '不显著' END AS significance FROM stat_tests",
)

# Experiments
cte(
    "assigned",
    "user_info",
    """SELECT user_id, CASE WHEN substr(md5(CAST(user_id AS VARCHAR) || 'push-2024'), 1, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e')
       THEN 'control' ELSE 'treatment' END AS grp FROM user_info""",
)
cte(
    "ab_sample",
    "assigned",
    "SELECT user_id, grp, (SELECT count(*) FROM orders o WHERE o.o_custkey = a.user_id) AS value FROM assigned a",
)
welch("ab", "ab_sample", "control", "treatment")
cte(
    "ab",
    "ab_row",
    """SELECT '推送通知对评论数的影响' AS test_name, 'comment_count' AS metric_name, round(m1, 6) AS control_mean, round(m2, 6) AS treatment_mean,
       round(m2 / m1 - 1, 6) AS lift_ratio, CAST(n AS BIGINT) AS sample_size, round(stat, 6) AS statistic, round(p, 6) AS p_value,
       round(effect, 6) AS effect_size, round(lo / m1, 6) AS ci_lower, round(hi / m1, 6) AS ci_upper, CAST(p < 0.05 AS BIGINT) AS is_significant,
       printf('实验组评论数 %s 对照组 (提升 %.2f%%, p=%.4f, 95%%CI=[%.2f%%, %.2f%%], Cohen d=%.4f)',
              CASE WHEN p >= 0.05 THEN '未显著高于' WHEN m2 > m1 THEN '显著高于' ELSE '显著低于' END,
              (m2 / m1 - 1) * 100, p, lo / m1 * 100, hi / m1 * 100, effect) AS conclusion FROM ab_row""",
)
add("ab_assign", "assigned", "SELECT * FROM assigned")
cte(
    "ab_counts",
    "assigned",
    "SELECT count(*) FILTER (WHERE grp = 'control') AS c, count(*) FILTER (WHERE grp = 'treatment') AS t FROM assigned",
)
add(
    "ab_balance",
    "ab_counts",
    f"""SELECT control_users, treatment_users, round(s, 6) AS statistic, round(p, 6) AS p_value, CAST(p >= 0.05 AS BIGINT) AS is_balanced FROM (
    SELECT *, {p_normal('sqrt(s)')} AS p FROM (SELECT c AS control_users, t AS treatment_users, pow(CAST(c - t AS DOUBLE), 2) / (c + t) AS s FROM ab_counts))""",
)
add(
    "ab_sample_size",
    "ab_sample",
    """SELECT round(m, 6) AS mean, round(sd, 6) AS sd, round(m * 0.05::DOUBLE, 6) AS delta,
       CAST(ceil(2 * pow((1.959964::DOUBLE + 0.841621::DOUBLE) * sd / (m * 0.05::DOUBLE), 2)) AS BIGINT) AS users_per_group
FROM (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM ab_sample)""",
)
add("ab_test", "ab", "SELECT * FROM ab")
add("fd_ab_test", "ab", "SELECT * EXCLUDE (sample_size, statistic) FROM ab LIMIT 1")
add("gd_ab_report", "ab", "SELECT * FROM ab")
