"""Comparison SQL of labels, features, evaluation and forecasts."""

import math

from checks.sql import CTES, cte, exact_mean, min_max, rounded, statement
from refrain.functions.labels import FEATURE_NAMES

ORACLES: dict[str, str] = {}


def add(name: str, deps: str, body: str) -> None:
    ORACLES[name] = statement(deps, body)


cte(
    "item_facts",
    "",
    """SELECT l_partkey AS song_id, CAST(l_shipdate AS DATE) AS dt, CAST(l_quantity AS BIGINT) AS likes, l_returnflag, l_linestatus,
       l_linenumber, l_extendedprice FROM lineitem""",
)
cte(
    "item_months",
    "item_facts",
    """SELECT song_id, year(dt) * 12 + month(dt) AS m, count(*) AS c, CAST(sum(likes) AS BIGINT) AS l,
       count(*) FILTER (WHERE l_returnflag = 'R') AS r,
       round(0.5::DOUBLE * ln(1.0::DOUBLE + count(*)) + 0.3::DOUBLE * ln(1.0::DOUBLE + sum(likes))
             + 0.2::DOUBLE * ln(1.0::DOUBLE + count(*) FILTER (WHERE l_returnflag = 'R')), 6) AS heat
FROM item_facts GROUP BY 1, 2""",
)
cte(
    "item_trends",
    "item_months",
    f"""SELECT song_id, {exact_mean('heat')} AS avg_heat_score, max(heat) AS max_heat_score,
       round(CASE WHEN count(*) > 1 THEN regr_slope(CAST(l AS DOUBLE), CAST(m AS DOUBLE)) END, 6) AS like_trend_slope,
       round(CASE WHEN count(*) > 1 THEN regr_slope(CAST(c AS DOUBLE), CAST(m AS DOUBLE)) END, 6) AS comment_trend_slope,
       round(CASE WHEN count(*) > 1 THEN regr_slope(heat, CAST(m AS DOUBLE)) END, 6) AS heat_trend_slope,
       round(stddev_samp(heat) / nullif(avg(heat), 0), 6) AS heat_volatility FROM item_months GROUP BY 1""",
)
cte(
    "item_totals",
    "item_facts song",
    """SELECT f.song_id, any_value(s.artist_id) AS artist_id, count(*) AS total_comment_count,
       count(*) FILTER (WHERE l_returnflag = 'R') AS total_reply_count, CAST(sum(likes) AS BIGINT) AS total_like_total,
       count(*) FILTER (WHERE l_linestatus = 'F') AS valid_comment_count, count(*) FILTER (WHERE l_returnflag = 'A') AS positives,
       min(dt) AS first_day, count(DISTINCT l_linenumber) AS topic_count
FROM item_facts f JOIN song s USING (song_id) GROUP BY f.song_id""",
)
cte(
    "song_features",
    "item_totals item_trends",
    """SELECT t.song_id, total_comment_count, total_reply_count, total_like_total, valid_comment_count,
       round(total_reply_count / total_comment_count, 6) AS negative_ratio, round(positives / total_comment_count, 6) AS positive_ratio,
       avg_heat_score, max_heat_score,
       date_diff('day', first_day, (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)) AS days_since_release,
       year(first_day) AS release_year, month(first_day) AS release_month,
       CAST(sum(total_comment_count) OVER a AS BIGINT) AS artist_comment_count,
       CAST(sum(total_reply_count) OVER a AS BIGINT) AS artist_reply_count,
       CAST(sum(total_like_total) OVER a AS BIGINT) AS artist_like_total, topic_count,
       round(total_like_total / total_comment_count, 6) AS like_per_comment, round(total_reply_count / total_comment_count, 6) AS reply_per_comment,
       like_trend_slope, comment_trend_slope, heat_trend_slope, heat_volatility
FROM item_totals t JOIN item_trends USING (song_id) WINDOW a AS (PARTITION BY artist_id)""",
)
add("bd_song_features", "song_features", "SELECT * FROM song_features")
cte(
    "hot_logs",
    "item_facts",
    """SELECT song_id, ln(1.0::DOUBLE + count(*)) AS a, ln(1.0::DOUBLE + sum(likes)) AS b,
       ln(1.0::DOUBLE + CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)) AS c FROM item_facts GROUP BY 1""",
)
_sum = " + ".join(min_max(x, f"(min({x}) OVER ())", f"(max({x}) OVER ())") for x in "abc")
cte("hot_composite", "hot_logs", f"SELECT song_id, round(({_sum}) / 3.0::DOUBLE, 6) AS composite FROM hot_logs")
cte(
    "hot_label",
    "hot_composite",
    """SELECT song_id, composite, round(p, 6) AS hot_prob, CAST(CASE WHEN p >= 0.9 THEN 1 ELSE 0 END AS BIGINT) AS is_hot
FROM (SELECT *, percent_rank() OVER (ORDER BY composite) AS p FROM hot_composite)""",
)
add("bd_hot_label", "hot_label", "SELECT * FROM hot_label")
add(
    "ml_threshold_flag",
    "hot_label",
    "SELECT song_id, hot_prob, CAST(hot_prob >= 0.5 AS BIGINT) AS is_hot_predicted FROM hot_label",
)
add(
    "js_prob_scaled",
    "hot_label",
    f""", top AS (SELECT song_id, hot_prob, CAST(round(hot_prob * 1000000) AS BIGINT) AS u FROM hot_label ORDER BY hot_prob DESC, song_id LIMIT 10)
SELECT song_id, hot_prob, {rounded('u', 'greatest((SELECT max(u) FROM top), 10000)', 1, 100)} AS width_pct FROM top""",
)
# four features have no display name of their own
FEATURES = {**FEATURE_NAMES, **{c: c for c in ("like_trend_slope", "comment_trend_slope", "heat_trend_slope", "heat_volatility")}}
add(
    "js_label_map",
    "song_features",
    " UNION ALL ".join(
        f"SELECT '{code}' AS feature, '{label}' AS label, round(avg(CAST({code} AS DOUBLE)), 4) AS mean_value FROM song_features"
        for code, label in FEATURES.items()
    ),
)

# Evaluation
cte("scored", "churn_risk", "SELECT user_id AS row_id, churned AS label, churn_prob AS score FROM churn_risk")
add(
    "ml_auc",
    "scored",
    """, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM scored),
s AS (SELECT CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n,
             sum(rk) FILTER (WHERE label = 1) AS rp FROM r)
SELECT round((rp - p * (p + 1) / 2) / (p * n), 6) AS auc, CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives FROM s""",
)
add(
    "ml_pr_auc",
    "scored",
    """, c AS (SELECT score, sum(label) AS pos, count(*) AS n FROM scored GROUP BY score),
r AS (SELECT pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen, sum(pos) OVER () AS total FROM c WINDOW w AS (ORDER BY score DESC))
SELECT round(sum(CAST(pos AS DOUBLE) / total * (CAST(tp AS DOUBLE) / seen)), 6) AS pr_auc FROM r""",
)
add(
    "ml_f1_accuracy",
    "scored",
    """, k AS (SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
             count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE score < 0.5 AND label = 0) AS tn FROM scored)
SELECT round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
       tp + fn AS support_pos, fp + tn AS support_neg FROM k""",
)
_cdf, _term, _steps = 0.0, math.exp(-1), []
for _k in range(1, 13):
    _cdf += _term
    _steps.append(math.floor(_cdf * 2**32))
    _term /= _k
_weight = " + ".join(f"CAST(u >= {s} AS BIGINT)" for s in _steps)
add(
    "ml_bootstrap_ci",
    "scored",
    f""", d AS (SELECT b.i AS b, label, score, CAST(concat('0x', substr(md5(row_id || ':' || b.i), 1, 8)) AS BIGINT) AS u
        FROM scored, range(1, 101) b(i)),
w AS (SELECT b, score, CAST(sum(({_weight}) * label) AS DOUBLE) AS pos, CAST(sum(({_weight}) * (1 - label)) AS DOUBLE) AS neg FROM d GROUP BY 1, 2),
c AS (SELECT *, sum(neg) OVER (PARTITION BY b ORDER BY score) - neg / 2 AS below FROM w),
a AS (SELECT b, sum(pos * below) / (sum(pos) * sum(neg)) AS auc FROM c GROUP BY b)
SELECT count(auc) AS replicates, round(avg(auc), 6) AS auc_mean, round(quantile_cont(auc, 0.025), 6) AS auc_ci_lower,
       round(quantile_cont(auc, 0.975), 6) AS auc_ci_upper FROM a""",
)

# Forecast
cte(
    "series",
    "song_daily",
    """SELECT song_id, dt, heat_score, isodow(dt) AS wd, CAST(date_diff('day', min(dt) OVER s, dt) AS DOUBLE) AS x
FROM song_daily WINDOW s AS (PARTITION BY song_id) QUALIFY count(*) OVER s >= 14""",
)
cte(
    "trend",
    "series",
    """SELECT song_id, regr_slope(heat_score, x) AS slope, regr_intercept(heat_score, x) AS base, max(dt) AS last, max(x) AS last_x
FROM series GROUP BY 1""",
)
cte("gaps", "series trend", "SELECT s.song_id, wd, heat_score - (base + slope * x) AS gap FROM series s JOIN trend USING (song_id)")
cte("seasons", "gaps", "SELECT song_id, wd, avg(gap) AS season FROM gaps GROUP BY 1, 2")
cte(
    "spread",
    "gaps seasons",
    "SELECT song_id, stddev_samp(gap - season) AS sd FROM gaps JOIN seasons USING (song_id, wd) GROUP BY 1",
)
cte(
    "forecast",
    "trend seasons spread",
    """SELECT song_id, forecast_date, round(greatest(y, 0), 6) AS heat_score, round(greatest(y - 1.96::DOUBLE * sd, 0), 6) AS heat_score_lower,
       round(greatest(y + 1.96::DOUBLE * sd, 0), 6) AS heat_score_upper
FROM (SELECT t.song_id, t.last + CAST(h.i AS INTEGER) AS forecast_date, sd,
             base + slope * (last_x + h.i) + coalesce(e.season, 0) AS y
      FROM trend t CROSS JOIN range(1, 31) h(i) JOIN spread USING (song_id)
      LEFT JOIN seasons e ON e.song_id = t.song_id AND e.wd = isodow(t.last + CAST(h.i AS INTEGER)))""",
)
_TERMS = ["1.0::DOUBLE", "u", *[f"greatest(u - {0.8 * k / 5!r}::DOUBLE, 0.0::DOUBLE)" for k in range(1, 6)]]
for _k in (1, 2):
    _TERMS += [f"{f}({2 * math.pi * _k!r}::DOUBLE * (d / 7.0::DOUBLE - floor(d / 7.0::DOUBLE)))" for f in ("sin", "cos")]
_LIST = "[" + ", ".join(_TERMS) + ", heat_score]"
add(
    "ml_forecast_gram",
    "song_daily",
    f""", s AS (SELECT song_id, heat_score, CAST(date_diff('day', DATE '1970-01-01', dt) AS DOUBLE) AS d FROM song_daily),
b AS (SELECT *, min(d) OVER w AS first, max(d) OVER w AS last, count(*) OVER w AS days FROM s WINDOW w AS (PARTITION BY song_id)),
t AS (SELECT song_id, days, {_LIST} AS v FROM (SELECT *, (d - first) / (last - first) AS u FROM b WHERE days >= 14 AND last > first))
SELECT song_id, days, i, j, round(sum(v[i + 1] * v[j + 1]), 6) AS product
FROM t, range(0, 12) a(i), range(0, 12) b(j) WHERE i <= j GROUP BY 1, 2, 3, 4""",
)
add("ml_forecast", "forecast", "SELECT * FROM forecast")
add(
    "gd_forecast_songs",
    "forecast song",
    "SELECT DISTINCT song_id, song_name FROM forecast JOIN song USING (song_id)",
)
add(
    "gd_forecast_series",
    "forecast song",
    """SELECT song_id, song_name, count(*) OVER s AS days, min(forecast_date) OVER s AS first_date, max(forecast_date) OVER s AS last_date,
       forecast_date, heat_score, heat_score_lower, heat_score_upper
FROM forecast JOIN song USING (song_id) WINDOW s AS (PARTITION BY song_id)""",
)


def _fold(column: str) -> str:
    part = "CAST(concat('0x', substr(md5(CAST({} AS VARCHAR)), {}, 8)) AS BIGINT) % 5".format
    return f"CASE WHEN {part(column, 9)} = 0 THEN -1 ELSE {part(column, 1)} END"


add(
    "ml_churn_frame",
    "",
    f"""WITH a AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS d, o_totalprice AS amount,
             (SELECT CAST(max(o_orderdate) AS DATE) - 90 FROM orders) AS cut FROM orders),
g AS (SELECT user_id, count(*) FILTER (WHERE d <= cut) AS frequency, CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (WHERE d <= cut) AS DOUBLE) AS m,
       date_diff('day', max(d) FILTER (WHERE d <= cut), any_value(cut)) AS recency_days, date_diff('day', min(d) FILTER (WHERE d <= cut), any_value(cut)) AS tenure_days,
       count(*) FILTER (WHERE d <= cut AND d > cut - 90) AS recent_90, count(*) FILTER (WHERE d <= cut AND d > cut - 180) AS recent_180,
       count(*) FILTER (WHERE d <= cut AND d > cut - 365) AS recent_365, count(DISTINCT date_trunc('month', d)) FILTER (WHERE d <= cut) AS active_months,
       CAST(CASE WHEN count(*) FILTER (WHERE d > cut) = 0 THEN 1 ELSE 0 END AS BIGINT) AS label FROM a GROUP BY user_id)
SELECT user_id, label, {_fold('user_id')} AS fold, frequency, recency_days, tenure_days, recent_90, recent_180, recent_365, active_months,
       round(m, 2) AS monetary, round(m / frequency, 6) AS mean_amount FROM g WHERE frequency > 0""",
)
_AFTER = {
    "item_facts_all": ("", CTES["item_facts"][1]),
    "item_facts": ("item_facts_all", "SELECT * FROM item_facts_all WHERE dt > (SELECT max(dt) FROM item_facts_all) - 180"),
}
ORACLES["ml_hot_frame"] = statement(
    "item_facts_all song hot_label",
    f"""SELECT b.song_id, coalesce(is_hot, 0) AS label, {_fold('b.song_id')} AS fold
FROM (SELECT DISTINCT song_id FROM item_facts_all JOIN song USING (song_id) WHERE dt <= (SELECT max(dt) FROM item_facts_all) - 180) b
LEFT JOIN hot_label USING (song_id)""",
    _AFTER,
)
