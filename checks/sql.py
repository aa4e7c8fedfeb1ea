"""Building blocks of the comparison SQL: named CTEs with their dependencies, and exact rounding."""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: str, body: str) -> None:
    CTES[name] = (tuple(deps.split()), body)


def statement(deps: str, body: str, replaced: dict[str, tuple[str, str]] | None = None) -> str:
    """The body behind a WITH clause that holds its CTEs and everything they need, in order.

    ``replaced`` gives other definitions, as (dependencies, SQL), to some of the names.
    """
    known = {**CTES, **{n: (tuple(d.split()), sql) for n, (d, sql) in (replaced or {}).items()}}
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for parent in known[name][0]:
            visit(parent)
        ordered.append(name)

    for name in deps.split():
        visit(name)
    if not ordered:
        return body
    recursive = "RECURSIVE " if any("/*recursive*/" in known[n][1] for n in ordered) else ""
    heads = []
    for name in ordered:
        heads.append(f"{name} AS (\n{known[name][1]}\n)")
    return f"WITH {recursive}" + ",\n".join(heads) + "\n" + body


def rounded(num: str, den: str, places: int, factor: int = 1) -> str:
    """round(factor * num / den, places), half away from zero, on whole numbers."""
    scale = factor * 10**places
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    digits = f"((2 * abs({n}) * {scale} + {d}) // (2 * {d}))"
    return (
        f"CASE WHEN {d} = 0 THEN NULL ELSE "
        f"CAST(sign({n}) * {digits} AS DOUBLE) / CAST({10**places} AS DOUBLE) END"
    )


def percent(num: str, den: str, places: int) -> str:
    return rounded(num, den, places, 100)


def mean_score(column: str, window: str = "") -> str:
    over = f" OVER ({window})" if window else ""
    total = f"CAST(sum(CAST(round({column} * 1000000) AS BIGINT)){over} AS DOUBLE)"
    return f"{total} / (CAST(count({column}){over} AS DOUBLE) * 1000000)"


def exact_mean(column: str) -> str:
    """Mean of six-decimal scores, rounded exactly to six decimals."""
    return rounded(f"sum(CAST(round({column} * 1000000) AS BIGINT))", f"count({column}) * 1000000", 6)


def min_max(value: str, low: str, high: str) -> str:
    return f"(CASE WHEN {high} > {low} THEN ({value} - {low}) / ({high} - {low}) ELSE 0.0 END)"


def strings(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# Logical model -----------------------------------------------------------------------------

cte(
    "comment_raw",
    "",
    """SELECT event_id AS comment_id, user_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS song_id,
       CAST(floor(value) AS BIGINT) AS like_count,
       CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT) AS reply_count,
       ts AS comment_time, event_type,
       event_id % (SELECT count(*) FROM documents) AS doc_id
FROM events""",
)
cte(
    "comment_lengths",
    "comment_raw",
    """SELECT c.*, CAST(length(d.text) AS BIGINT) AS content_length, d.text AS content
FROM comment_raw c JOIN documents d ON d.doc_id = c.doc_id""",
)
cte(
    "song",
    "",
    "SELECT p_partkey AS song_id, p_name AS song_name, p_brand AS artist_id, p_brand AS artist_name FROM part",
)
cte("artist", "", "SELECT DISTINCT p_brand AS artist_id, p_brand AS artist_name FROM part")
cte("user_info", "", "SELECT c_custkey AS user_id, c_name AS nickname FROM customer")
cte(
    "doc_sentiment",
    "",
    """SELECT doc_id,
       CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
       CASE WHEN toxic = 1 THEN 0.0 WHEN quality = 1 THEN 1.0 ELSE 0.5 END::DOUBLE AS positive_prob
FROM labels""",
)
cte(
    "comment_sentiment",
    "comment_raw doc_sentiment",
    """SELECT c.comment_id, c.song_id, s.positive_prob, s.sentiment
FROM comment_raw c JOIN doc_sentiment s ON s.doc_id = c.doc_id""",
)
cte(
    "purchases",
    "",
    "SELECT o_custkey AS user_id, o_orderkey AS action_id, o_orderdate AS moment, o_totalprice AS amount FROM orders",
)

# Daily metrics -----------------------------------------------------------------------------


def daily_ctes(prefix: str, source: str) -> None:
    cte(
        f"{prefix}_counts",
        source,
        f"""SELECT CAST(comment_time AS DATE) AS dt, song_id, count(*) AS comment_count,
       CAST(sum(like_count) AS BIGINT) AS like_total, CAST(sum(reply_count) AS BIGINT) AS reply_count
FROM {source} WHERE comment_time IS NOT NULL GROUP BY 1, 2""",
    )
    terms = " + ".join(
        f"{w}::DOUBLE * "
        + min_max(
            f"ln(1.0 + {c})", f"(min(ln(1.0 + {c})) OVER (PARTITION BY dt))", f"(max(ln(1.0 + {c})) OVER (PARTITION BY dt))"
        )
        for c, w in (("comment_count", 0.5), ("like_total", 0.3), ("reply_count", 0.2))
    )
    cte(prefix, f"{prefix}_counts", f"SELECT *, round({terms}, 6) AS heat_score FROM {prefix}_counts")


daily_ctes("song_daily", "comment_raw")
cte(
    "recent_comment",
    "comment_raw song",
    """SELECT * FROM comment_raw
WHERE comment_time >= (SELECT CAST(max(ts) AS DATE) - 7 FROM events)""",
)
daily_ctes("recent_all", "recent_comment")
cte("recent_daily", "recent_all song", "SELECT * FROM recent_all WHERE song_id IN (SELECT song_id FROM song)")
cte(
    "daily_rank",
    "song_daily",
    "SELECT *, row_number() OVER (PARTITION BY dt ORDER BY heat_score DESC, song_id) AS heat_rank FROM song_daily",
)
_recent = "PARTITION BY song_id ORDER BY dt RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW"
_earlier = "PARTITION BY song_id ORDER BY dt RANGE BETWEEN INTERVAL 13 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING"
cte(
    "lifecycle_change",
    "daily_rank",
    f"""SELECT *, {mean_score('heat_score', _recent)} AS recent_mean,
       CASE WHEN count(heat_score) OVER ({_earlier}) > 0 THEN {mean_score('heat_score', _earlier)} END AS earlier_mean
FROM daily_rank""",
)
cte(
    "lifecycle_ratio",
    "lifecycle_change",
    """SELECT *, CASE WHEN earlier_mean <> 0 THEN round(recent_mean / earlier_mean, 6) END AS heat_change
FROM lifecycle_change""",
)
cte(
    "song_rank",
    "lifecycle_ratio",
    """SELECT dt, song_id, heat_rank, heat_score, comment_count, like_total, heat_change,
       CASE WHEN heat_score >= 0.7 THEN '爆发期' WHEN heat_change > 1.1 THEN '增长期'
            WHEN heat_change < 0.9 THEN '衰退期' ELSE '稳定期' END AS lifecycle_stage
FROM lifecycle_ratio""",
)
cte(
    "hourly_counts",
    "comment_raw",
    """SELECT hour(comment_time) AS hour, count(*) AS comment_count,
       CAST(sum(reply_count) AS BIGINT) AS reply_count, CAST(sum(like_count) AS BIGINT) AS like_total,
       count(DISTINCT user_id) AS user_count
FROM comment_raw WHERE comment_time IS NOT NULL GROUP BY 1""",
)
cte(
    "hourly",
    "hourly_counts",
    f"""SELECT hour, comment_count, reply_count, like_total, user_count,
       {rounded('comment_count', 'sum(comment_count) OVER ()', 4)} AS pct,
       CASE WHEN row_number() OVER (ORDER BY comment_count DESC, hour) <= 3 THEN '高峰'
            WHEN row_number() OVER (ORDER BY comment_count, hour) <= 3 THEN '低谷' ELSE '平峰' END AS peak_label
FROM hourly_counts""",
)
cte(
    "weekday_counts",
    "comment_raw",
    """SELECT isodow(comment_time) - 1 AS weekday, count(*) AS comment_count, count(DISTINCT user_id) AS user_count
FROM comment_raw WHERE comment_time IS NOT NULL GROUP BY 1""",
)
cte(
    "weekday_pattern",
    "weekday_counts",
    f"""SELECT weekday, ['周一', '周二', '周三', '周四', '周五', '周六', '周日'][weekday + 1] AS weekday_name,
       comment_count, user_count, {rounded('comment_count', 'sum(comment_count) OVER ()', 4)} AS pct,
       CAST(CASE WHEN weekday >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend
FROM weekday_counts""",
)
cte(
    "monthly",
    "",
    """SELECT month(o_orderdate) AS month, count(*) AS comment_count,
       CASE WHEN month(o_orderdate) BETWEEN 3 AND 5 THEN '春' WHEN month(o_orderdate) BETWEEN 6 AND 8 THEN '夏'
            WHEN month(o_orderdate) BETWEEN 9 AND 11 THEN '秋' ELSE '冬' END AS season
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 3""",
)

# Segments ----------------------------------------------------------------------------------

cte(
    "rfm_base",
    "purchases",
    """SELECT user_id,
       date_diff('day', CAST(max(moment) AS DATE), (SELECT CAST(max(moment) AS DATE) FROM purchases)) AS recency,
       count(DISTINCT action_id) AS frequency, sum(CAST(amount AS DECIMAL(18,2))) AS monetary
FROM purchases GROUP BY user_id""",
)
cte(
    "rfm_tiles",
    "rfm_base",
    """SELECT *, ntile(4) OVER (ORDER BY recency, user_id) AS r_quartile,
       ntile(4) OVER (ORDER BY frequency, user_id) AS f_score,
       ntile(4) OVER (ORDER BY monetary, user_id) AS m_score
FROM rfm_base""",
)
cte("rfm_scores", "rfm_tiles", "SELECT *, 5 - r_quartile AS r_score FROM rfm_tiles")
cte(
    "rfm_scores_literal",
    "rfm_tiles",
    """SELECT *, CASE WHEN recency <= r_quartile THEN 4 WHEN recency <= 2 * r_quartile THEN 3
       WHEN recency <= 3 * r_quartile THEN 2 ELSE 1 END AS r_score FROM rfm_tiles""",
)
# The rules of the segments and their labels; the first that holds wins.
_segment = """CASE WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN '高价值用户'
       WHEN r_score >= 3 AND f_score <= 2 THEN '新用户'
       WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN '老客流失风险'
       WHEN r_score <= 2 AND f_score <= 2 THEN '沉默用户'
       ELSE '成长用户' END"""
cte("user_rfm", "rfm_scores", f"SELECT *, {_segment} AS rfm_label FROM rfm_scores")
cte("user_rfm_literal", "rfm_scores_literal", f"SELECT *, {_segment} AS rfm_label FROM rfm_scores_literal")


def segment_report(source: str) -> str:
    cents = "CAST(sum(monetary) * 100 AS HUGEINT)"
    money = f"CAST((2 * {cents} + count(*)) // (2 * count(*)) AS DOUBLE) / 100"
    return statement(
        source,
        f"""SELECT rfm_label AS user_segment, count(*) AS user_count,
       {percent('count(*)', 'sum(count(*)) OVER ()', 2)} AS pct,
       {rounded('sum(frequency)', 'count(*)', 2)} AS avg_frequency,
       {money} AS avg_monetary,
       {rounded('sum(recency)', 'count(*)', 1)} AS avg_recency
FROM {source} GROUP BY rfm_label""",
    )


_period = """CASE WHEN hour(comment_time) < 6 THEN '凌晨' WHEN hour(comment_time) < 12 THEN '上午'
       WHEN hour(comment_time) < 18 THEN '下午' ELSE '晚上' END"""
cte("comment_period", "comment_raw", f"SELECT *, {_period} AS time_period FROM comment_raw")
cte(
    "portrait_totals",
    "comment_raw doc_sentiment",
    """SELECT user_id, count(*) AS comment_count_total, CAST(sum(reply_count) AS BIGINT) AS reply_count_total,
       CAST(sum(like_count) AS BIGINT) AS like_received_total, round(avg(positive_prob), 6) AS avg_sentiment
FROM comment_raw c LEFT JOIN doc_sentiment s ON s.doc_id = c.doc_id GROUP BY user_id""",
)
cte(
    "portrait_period",
    "comment_period",
    """SELECT user_id, time_period AS active_period FROM (
    SELECT user_id, time_period, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC,
           list_position(['凌晨', '上午', '下午', '晚上'], time_period)) AS rn
    FROM comment_period GROUP BY user_id, time_period) WHERE rn = 1""",
)
_value = " + ".join(
    min_max(f"CAST({c} AS DOUBLE)", f"(min({c}) OVER ())", f"(max({c}) OVER ())")
    for c in ("comment_count_total", "reply_count_total", "like_received_total")
)
cte(
    "portrait_value",
    "portrait_totals portrait_period",
    f"SELECT t.*, p.active_period, round(({_value}) / 3.0::DOUBLE, 6) AS user_value FROM portrait_totals t JOIN portrait_period p USING (user_id)",
)
cte(
    "portrait",
    "portrait_value",
    """SELECT *, CASE WHEN avg_sentiment >= 0.6 THEN '积极型' WHEN avg_sentiment <= 0.4 THEN '消极型' ELSE '中性型' END AS sentiment_type,
       CASE WHEN user_value >= 0.6 THEN '核心粉丝' WHEN user_value >= 0.3 THEN '内容消费者' ELSE '轻度用户' END AS user_type
FROM portrait_value""",
)
cte(
    "cohort_weeks",
    "purchases",
    """SELECT DISTINCT user_id, CAST(date_trunc('week', moment) AS DATE) AS week FROM purchases WHERE moment IS NOT NULL""",
)
cte(
    "cohort_first",
    "cohort_weeks",
    "SELECT user_id, week, min(week) OVER (PARTITION BY user_id) AS cohort_week FROM cohort_weeks",
)
cte(
    "cohort",
    "cohort_first",
    """SELECT g.cohort_week, s.cohort_size, g.week_offset, g.active_users,
       round(g.active_users / s.cohort_size, 6) AS retention
FROM (SELECT cohort_week, date_diff('day', cohort_week, week) // 7 AS week_offset, count(DISTINCT user_id) AS active_users
      FROM cohort_first GROUP BY 1, 2) g
JOIN (SELECT cohort_week, count(DISTINCT user_id) AS cohort_size FROM cohort_first GROUP BY 1) s USING (cohort_week)""",
)
cte(
    "churn_label",
    "purchases",
    """SELECT user_id, date_diff('day', last_before, cutoff) AS recency_days,
       CAST(CASE WHEN actions_after = 0 THEN 1 ELSE 0 END AS BIGINT) AS churned
FROM (SELECT user_id, any_value(cutoff) AS cutoff,
             max(CASE WHEN CAST(moment AS DATE) <= cutoff THEN CAST(moment AS DATE) END) AS last_before,
             count(*) FILTER (WHERE CAST(moment AS DATE) > cutoff) AS actions_after
      FROM purchases, (SELECT CAST(max(moment) AS DATE) - 90 AS cutoff FROM purchases) GROUP BY user_id)
WHERE last_before IS NOT NULL""",
)
cte(
    "churn_risk",
    "churn_label",
    """SELECT *, CASE WHEN churn_prob < 0.3 THEN '低' WHEN churn_prob > 0.7 THEN '高' ELSE '中' END AS risk_level
FROM (SELECT *, round(CAST(recency_days AS DOUBLE) / (recency_days + 90), 6) AS churn_prob FROM churn_label)""",
)
