"""Comparison SQL of the report pages and metric tables."""

from checks.sql import cte, exact_mean, percent, rounded, statement

ORACLES: dict[str, str] = {}


def add(name: str, deps: str, body: str) -> None:
    ORACLES[name] = statement(deps, body)


# Counts and rates
add(
    "fd_core_counts",
    "",
    """SELECT (SELECT count(*) FROM part) AS song_count, (SELECT count(*) FROM customer) AS user_count,
       (SELECT count(*) FROM events) AS comment_count, (SELECT count(DISTINCT p_brand) FROM part) AS artist_count""",
)
add(
    "gd_counts",
    "",
    """SELECT (SELECT count(*) FROM customer) AS count_users, (SELECT count(*) FROM part) AS count_songs,
       (SELECT count(*) FROM events) AS count_comments, (SELECT count(DISTINCT p_brand) FROM part) AS count_artists,
       (SELECT count(*) FROM events) AS total_comments""",
)
add(
    "fd_interaction_rate",
    "comment_raw",
    f"""SELECT CAST(coalesce(sum(like_count), 0) AS BIGINT) AS total_likes,
       CAST(coalesce(sum(reply_count), 0) AS BIGINT) AS total_replies,
       {percent('coalesce(sum(like_count), 0) + coalesce(sum(reply_count), 0)', 'greatest(count(*), 1)', 2)} AS interaction_rate
FROM comment_raw""",
)
add(
    "gd_like_rate",
    "comment_raw",
    """SELECT CAST(coalesce(sum(like_count), 0) AS BIGINT) AS total_likes,
       coalesce(round(CAST(sum(like_count) AS DOUBLE) / nullif(count(*), 0), 6), 0.0) AS interaction_rate FROM comment_raw""",
)

# Trends
add(
    "fd_trend_30d",
    "comment_raw",
    """SELECT CAST(comment_time AS DATE) AS d, count(*) AS c FROM comment_raw
WHERE comment_time >= (SELECT max(ts) FROM events) - INTERVAL 30 DAY GROUP BY 1""",
)
add(
    "gd_trend_30d_heat",
    "song_daily",
    """SELECT dt, CAST(sum(CAST(round(heat_score * 1000000) AS BIGINT)) AS DOUBLE) / 1000000 AS total_heat,
       CAST(sum(comment_count) AS BIGINT) AS total_comment, CAST(sum(reply_count) AS BIGINT) AS total_reply
FROM song_daily WHERE dt >= (SELECT CAST(max(ts) AS DATE) - 30 FROM events) GROUP BY dt""",
)
add(
    "gd_heatmap",
    "comment_raw",
    """, n AS (SELECT isodow(comment_time) - 1 AS weekday, hour(comment_time) AS hour, count(*) AS c FROM comment_raw
      WHERE comment_time >= (SELECT CAST(max(ts) AS DATE) - 30 FROM events) GROUP BY 1, 2),
cells AS (SELECT i // 24 AS weekday, i % 24 AS hour FROM range(168) r(i))
SELECT cells.weekday, ['周一', '周二', '周三', '周四', '周五', '周六', '周日'][cells.weekday + 1] AS weekday_name, cells.hour,
       coalesce(c, 0) AS comment_count, greatest(1, max(coalesce(c, 0)) OVER ()) AS max_count
FROM cells LEFT JOIN n ON n.weekday = cells.weekday AND n.hour = cells.hour""",
)
add("gd_day_period", "comment_period", "SELECT time_period, count(*) AS cnt FROM comment_period GROUP BY 1")
add(
    "js_period_dense",
    "comment_period",
    """SELECT p.i AS position, ['凌晨', '上午', '下午', '晚上'][p.i + 1] AS time_period,
       (SELECT count(*) FROM comment_period c WHERE c.time_period = ['凌晨', '上午', '下午', '晚上'][p.i + 1]) AS cnt
FROM range(4) p(i)""",
)
add("fd_hourly", "hourly", "SELECT hour, comment_count, user_count, pct FROM hourly")
add("gd_hourly", "hourly", "SELECT hour, comment_count, reply_count, like_total, peak_label FROM hourly")
add("fd_weekday", "weekday_pattern", "SELECT weekday, weekday_name, comment_count, user_count, pct FROM weekday_pattern")
add("gd_weekday", "weekday_pattern", "SELECT weekday, weekday_name, comment_count, is_weekend FROM weekday_pattern")
add("gd_monthly", "monthly", "SELECT * FROM monthly")
add(
    "gd_peak_hour",
    "hourly",
    """SELECT coalesce((SELECT lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' FROM hourly
       ORDER BY comment_count DESC, hour LIMIT 1), '-') AS peak_hour""",
)

# Songs
add(
    "fd_hot_songs",
    "song_rank song",
    """SELECT dt, song_id, heat_rank, heat_score, comment_count, like_total, lifecycle_stage, song_name, artist_name
FROM song_rank JOIN song USING (song_id) ORDER BY heat_score DESC, dt, song_id LIMIT 10""",
)
add(
    "gd_song_top5",
    "song_daily song",
    f"""SELECT song_id, any_value(song_name) AS name, {exact_mean('heat_score')} AS heat
FROM song_daily JOIN song USING (song_id) GROUP BY song_id ORDER BY heat DESC, song_id LIMIT 5""",
)
add("fd_lifecycle_dist", "song_rank", "SELECT lifecycle_stage, count(*) AS cnt FROM song_rank GROUP BY 1")
add(
    "gd_song_list",
    "song artist comment_raw",
    """SELECT s.song_id, s.song_name, a.artist_name, count(c.comment_id) AS comment_count
FROM song s LEFT JOIN artist a ON a.artist_id = s.artist_id LEFT JOIN comment_raw c ON c.song_id = s.song_id GROUP BY 1, 2, 3""",
)
add(
    "gd_lifecycle_series",
    "song_daily",
    """SELECT song_id, row_number() OVER (PARTITION BY song_id ORDER BY dt) - 1 AS day_index, dt, heat_score, comment_count, reply_count
FROM song_daily""",
)
add(
    "gd_top_comments10",
    "comment_lengths",
    """SELECT song_id, position, comment_id, content, like_count, comment_time FROM (
    SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY like_count DESC, comment_time DESC, comment_id) AS position
    FROM comment_lengths) WHERE position <= 10""",
)
add(
    "fd_top_artists",
    "comment_raw song",
    """SELECT artist_name, count(DISTINCT comment_id) AS comments, CAST(sum(like_count) AS BIGINT) AS likes, count(DISTINCT user_id) AS users
FROM comment_raw JOIN song USING (song_id) GROUP BY artist_name ORDER BY likes DESC, artist_name LIMIT 5""",
)
add(
    "js_text_search",
    "song",
    "SELECT song_id, song_name, artist_name FROM song WHERE contains(lower(song_name || ' ' || coalesce(artist_name, '')), 'brand#1')",
)

# Users
add(
    "fd_user_type_pct",
    "portrait",
    f"""SELECT user_type, count(*) AS user_count, {percent('count(*)', '(SELECT count(*) FROM portrait WHERE user_type IS NOT NULL)', 1)} AS pct
FROM portrait WHERE user_type IS NOT NULL GROUP BY user_type""",
)
add("gd_user_type_dist", "portrait", "SELECT user_type, count(*) AS cnt FROM portrait GROUP BY 1")
add(
    "fd_user_value_levels",
    "portrait",
    """SELECT CASE WHEN user_value >= 0.7 THEN 'high' WHEN user_value >= 0.4 THEN 'medium' ELSE 'low' END AS value_level, count(*) AS cnt
FROM portrait GROUP BY 1""",
)
add("fd_rfm_dist", "user_rfm", "SELECT rfm_label, count(*) AS user_count FROM user_rfm GROUP BY 1")
add(
    "gd_rfm_dist",
    "user_rfm",
    "SELECT rfm_label, count(*) AS cnt, CAST(sum(count(*)) OVER () AS BIGINT) AS rfm_total FROM user_rfm GROUP BY 1",
)
add(
    "gd_top_users",
    "portrait user_info",
    """SELECT user_id, nickname, user_value, comment_count_total AS total_comment, reply_count_total AS total_reply,
       like_received_total AS total_like, avg_sentiment, active_period, sentiment_type, user_type
FROM portrait JOIN user_info USING (user_id) ORDER BY user_value DESC, user_id LIMIT 15""",
)
_HIST = """, edge AS (SELECT min(user_value) AS lo, CASE WHEN max(user_value) - min(user_value) < 1e-9 THEN min(user_value) + 1 ELSE max(user_value) END AS hi
         FROM portrait WHERE user_value IS NOT NULL),
width AS (SELECT lo, (hi - lo) / 20 AS step FROM edge),
filled AS (SELECT least(CAST(floor((user_value - lo) / step) AS BIGINT), 19) AS bin, count(*) AS n FROM portrait, width
           WHERE user_value IS NOT NULL GROUP BY 1),
hist AS (SELECT b.i AS bin, printf('%.3f - %.3f', lo + b.i * step, lo + (b.i + 1) * step) AS value_range,
       round(lo + (b.i + 0.5::DOUBLE) * step, 6) AS mid, coalesce(n, 0) AS user_count
FROM range(20) b(i) CROSS JOIN width LEFT JOIN filled ON filled.bin = b.i WHERE lo IS NOT NULL)
SELECT * FROM hist"""
add("gd_value_hist", "portrait", _HIST)
add("js_nonzero_bins", "portrait", _HIST + " WHERE user_count > 0")
add(
    "fd_cohort_avg",
    "cohort",
    f"""SELECT week_offset, {rounded('sum(CAST(round(retention * 1000000) AS BIGINT))', 'count(*) * 10000', 2)} AS avg_retention,
       count(*) AS cohort_count FROM cohort GROUP BY week_offset ORDER BY week_offset LIMIT 9""",
)
add("gd_cohort_matrix", "cohort", "SELECT * FROM cohort WHERE week_offset <= 8")
add(
    "js_cohort_dense",
    "cohort",
    f""", last AS (SELECT DISTINCT cohort_week FROM cohort WHERE week_offset <= 8 ORDER BY cohort_week DESC LIMIT 20)
SELECT last.cohort_week, o.i AS week_offset,
       coalesce({percent('c.active_users', 'c.cohort_size', 1)}, 0.0::DOUBLE) AS retention_pct
FROM last CROSS JOIN range(9) o(i) LEFT JOIN cohort c ON c.cohort_week = last.cohort_week AND c.week_offset = o.i""",
)
add("fd_churn_risk", "churn_risk", "SELECT risk_level, count(*) AS user_count FROM churn_risk GROUP BY 1")
add(
    "gd_churn_risk",
    "churn_risk",
    """SELECT risk_level, CAST(list_position(['低', '中', '高'], risk_level) AS BIGINT) AS risk_order, count(*) AS cnt,
       CAST(sum(count(*)) OVER () AS BIGINT) AS churn_total,
       (SELECT count(*) FROM churn_risk WHERE risk_level = '高') AS churn_high_count FROM churn_risk GROUP BY risk_level""",
)

# Metric tables
add("bd_song_daily", "song_daily", "SELECT * FROM song_daily")
add(
    "bd_song_rank",
    "song_rank",
    "SELECT dt, song_id, heat_rank, heat_score, comment_count, like_total, lifecycle_stage FROM song_rank",
)
add("bd_lifecycle_stage", "song_rank", "SELECT dt, song_id, heat_score, heat_change, lifecycle_stage FROM song_rank")
add("bd_hourly", "hourly", "SELECT * FROM hourly")
add("bd_weekday", "weekday_pattern", "SELECT * FROM weekday_pattern")
add("bd_monthly", "monthly", "SELECT * FROM monthly")
add("bd_cohort", "cohort", "SELECT * FROM cohort")
add("bd_user_portrait", "portrait", "SELECT * FROM portrait")
add("bd_churn_label", "churn_label", "SELECT * FROM churn_label")
add("bd_churn_risk", "churn_risk", "SELECT user_id, recency_days, churn_prob, risk_level FROM churn_risk")
add(
    "bd_user_rfm",
    "user_rfm",
    "SELECT user_id, recency, frequency, r_score, f_score, m_score, rfm_label, CAST(monetary AS DOUBLE) AS monetary FROM user_rfm",
)

# Sentiment
_SHARES = """round(count(*) FILTER (WHERE sentiment = 'positive') / count(*), 6) AS positive,
       round(count(*) FILTER (WHERE sentiment = 'neutral') / count(*), 6) AS neutral,
       round(count(*) FILTER (WHERE sentiment = 'negative') / count(*), 6) AS negative,
       round(count(*) FILTER (WHERE sentiment = 'positive') / count(*) - count(*) FILTER (WHERE sentiment = 'negative') / count(*), 6) AS satisfaction_score,
       count(*) AS total_comments"""
cte("song_sentiment", "comment_sentiment", f"SELECT song_id, {_SHARES} FROM comment_sentiment GROUP BY song_id")
cte(
    "sentiment_summary",
    "comment_sentiment",
    f"""SELECT positive AS positive_ratio, neutral AS neutral_ratio, negative AS negative_ratio, satisfaction_score, total_comments,
       (SELECT round(count(*) FILTER (WHERE sentiment = 'positive') / count(*), 6) FROM comment_sentiment
        WHERE sentiment IN ('positive', 'negative')) AS positive_among_decided,
       (SELECT CAST(max(ts) AS DATE) FROM events) AS update_time
FROM (SELECT {_SHARES} FROM comment_sentiment)""",
)
cte(
    "sentiment_facts",
    "comment_sentiment comment_raw song",
    """SELECT s.song_id, g.song_name, s.comment_id, s.positive_prob, s.sentiment, c.comment_time
FROM comment_sentiment s JOIN comment_raw c USING (comment_id) JOIN song g ON g.song_id = s.song_id""",
)
cte(
    "sentiment_weeks",
    "sentiment_facts",
    """SELECT CAST(date_trunc('week', comment_time) AS DATE) AS week,
       count(*) FILTER (WHERE sentiment = 'positive') / count(*) AS p,
       count(*) FILTER (WHERE sentiment = 'negative') / count(*) AS g,
       count(*) FILTER (WHERE sentiment IS NULL OR sentiment NOT IN ('positive', 'negative')) / count(*) AS u,
       sum(coalesce(positive_prob, 0)) / count(*) AS prob, count(*) AS comment_count
FROM sentiment_facts WHERE comment_time IS NOT NULL GROUP BY 1""",
)
cte(
    "sentiment_weekly",
    "sentiment_weeks",
    """SELECT week, round(p, 6) AS positive_ratio, round(g, 6) AS negative_ratio, round(u, 6) AS neutral_ratio,
       round(prob, 6) AS avg_positive_prob, comment_count,
       round(coalesce(v, 0), 6) AS velocity, round(coalesce(v - lag(v) OVER (ORDER BY week), 0), 6) AS acceleration
FROM (SELECT *, p - lag(p) OVER (ORDER BY week) AS v FROM sentiment_weeks) ORDER BY week DESC LIMIT 30""",
)
cte(
    "shift_edges",
    "sentiment_facts",
    """SELECT *, greatest(1, CAST(floor(n * 0.3::DOUBLE) AS BIGINT)) AS k FROM (
    SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY comment_time, comment_id) AS rn, count(*) OVER (PARTITION BY song_id) AS n
    FROM sentiment_facts WHERE comment_time IS NOT NULL) WHERE n >= 10""",
)
cte(
    "shift_ratios",
    "shift_edges",
    """SELECT song_id, min(song_name) AS song_name, any_value(n) AS comment_count,
       count(*) FILTER (WHERE rn <= k AND sentiment = 'positive') / any_value(k) AS e,
       count(*) FILTER (WHERE rn > n - k AND sentiment = 'positive') / any_value(k) AS r,
       sum(coalesce(positive_prob, 0)) FILTER (WHERE rn > n - k) / any_value(k) AS prob
FROM shift_edges GROUP BY song_id""",
)
cte(
    "shift",
    "shift_ratios",
    """SELECT song_id, song_name, round(e, 6) AS early_positive_ratio, round(r, 6) AS recent_positive_ratio,
       round(CASE WHEN e <= 1e-6 THEN (r - e) * 100 ELSE (r - e) / e * 100 END, 6) AS change_rate,
       round(prob, 6) AS recent_avg_prob, comment_count FROM shift_ratios""",
)
add("tx_song_sentiment", "song_sentiment", "SELECT * FROM song_sentiment")
add("tx_sentiment_summary", "sentiment_summary", "SELECT * FROM sentiment_summary")
add(
    "io_latest_row",
    "comment_sentiment comment_raw",
    """SELECT CAST(comment_time AS DATE) AS update_time, count(*) AS total_comments,
       count(*) FILTER (WHERE sentiment = 'positive') AS positive_comments
FROM comment_sentiment JOIN comment_raw USING (comment_id) GROUP BY 1 ORDER BY 1 DESC LIMIT 1""",
)
add("fd_sentiment_summary", "sentiment_summary", "SELECT * FROM sentiment_summary")
add(
    "gd_sentiment_summary",
    "sentiment_summary",
    "SELECT positive_ratio, neutral_ratio, negative_ratio, satisfaction_score FROM sentiment_summary",
)
add(
    "fd_song_sentiment_avg",
    "song_sentiment",
    """SELECT round(avg(positive) * 100, 1) AS pos_pct, round(avg(negative) * 100, 1) AS neg_pct,
       round(avg(neutral) * 100, 1) AS neu_pct, round(avg(satisfaction_score), 2) AS sat_score FROM song_sentiment""",
)
add(
    "gd_song_sentiment_map",
    "song song_sentiment",
    "SELECT song.song_id, positive, neutral, negative FROM song LEFT JOIN song_sentiment USING (song_id)",
)
add(
    "gd_song_sentiment15",
    "song song_sentiment",
    """SELECT song_id, song_name, positive, neutral, negative, satisfaction_score FROM song_sentiment JOIN song USING (song_id)
ORDER BY satisfaction_score DESC, song_id LIMIT 15""",
)
add("gd_sentiment_join", "sentiment_facts", "SELECT * FROM sentiment_facts")
add("gd_sentiment_weekly", "sentiment_weekly", "SELECT * FROM sentiment_weekly")
add(
    "js_sentiment_cards",
    "sentiment_weekly",
    """SELECT CAST(sum(comment_count) AS BIGINT) AS total_comments, round(avg(positive_ratio) * 100, 1) AS avg_positive_pct,
       round(avg(negative_ratio) * 100, 1) AS avg_negative_pct, round(avg(avg_positive_prob) * 100, 1) AS avg_prob_pct FROM sentiment_weekly""",
)
add("gd_sentiment_shift", "shift", "SELECT * FROM shift")
add("gd_rising10", "shift", "SELECT * FROM shift ORDER BY change_rate DESC, song_id LIMIT 10")
add("gd_falling10", "shift", "SELECT * FROM shift ORDER BY change_rate, song_id DESC LIMIT 10")
add("gd_shift_scatter", "shift", "SELECT song_id, song_name, early_positive_ratio, recent_positive_ratio, change_rate, comment_count FROM shift")
add(
    "js_shift_band",
    "shift",
    """SELECT song_id, change_rate, CASE WHEN change_rate >= 20 THEN 'strong_rise' WHEN change_rate >= 0 THEN 'rise'
       WHEN change_rate >= -20 THEN 'fall' ELSE 'strong_fall' END AS band,
       greatest(8, least(28, 8 + comment_count / 8))::DOUBLE AS marker_size FROM shift""",
)
