"""Comparison SQL of the five analyses."""

from checks.sql import percent, rounded, segment_report, statement

ORACLES: dict[str, str] = {}


def _ranking(function: str, order: str) -> str:
    return statement(
        "recent_daily song",
        f""", ranked AS (
SELECT *, {function} OVER (PARTITION BY dt ORDER BY {order}) AS heat_rank FROM recent_daily),
moved AS (SELECT *, lag(heat_rank) OVER (PARTITION BY song_id ORDER BY dt) AS prev_rank FROM ranked)
SELECT m.dt, m.song_id, s.song_name, m.comment_count, m.like_total, m.heat_score, m.heat_rank, m.prev_rank,
       m.heat_rank - m.prev_rank AS rank_change,
       CASE WHEN m.heat_rank < m.prev_rank THEN '↑上升' WHEN m.heat_rank > m.prev_rank THEN '↓下降' ELSE '→持平' END AS rank_trend
FROM moved m JOIN song s USING (song_id) WHERE m.heat_rank <= 10""",
    )


ORACLES["sq1_daily_heat_rank"] = _ranking("row_number()", "heat_score DESC, song_id")
ORACLES["sq1_daily_heat_rank_ties"] = _ranking("rank()", "heat_score DESC")
ORACLES["sq2_rfm_segments"] = segment_report("user_rfm")
ORACLES["rfm_r_literal"] = segment_report("user_rfm_literal")
ORACLES["sq3_weekly_growth"] = statement(
    "comment_raw song",
    f""", days AS (
SELECT CAST(comment_time AS DATE) AS dt, song_id, count(*) AS n FROM comment_raw
WHERE comment_time >= (SELECT CAST(max(ts) AS DATE) - 30 FROM events) GROUP BY 1, 2),
sundays AS (SELECT dt - CAST(dayofweek(dt) AS INTEGER) AS s, song_id, n FROM days),
weeks AS (SELECT CAST(year(s) * 100 + ceil(dayofyear(s) / 7.0) AS BIGINT) AS year_week, song_id,
                 CAST(sum(n) AS BIGINT) AS weekly_comments FROM sundays GROUP BY 1, 2),
grown AS (SELECT *, CAST(sum(weekly_comments) OVER w AS BIGINT) AS cumulative_comments,
                 lag(weekly_comments) OVER w AS prev_week_comments
          FROM weeks WINDOW w AS (PARTITION BY song_id ORDER BY year_week))
SELECT g.year_week, g.song_id, s.song_name, s.artist_name, g.weekly_comments, g.cumulative_comments, g.prev_week_comments,
       {percent('weekly_comments - prev_week_comments', 'prev_week_comments', 2)} AS growth_pct,
       CASE WHEN 10 * weekly_comments > 11 * prev_week_comments THEN '加速增长'
            WHEN 10 * weekly_comments < 9 * prev_week_comments THEN '增长放缓' ELSE '平稳' END AS growth_state
FROM grown g JOIN song s USING (song_id) WHERE prev_week_comments IS NOT NULL
ORDER BY year_week DESC, weekly_comments DESC, song_id LIMIT 20""",
)
_FUNNEL = statement(
    "comment_lengths",
    f""", f AS (
SELECT count(*) AS total, count(*) FILTER (WHERE like_count > 0) AS liked,
       count(*) FILTER (WHERE like_count >= 10) AS high, count(*) FILTER (WHERE like_count >= 100) AS viral,
       count(*) FILTER (WHERE like_count > 0 AND content_length > 50) AS quality FROM comment_lengths)
SELECT 'Level1-发表评论' AS funnel_level, total AS comment_count, 100.0::DOUBLE AS conversion_rate, '' AS trend FROM f
UNION ALL SELECT 'Level2-获得点赞', liked, {percent('liked', 'total', 2)}, '↓' FROM f
UNION ALL SELECT 'Level3-高赞(≥10)', high, {percent('high', 'liked', 2)}, '↓' FROM f
UNION ALL SELECT 'Level4-爆款(≥100赞)', viral, {percent('viral', 'high', 2)}, '↓' FROM f
UNION ALL SELECT '附-优质长评获赞', quality, {percent('quality', 'total', 2)}, '-' FROM f""",
)
ORACLES["sq4_interaction_funnel"] = _FUNNEL
ORACLES["set_union_all"] = _FUNNEL
ORACLES["sq5_artist_matrix"] = statement(
    "comment_lengths song",
    f""", g AS (
SELECT artist_name, count(DISTINCT comment_id) AS comment_count, count(DISTINCT user_id) AS user_count,
       CAST(sum(like_count) AS BIGINT) AS like_total, count(like_count) AS likes,
       count(*) FILTER (WHERE content_length <= 5) AS short_count,
       count(*) FILTER (WHERE content_length >= 50) AS deep_count,
       count(*) FILTER (WHERE like_count >= 100) AS viral_count
FROM comment_lengths JOIN song USING (song_id) GROUP BY artist_name HAVING count(DISTINCT comment_id) > 100)
SELECT artist_name, comment_count, user_count, like_total,
       {rounded('like_total', 'likes', 1)} AS avg_likes, {rounded('like_total', 'comment_count', 1)} AS interaction_depth,
       {rounded('comment_count', 'user_count', 2)} AS comments_per_user,
       short_count, {percent('short_count', 'comment_count', 1)} AS short_pct,
       deep_count, {percent('deep_count', 'comment_count', 1)} AS deep_pct,
       viral_count, {percent('viral_count', 'comment_count', 2)} AS viral_pct
FROM g ORDER BY interaction_depth DESC, artist_name LIMIT 15""",
)
