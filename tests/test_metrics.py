"""Edge semantics of the metric and report builders on literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from refrain.functions import labels as L
from refrain.functions.calendar import monday, year_week
from refrain.functions.numbers import percent, ratio
from refrain.operators import daily, segments, sentiment
from refrain.plans import pages, showcase

DAY = dt.date(2024, 1, 1)


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour, minutes=minute)


def test_ratio_rounds_half_up_exactly(spark):
    row = spark.range(1).select(
        ratio(F.lit(2675), F.lit(1000), 2).alias("a"),
        percent(F.lit(57), F.lit(20000), 3).alias("b"),
        ratio(F.lit(-1), F.lit(8), 2).alias("c"),
        percent(F.lit(1), F.lit(0), 2).alias("d"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == (2.68, 0.285, -0.13, None)


@pytest.mark.parametrize(
    "day, week",
    [
        ("2022-12-31", 202252),
        ("2023-01-01", 202301),
        ("2023-12-31", 202353),
        ("2024-01-06", 202353),
        ("2024-01-07", 202401),
    ],
)
def test_year_week_starts_on_sunday(spark, day, week):
    row = spark.range(1).select(
        year_week(F.lit(day).cast("date")).alias("w"), monday(F.lit(day).cast("date")).alias("m")
    ).first()
    assert row.w == week
    assert row.m.weekday() == 0 and 0 <= (dt.date.fromisoformat(day) - row.m).days < 7


def ranked(spark, rows):
    return spark.createDataFrame(
        rows, "dt date, song_id long, comment_count long, like_total long, reply_count long, heat_score double"
    )


def test_rank_trend_labels(spark):
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    heat = {1: (0.9, 0.5, 0.5), 2: (0.5, 0.9, 0.5), 3: (0.1, 0.1, 0.1)}
    rows = [(d, s, 1, 1, 1, h[i]) for s, h in heat.items() for i, d in enumerate(days)]
    songs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "song_id long, song_name string")
    out = showcase.heat_ranking(daily.daily_rank(ranked(spark, rows)), songs).collect()
    trend = {(r.dt, r.song_id): (r.heat_rank, r.prev_rank, r.rank_trend) for r in out}
    assert trend[days[0], 1] == (1, None, L.TREND_FLAT)  # no previous day counts as flat
    assert trend[days[1], 1] == (2, 1, L.TREND_DOWN)
    assert trend[days[1], 2] == (1, 2, L.TREND_UP)
    assert trend[days[2], 1] == (1, 2, L.TREND_UP)  # equal heat: the smaller id is first
    assert trend[days[2], 3] == (3, 3, L.TREND_FLAT)
    tied = showcase.heat_ranking(daily.daily_rank_with_ties(ranked(spark, rows)), songs).collect()
    assert {r.heat_rank for r in tied if r.dt == days[2] and r.song_id in (1, 2)} == {1}


def test_rank_remembers_positions_below_the_cut(spark):
    rows = [(DAY, s, 1, 1, 1, s / 100) for s in range(1, 31)]
    rows += [(DAY + dt.timedelta(days=1), s, 1, 1, 1, 1 - s / 100) for s in range(1, 31)]
    songs = spark.createDataFrame([(s, f"s{s}") for s in range(1, 31)], "song_id long, song_name string")
    out = showcase.heat_ranking(daily.daily_rank(ranked(spark, rows)), songs, top=1).collect()
    first = next(r for r in out if r.dt != DAY)
    assert (first.song_id, first.heat_rank, first.prev_rank, first.rank_change) == (1, 1, 30, -29)


def test_funnel_with_zero_divisors(spark):
    schema = "like_count long, content_length long"
    for rows in ([], [(0, 10), (0, 80)]):
        counts = showcase.funnel_counts(spark.createDataFrame(rows, schema))
        rates = counts.select(*[r.alias(c) for _, c, r, _ in showcase._funnel_steps()]).first()
        assert rates.total == 100.0
        assert rates.high is None and rates.viral is None


def test_growth_uses_the_previous_present_week(spark):
    moments = [at(0), at(1), at(21), at(22), at(23)]
    comment = spark.createDataFrame([(1, m) for m in moments], "song_id long, comment_time timestamp_ntz")
    rows = sorted(showcase.weekly_growth(comment).collect(), key=lambda r: r.year_week)
    assert [r.weekly_comments for r in rows] == [2, 3]
    assert rows[0].prev_week_comments is None and rows[0].growth_pct is None
    assert (rows[1].cumulative_comments, rows[1].growth_pct, rows[1].growth_state) == (5, 50.0, L.GROWTH_FASTER)


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10])
def test_rfm_small_user_sets(spark, n):
    rows = [(u, u * 10 + k, at(u), 10.0) for u in range(n) for k in range(2)]
    activity = spark.createDataFrame(rows, "user_id long, action_id long, moment timestamp_ntz, amount double")
    out = segments.user_rfm(activity, F.lit(dt.date(2024, 2, 1))).collect()
    assert len(out) == n
    newest = max(out, key=lambda r: r.user_id)
    assert newest.r_score == 4  # the nearest last action scores highest


def test_rfm_literal_recency(spark):
    rows = [(u, u, at(30 - d), 1.0) for u, d in enumerate([0, 1, 2, 9, 20])]
    activity = spark.createDataFrame(rows, "user_id long, action_id long, moment timestamp_ntz, amount double")
    out = segments.user_rfm(activity, F.lit(dt.date(2024, 1, 31)), literal_recency=True).collect()
    assert {r.recency: r.r_score for r in out} == {0: 4, 1: 4, 2: 4, 9: 2, 20: 1}


def test_churn_edges(spark):
    frame = spark.createDataFrame([(0.29,), (0.30,), (0.70,), (0.71,)], "churn_prob double")
    low, middle, high = L.RISK_LEVELS
    assert [r.risk_level for r in segments.churn_risk(frame).collect()] == [low, middle, middle, high]


def test_churn_label_uses_only_the_past_for_recency(spark):
    rows = [(1, 1, at(0), 1.0), (1, 2, at(95), 1.0), (2, 3, at(5), 1.0), (3, 4, at(99), 1.0)]
    activity = spark.createDataFrame(rows, "user_id long, action_id long, moment timestamp_ntz, amount double")
    out = segments.churn_label(activity, F.lit(DAY + dt.timedelta(days=100)), horizon=90).collect()
    assert {r.user_id: (r.recency_days, r.churned) for r in out} == {1: (10, 0), 2: (5, 1)}


def test_cohort_offsets(spark):
    rows = [(1, at(0)), (1, at(1)), (1, at(14)), (2, at(3)), (3, at(9)), (3, None)]
    activity = spark.createDataFrame(rows, "user_id long, moment timestamp_ntz")
    out = {(r.cohort_week, r.week_offset): (r.cohort_size, r.active_users, r.retention) for r in segments.cohort_retention(activity).collect()}
    second = DAY + dt.timedelta(days=7)
    assert out == {(DAY, 0): (2, 2, 1.0), (DAY, 2): (2, 1, 0.5), (second, 0): (1, 1, 1.0)}


def test_histogram_edges(spark):
    def counts(values):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        return [r.user_count for r in pages.value_histogram(frame, "v").orderBy("bin").collect()]

    spread = counts([0.0, 0.5, 1.0, 1.0, None])
    assert len(spread) == 20 and spread[0] == 1 and spread[10] == 1 and spread[19] == 2
    same = counts([0.4, 0.4, 0.4])
    assert len(same) == 20 and same[0] == 3 and sum(same) == 3
    assert counts([None]) == []


FACTS = "song_id long, song_name string, comment_id long, positive_prob double, sentiment string, comment_time timestamp_ntz"


def facts(spark, rows):
    """Scored comments with their time, and the songs they belong to."""
    frame = spark.createDataFrame(rows, FACTS)
    timed = sentiment.timed_scores(frame.select("comment_id", "song_id", "positive_prob", "sentiment", "comment_time"))
    return timed, frame.select("song_id", "song_name").distinct()


def test_weekly_movement(spark):
    rows = [
        (1, "a", 1, 1.0, "positive", at(0)),
        (1, "a", 2, None, None, at(1)),
        (1, "a", 3, 0.0, "negative", at(7)),
        (1, "a", 4, 1.0, "positive", at(28)),  # two weeks are missing in between
        (1, "a", 5, 1.0, "positive", None),
    ]
    out = sentiment.weekly_movement(*facts(spark, rows)).orderBy("week").collect()
    assert [(r.positive_ratio, r.neutral_ratio, r.negative_ratio) for r in out] == [(0.5, 0.5, 0), (0, 0, 1), (1, 0, 0)]
    assert [r.avg_positive_prob for r in out] == [0.5, 0.0, 1.0]
    assert [r.velocity for r in out] == [0.0, -0.5, 1.0]
    assert [r.acceleration for r in out] == [0.0, 0.0, 1.5]


def test_weekly_movement_keeps_the_last_weeks(spark):
    rows = [(1, "a", i, 1.0, "positive" if i % 2 else "negative", at(7 * i)) for i in range(31)]
    out = sentiment.weekly_movement(*facts(spark, rows)).orderBy("week").collect()
    assert len(out) == 30
    assert out[0].week == DAY + dt.timedelta(days=7) and out[0].velocity == 1.0


@pytest.mark.parametrize("n", [9, 10, 11, 33])
def test_shift_slices(spark, n):
    rows = [(1, "a", i, 1.0, "positive" if i >= n // 2 else "negative", at(0, 0, i)) for i in range(n)]
    out = sentiment.shift_per_song(*facts(spark, rows)).collect()
    if n < 10:
        assert out == []
        return
    row = out[0]
    assert (row.early_positive_ratio, row.recent_positive_ratio) == (0.0, 1.0)
    assert row.change_rate == 100.0  # no early positives: difference instead of relative change
    assert row.comment_count == n


def test_shift_relative_change(spark):
    moods = ["positive"] * 3 + ["neutral"] * 4 + ["positive", "negative", "negative"]
    rows = [(1, "a", i, 0.5, m, at(0, 0, i)) for i, m in enumerate(moods)]
    row = sentiment.shift_per_song(*facts(spark, rows)).first()
    assert (row.early_positive_ratio, row.recent_positive_ratio) == (1.0, 0.333333)
    assert row.change_rate == -66.666667


def test_unknown_songs_do_not_count(spark):
    rows = [(s, "x", 10 * s + i, 1.0, "positive", at(0, 0, i)) for s in (1, 2) for i in range(10)]
    timed, songs = facts(spark, rows)
    known = songs.filter("song_id = 1")
    assert sentiment.weekly_movement(timed, known).first().comment_count == 10
    assert [r.song_id for r in sentiment.shift_per_song(timed, known).collect()] == [1]


def test_portrait_without_sentiment_and_ties_in_periods(spark):
    comment = spark.createDataFrame(
        [(7, 1, 0, at(0, 20), 1), (7, 0, 0, at(0, 3), 2), (8, 5, 1, None, 3)],
        "user_id long, like_count long, reply_count long, comment_time timestamp_ntz, doc_id long",
    )
    scores = spark.createDataFrame([(3, 1.0)], "doc_id long, positive_prob double")
    out = {r.user_id: r for r in segments.portrait(comment, scores).collect()}
    assert out[7].active_period == L.DAY_PERIODS[0]  # a tie goes to the earlier period
    assert out[7].avg_sentiment is None and out[7].sentiment_type == L.USER_NEUTRAL
    assert out[8].active_period == L.DAY_PERIODS[3]  # a missing time counts as evening
    assert out[8].sentiment_type == L.USER_POSITIVE


def test_orphan_keys(spark):
    from refrain.operators.quality import orphans

    comment = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, 8), (5, None)], "comment_id long, song_id long")
    songs = spark.createDataFrame([(1,), (1,), (2,)], "song_id long")
    row = orphans(comment, [("comment.song_id", "song_id", songs, "song_id")]).first()
    assert (row.orphan_keys, row.orphan_rows) == (2, 3)
    row = orphans(comment.filter("song_id = 1"), [("comment.song_id", "song_id", songs, "song_id")]).first()
    assert (row.orphan_keys, row.orphan_rows) == (0, 0)


def test_invariants(spark):
    from refrain.plans.warehouse import Warehouse

    w = Warehouse(spark, "/root/testdata/sf0.001")
    n = w.comment.count()
    total = lambda frame: frame.agg(F.sum("comment_count")).first()[0]
    assert total(w.hourly) == total(w.weekday) == total(w.song_daily) == n
    first = w.cohort.filter("week_offset = 0").agg(F.min("retention"), F.max("retention")).first()
    assert tuple(first) == (1.0, 1.0)
    summary = w.sentiment_summary.first()
    assert abs(summary.positive_ratio + summary.neutral_ratio + summary.negative_ratio - 1) < 2e-6
    assert abs(summary.satisfaction_score - summary.positive_ratio + summary.negative_ratio) < 2e-6
    assert pages.trend_counts(w).count() <= 31


def test_approximate_matrix_is_close_to_the_exact_one(spark):
    from refrain.plans.warehouse import Warehouse

    w = Warehouse(spark, "/root/testdata/sf0.001")
    exact = {r.artist_name: r for r in showcase.artist_matrix(w.comment_lengths, w.song, more_than=0).collect()}
    close = showcase.artist_matrix(w.comment_lengths, w.song, more_than=0, approximate=True).collect()
    assert len(close) == len(exact) > 0
    for row in close:
        if row.artist_name in exact:
            want = exact[row.artist_name]
            assert abs(row.comment_count - want.comment_count) <= 0.15 * want.comment_count + 1
            assert row.like_total == want.like_total


def test_artists_by_collation(spark):
    comment = spark.createDataFrame(
        [(i, i, i % 3, 1, 10) for i in range(6)],
        "comment_id long, user_id long, song_id long, like_count long, content_length long",
    )
    songs = spark.createDataFrame([(0, "Zoé"), (1, "ZOE"), (2, "other")], "song_id long, artist_name string")
    binary = showcase.artist_matrix(comment, songs, more_than=0)
    assert sorted(r.comment_count for r in binary.collect()) == [2, 2, 2]
    loose = showcase.artist_matrix(comment, songs, more_than=0, collation="UNICODE_CI_AI")
    assert sorted(r.comment_count for r in loose.collect()) == [2, 4]


def test_as_of_is_a_parameter(spark):
    from refrain.plans.warehouse import Warehouse

    early = Warehouse(spark, "/root/testdata/sf0.001", as_of=dt.date(2024, 1, 15))
    days = [r.dt for r in showcase.sq1(early).select("dt").distinct().collect()]
    assert min(days) == dt.date(2024, 1, 8)
