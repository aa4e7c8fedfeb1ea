"""Piecewise forecasts against numpy."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from refrain.operators import forecasting
from refrain.operators.forecasting import Shape

START = datetime.date(2023, 3, 5)
EPOCH = datetime.date(1970, 1, 1)


def design(days, first, last, shape):
    rows = []
    for d in days:
        u = (d - first) / (last - first)
        row = [1.0, u, *[max(u - c, 0.0) for c in shape.points]]
        for period, n in shape.seasons:
            for k in range(1, n + 1):
                row += [math.sin(2 * math.pi * k * d / period), math.cos(2 * math.pi * k * d / period)]
        rows.append(row)
    return np.array(rows)


def series(n, value, gaps=0, seed=1):
    rng = random.Random(seed)
    return [(START + datetime.timedelta(days=i), value(i, rng)) for i in range(n) if not (gaps and i and i < n - 1 and rng.random() < gaps)]


SERIES = {
    1: series(60, lambda i, r: 0.2 + 0.01 * i + 0.1 * math.sin(2 * math.pi * i / 7)),
    2: series(90, lambda i, r: 0.9 - 0.005 * i + r.gauss(0, 0.05), gaps=0.3),
    3: series(40, lambda i, r: 0.5 if i < 20 else 0.1 * (i - 15)),
    4: series(13, lambda i, r: 0.5),
}


def frame(spark):
    rows = [(s, d, float(v)) for s, points in SERIES.items() for d, v in points]
    return spark.createDataFrame([*rows, (5, START, 1.0), (6, None, 1.0)], "song_id long, dt date, heat_score double")


@pytest.mark.parametrize("shape", [Shape(), Shape(changes=3, seasons=((7.0, 3), (30.5, 1)), hinge_penalty=0.5)])
def test_equals_ridge_regression_in_numpy(spark, shape):
    got = {}
    for r in forecasting.forecast_piecewise(frame(spark), horizon=14, shape=shape).collect():
        got.setdefault(r.song_id, []).append(r)
    assert set(got) == {1, 2, 3}
    for song, rows in got.items():
        days = [(d - EPOCH).days for d, _ in SERIES[song]]
        y = np.array([v for _, v in SERIES[song]])
        a = design(days, days[0], days[-1], shape)
        beta = np.linalg.solve(a.T @ a + np.diag(shape.penalties), a.T @ y)
        sd = math.sqrt(((y - a @ beta) ** 2).sum() / (len(y) - 1))
        rows.sort(key=lambda r: r.forecast_date)
        assert [(r.forecast_date - EPOCH).days for r in rows] == [days[-1] + h for h in range(1, 15)]
        want = design([days[-1] + h for h in range(1, 15)], days[0], days[-1], shape) @ beta
        assert [r.heat_score for r in rows] == pytest.approx(np.maximum(want, 0).tolist(), abs=2e-6)
        assert [r.heat_score_upper for r in rows] == pytest.approx(np.maximum(want + 1.96 * sd, 0).tolist(), abs=1e-4)
        assert all(0 <= r.heat_score_lower <= r.heat_score <= r.heat_score_upper for r in rows)


def test_trend_breaks_and_weeks_are_followed(spark):
    rows = {s: [r.heat_score for r in sorted(forecasting.forecast_piecewise(frame(spark).filter(F.col("song_id") == s)).collect(), key=lambda r: r.forecast_date)] for s in (1, 3)}
    assert rows[1][6] - rows[1][0] > 0 and max(abs(v - (0.2 + 0.01 * (60 + h) + 0.1 * math.sin(2 * math.pi * (60 + h) / 7))) for h, v in enumerate(rows[1])) < 0.08
    assert rows[3][-1] > rows[3][0] > 1.5  # the late rise goes on


def test_days_are_shuffled_once(spark):
    plan = forecasting.gram_sums(frame(spark), "song_id", "dt", "heat_score", Shape())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_no_series(spark):
    assert forecasting.forecast_piecewise(frame(spark).limit(0)).count() == 0
