"""Forecasts with a piecewise linear trend and seasons, fitted by item in one pass.

A series is regressed on a constant, its time from 0 to 1, hinges at evenly spaced change points,
and sines and cosines of each season; hinges and seasons are held back by a ridge penalty. All that
the regression needs of a series are the sums of products of these terms, so days fold into one row
per item and the small system of equations is solved in the row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Shape:
    """The terms of the regression; ``seasons`` are (days of a period, number of harmonics)."""

    changes: int = 5
    span: float = 0.8  # of the history, over which the change points lie
    seasons: tuple[tuple[float, int], ...] = ((7.0, 2),)
    hinge_penalty: float = 1.0
    season_penalty: float = 0.1

    @property
    def points(self) -> list[float]:
        return [self.span * k / self.changes for k in range(1, self.changes + 1)]

    @property
    def size(self) -> int:
        return 2 + self.changes + 2 * sum(n for _, n in self.seasons)

    @property
    def penalties(self) -> list[float]:
        return [1e-9, 1e-9, *[self.hinge_penalty] * self.changes, *[self.season_penalty] * (self.size - 2 - self.changes)]

    def terms(self, time: Column, day: Column) -> list[Column]:
        """Values of all terms; ``time`` is 0 to 1 within the history, ``day`` a day number."""
        out = [F.lit(1.0), time, *[F.greatest(time - F.lit(c), F.lit(0.0)) for c in self.points]]
        for period, harmonics in self.seasons:
            turn = day / F.lit(period) - F.floor(day / F.lit(period))
            for k in range(1, harmonics + 1):
                out += [F.sin(F.lit(2 * math.pi * k) * turn), F.cos(F.lit(2 * math.pi * k) * turn)]
        return out


def gram_sums(series: DataFrame, item: str, day: str, value: str, shape: Shape, minimum: int = 14) -> DataFrame:
    """(item, n, first, last, gram, moments, squares) of every item with at least ``minimum`` days.

    ``gram`` holds the upper triangle of the products row by row. The days are shuffled once, by
    item; the bounds of a series are windows over that partitioning.
    """
    own = Window.partitionBy(item)
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).cast("double")
    rows = series.select(item, number.alias("__day"), F.col(value).cast("double").alias("__y")).filter("__day is not null and __y is not null").repartition(item)
    rows = rows.withColumns({"__n": F.count(F.lit(1)).over(own), "__from": F.min("__day").over(own), "__to": F.max("__day").over(own)}).filter((F.col("__n") >= minimum) & (F.col("__to") > F.col("__from")))
    time = (F.col("__day") - F.col("__from")) / (F.col("__to") - F.col("__from"))
    names = [f"__t{i}" for i in range(shape.size)]
    rows = rows.select(item, "__n", "__from", "__to", "__day", "__y", *[t.alias(n) for t, n in zip(shape.terms(time, F.col("__day")), names, strict=True)])
    products = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
    return rows.groupBy(item).agg(
        F.first("__n").alias("n"),
        F.first("__from").alias("first"),
        F.first("__to").alias("last"),
        F.array(*products).alias("gram"),
        F.array(*[F.sum(F.col(a) * F.col("__y")) for a in names]).alias("moments"),
        F.sum(F.col("__y") * F.col("__y")).alias("squares"),
    )


def solve(gram: np.ndarray, moments: np.ndarray, squares: np.ndarray, counts: np.ndarray, penalties: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Ridge coefficients and residual deviations of many items at a time."""
    size = moments.shape[1]
    full = np.zeros((len(gram), size, size))
    upper = np.triu_indices(size)
    full[:, upper[0], upper[1]] = gram
    full[:, upper[1], upper[0]] = gram
    beta = np.linalg.solve(full + np.diag(penalties), moments[:, :, None])[:, :, 0]
    left = squares - 2 * (beta * moments).sum(axis=1) + np.einsum("ni,nij,nj->n", beta, full, beta)
    return beta, np.sqrt(np.maximum(left, 0) / np.maximum(counts - 1, 1))


def fitted(sums: DataFrame, shape: Shape) -> DataFrame:
    """Add ``beta`` and ``sd`` to the rows of ``gram_sums``."""

    @F.arrow_udf("beta array<double>, sd double")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for gram, moments, squares, n in batches:
            lists = [np.array(c.to_pylist(), np.float64) for c in (gram, moments)]
            if not len(n):
                yield pa.StructArray.from_arrays([pa.array([], pa.list_(pa.float64())), pa.array([], pa.float64())], ["beta", "sd"])
                continue
            beta, sd = solve(*lists, *(c.to_numpy(zero_copy_only=False) for c in (squares, n)), shape.penalties)
            yield pa.StructArray.from_arrays([pa.array(list(beta), pa.list_(pa.float64())), pa.array(sd)], ["beta", "sd"])

    return sums.withColumn("__fit", run("gram", "moments", "squares", "n")).withColumns({"beta": F.col("__fit.beta"), "sd": F.col("__fit.sd")}).drop("__fit")


def forecast_piecewise(series: DataFrame, item: str = "song_id", day: str = "dt", value: str = "heat_score", *, horizon: int = 30, shape: Shape | None = None) -> DataFrame:
    """(item, forecast_date, value with its lower and upper bound) for the days after each series.

    The last trend goes on; bounds are 1.96 residual deviations, nothing is below zero.
    """
    shape = shape or Shape()
    ahead = fitted(gram_sums(series, item, day, value, shape), shape).withColumn("__day", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("__day", F.col("last") + F.col("__day"))
    time = (F.col("__day") - F.col("first")) / (F.col("last") - F.col("first"))
    level = sum((t * F.get("beta", F.lit(i)) for i, t in enumerate(shape.terms(time, F.col("__day")))), F.lit(0.0))
    placed = ahead.select(item, F.date_from_unix_date(F.col("__day").cast("int")).alias("forecast_date"), level.alias("__y"), "sd")
    zero = F.lit(0.0)
    return placed.select(
        item,
        "forecast_date",
        F.round(F.greatest("__y", zero), 6).alias(value),
        F.round(F.greatest(F.col("__y") - 1.96 * F.col("sd"), zero), 6).alias(f"{value}_lower"),
        F.round(F.greatest(F.col("__y") + 1.96 * F.col("sd"), zero), 6).alias(f"{value}_upper"),
    )
