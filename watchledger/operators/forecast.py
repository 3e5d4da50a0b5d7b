"""Forecasts per series by triple exponential smoothing, with error bands from a rolling-origin back-test.

Incidents shrink to daily counts per series (type and location); every series is
dense, short and smoothed by itself in one Arrow group.  With fixed weights the state
after day t is the forecast origin of day t, so one pass yields the forecasts of
all origins, and their errors for each horizon are the back-test.  The whole is
smoothed as a series of its own; the parts' forecasts are scaled to add up to it.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.workspace import materialize

# Tasks receive the functions of this module by value: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEASON = 7
#: Weights of the newest day in level, trend and season.
WEIGHTS = (0.3, 0.05, 0.2)
#: Half width of a band that holds 80 % of normal errors, in standard errors.
BAND = 1.2815515655446004


def smoothed(y: np.ndarray, horizon: int, weights: Sequence[float] = WEIGHTS, season: int = SEASON) -> np.ndarray:
    """Row t: the forecasts for t + 1, ..., t + horizon made on day t; rows before the first season are nan.

    Level and season start from the first season, the trend from zero.
    """
    out = np.full((len(y), horizon), np.nan)
    if len(y) < season:
        return out
    a, b, c = weights
    level, trend = float(y[:season].sum()) / season, 0.0
    seasonal = [float(v) - level for v in y[:season]]
    for t in range(season - 1, len(y)):
        if t >= season:
            s, before = seasonal[t % season], level
            level = a * (y[t] - s) + (1 - a) * (level + trend)
            trend = b * (level - before) + (1 - b) * trend
            seasonal[t % season] = c * (y[t] - level) + (1 - c) * s
        out[t] = [level + h * trend + seasonal[(t + h) % season] for h in range(1, horizon + 1)]
    return out


def back_test(y: np.ndarray, made: np.ndarray, first: int) -> tuple[list[float], list[int]]:
    """Root mean square error and number of origins for each horizon, over the origins from day ``first`` on."""
    errors = [y[first + h :] - made[first : len(y) - h, h - 1] if len(y) - h > first else np.zeros(0) for h in range(1, made.shape[1] + 1)]
    return [float(np.sqrt((e**2).mean())) if len(e) else np.nan for e in errors], [len(e) for e in errors]


def daily_series(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Daily counts of every series and of the whole (``series`` null), dense from the first to the last day of all."""
    cells = df.where("timestamp is not null").groupBy(*by, F.to_date("timestamp").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    name = F.to_json(F.struct(*by), {"ignoreNullFields": "false"})
    cells = materialize(cells.select(name.alias("series"), "date", "n"), "daily-cells")
    cells = cells.unionAll(cells.groupBy("date").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("series"), "date", "n"))
    span = cells.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(F.sequence("a", "b").alias("s")).scalar()
    days = cells.select("series").distinct().withColumn("date", F.explode(span))
    filled = days.join(cells.withColumnRenamed("series", "_series"), F.col("series").eqNullSafe(F.col("_series")) & (days["date"] == cells["date"]), "left")
    return filled.select("series", days["date"], F.coalesce("n", F.lit(0)).alias("n"))


def series_forecast(df: DataFrame, by: Sequence[str] = ("event_type", "location"), horizon: int = 7, weights: Sequence[float] = WEIGHTS, season: int = SEASON) -> DataFrame:
    """Per series (null: the whole) and coming day: forecast, its share of the whole's forecast, back-test error and an 80 % band.

    ``forecast`` is the series' own, not below zero; ``reconciled`` are scaled so that the
    parts add up to the whole.  The back-test's origins start after two seasons.
    """

    def smooth(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("date")
        y = group["n"].to_numpy(dtype=float)
        made = smoothed(y, horizon, weights, season)
        error, origins = back_test(y, made, 2 * season - 1)
        last = pd.to_datetime(group["date"].iloc[-1])
        return pd.DataFrame({
            "series": [group["series"].iloc[0]] * horizon, "date": [(last + pd.Timedelta(days=h)).date() for h in range(1, horizon + 1)], "horizon": range(1, horizon + 1),
            "forecast": np.where(np.isnan(made[-1]), None, np.maximum(made[-1], 0)), "error": [None if np.isnan(e) else e for e in error], "origins": origins})

    made = daily_series(df, by).groupBy("series").applyInPandas(smooth, "series string, date date, horizon int, forecast double, error double, origins long")
    made = materialize(made, "forecasts")
    whole = made.where("series is null").select("horizon", F.col("forecast").alias("whole"))
    parts = made.where("series is not null").groupBy("horizon").agg(F.sum("forecast").alias("parts"))
    scale = materialize(whole.join(parts, "horizon").select("horizon", F.try_divide("whole", "parts").alias("scale")), "scales")  # one row a day
    share = F.when(F.col("series").isNull(), F.col("forecast")).otherwise(F.col("forecast") * F.coalesce("scale", F.lit(1.0)))
    scaled = made.join(F.broadcast(scale), "horizon", "left").withColumn("reconciled", share)
    return scaled.select(
        "series", "date", F.col("horizon").cast("long").alias("horizon"), "forecast", "reconciled", "error", "origins",
        F.greatest(F.col("reconciled") - BAND * F.col("error"), F.lit(0.0)).alias("low"), (F.col("reconciled") + BAND * F.col("error")).alias("high"))


def band_coverage(df: DataFrame, by: Sequence[str] = ("event_type", "location"), held_out: int = 7) -> DataFrame:
    """Share of the last ``held_out`` days' counts inside the bands of a forecast made before them, for the parts and the whole."""
    last = df.agg(F.max(F.to_date("timestamp")).alias("d")).first()["d"]
    cut = F.date_sub(F.lit(last), held_out)
    bands = series_forecast(df.where(F.to_date("timestamp") <= cut), by, held_out)
    truth = daily_series(df, by).select(F.col("series").alias("s"), F.col("date").alias("d"), "n")
    seen = bands.join(truth, F.col("series").eqNullSafe(F.col("s")) & (F.col("date") == F.col("d")))
    inside = (F.col("n") >= F.col("low")) & (F.col("n") <= F.col("high"))
    return seen.where("error is not null").groupBy(F.when(F.col("series").isNull(), "whole").otherwise("part").alias("level")).agg(
        F.count(F.lit(1)).alias("days"), F.avg(F.when(inside, 1.0).otherwise(0.0)).alias("coverage"), F.avg(F.abs(F.col("n") - F.col("reconciled"))).alias("mean_absolute_error"))
