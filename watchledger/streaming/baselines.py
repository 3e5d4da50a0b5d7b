"""Spikes against a baseline that lives in the stream.

Hourly counts come out of the window aggregate once the watermark has passed them.
Per hour of day (24 keys) an exponentially weighted mean and variance are kept in
state; a count is compared with them before it changes them.  What rises slowly
becomes the baseline, what jumps is reported.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from math import sqrt

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from watchledger.streaming.jobs import LATENESS, drain, event_time, wall_clock
from watchledger.streaming.periods import rocks_store

# Tasks receive the functions of this module by value: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_OUTPUT = "window_start timestamp, window_end timestamp, incidents long, expected double, deviation double"


def followed(state: tuple[float, float, int] | None, x: float, weight: float) -> tuple[float, float, int]:
    """(mean, variance, counts seen) after ``x``."""
    if state is None:
        return x, 0.0, 1
    mean, variance, seen = state
    apart = x - mean
    return mean + weight * apart, (1 - weight) * (variance + weight * apart * apart), seen + 1


class HourBaseline(StatefulProcessor):
    def __init__(self, weight: float, deviations: float, least: float, warm: int):
        self.weight, self.deviations, self.least, self.warm = weight, deviations, least, warm

    def init(self, handle) -> None:
        self.level = handle.getValueState("level", "mean double, variance double, seen long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hours = pd.concat(rows).sort_values("window_start")  # one row a day
        state = tuple(self.level.get()) if self.level.exists() else None
        spikes = []
        for row in hours.itertuples(index=False):
            x = float(row.incidents)
            if state is not None and state[2] >= self.warm and x > state[0] + self.deviations * sqrt(state[1]) + self.least:
                spikes.append((row.window_start, row.window_end, int(x), state[0], sqrt(state[1])))
            state = followed(state, x, self.weight)
        self.level.update(state)
        yield pd.DataFrame(spikes, columns=["window_start", "window_end", "incidents", "expected", "deviation"]).astype({"incidents": "int64", "expected": float, "deviation": float})

    def close(self) -> None:
        pass


def stream_baseline_spikes(incidents: DataFrame, weight: float = 0.3, deviations: float = 3.0, least: float = 1.0, warm: int = 3, lateness: str = LATENESS) -> DataFrame:
    """Hours with more incidents than ``deviations`` standard deviations and ``least`` above the baseline of their hour of day, after ``warm`` hours seen."""
    counts = event_time(incidents.where("timestamp is not null"), "timestamp", lateness).groupBy(F.window("timestamp", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("incidents"))
    flat = counts.select(F.hour("w.start").alias("hour"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "incidents")
    spikes = flat.groupBy("hour").transformWithStateInPandas(HourBaseline(weight, deviations, least, warm), _OUTPUT, "Append", "None")
    return wall_clock(spikes, "window_start", "window_end")


def drain_spikes(spikes: DataFrame) -> DataFrame:
    """The spikes of a finite stream."""
    with rocks_store(spikes.sparkSession):
        return drain(spikes, "baseline-spikes")
