"""Smoothing against the written-out recurrence; bands measured."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from watchledger.operators import forecast

T0 = datetime(2024, 1, 1)


def recurrence(y, horizon, a=0.3, b=0.05, c=0.2, m=7):
    """Level, trend and season as functions of the day."""
    level, trend = {m - 1: sum(y[:m]) / m}, {m - 1: 0.0}
    season = {t: y[t] - level[m - 1] for t in range(m)}
    for t in range(m, len(y)):
        level[t] = a * (y[t] - season[t - m]) + (1 - a) * (level[t - 1] + trend[t - 1])
        trend[t] = b * (level[t] - level[t - 1]) + (1 - b) * trend[t - 1]
        season[t] = c * (y[t] - level[t]) + (1 - c) * season[t - m]
    return {t: [level[t] + h * trend[t] + season[t + h - m * math.ceil(h / m)] for h in range(1, horizon + 1)] for t in level}


def test_smoothing_equals_the_recurrence():
    rng = random.Random(1)
    y = [rng.randrange(30) + 5 * (t % 7) for t in range(60)]
    made, want = forecast.smoothed(np.array(y, float), 10), recurrence(y, 10)
    assert np.isnan(made[:6]).all()
    assert all(made[t] == pytest.approx(want[t]) for t in want)
    error, origins = forecast.back_test(np.array(y, float), made, 13)
    assert origins == [60 - 13 - h for h in range(1, 11)]
    assert error[2] == pytest.approx(math.sqrt(sum((y[t + 3] - want[t][2]) ** 2 for t in range(13, 57)) / 44))


def test_a_weekly_pattern_is_learned():
    y = np.array([10.0 + 20 * (t % 7 == 2) + 0.1 * t for t in range(140)])
    made = forecast.smoothed(y, 7)
    assert np.abs(made[132] - y[133:140]).max() < 0.5


def test_parts_add_up_and_bands_hold(make_incidents):
    rng, rows = random.Random(5), []
    for day in range(120):
        for kind, mean in (("Malware", 12), ("Port Scan", 5)):
            for place in ("Brazil", None):
                for _ in range(max(0, round(rng.gauss(mean * (2 if day % 7 == 3 else 1), 2)))):
                    rows.append({"event_id": len(rows), "timestamp": T0 + timedelta(days=day, minutes=len(rows) % 1400), "source_ip": "10.0.0.1", "event_type": kind, "location": place})
    df = make_incidents(rows)
    found = forecast.series_forecast(df).toPandas()
    assert len(found) == 5 * 7
    whole = found[found["series"].isna()].set_index("horizon")
    assert np.allclose(found[found["series"].notna()].groupby("horizon")["reconciled"].sum(), whole["forecast"].sort_index())
    assert whole["forecast"].idxmax() == 7 - (119 - 3) % 7
    coverage = {r["level"]: r for r in forecast.band_coverage(df).collect()}
    assert coverage["part"]["days"] == 28 and 0.6 <= coverage["part"]["coverage"] <= 1.0


def test_short_and_empty_series(make_incidents):
    rows = [{"event_id": i, "timestamp": T0 + timedelta(days=i), "source_ip": "10.0.0.1"} for i in range(4)]
    found = forecast.series_forecast(make_incidents(rows)).collect()
    assert len(found) == 14 and all(r["forecast"] is None for r in found)
    assert forecast.series_forecast(make_incidents(rows).where("event_id > 9")).count() == 0
