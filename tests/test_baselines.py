"""A baseline that follows the stream: jumps are reported, slow rises are not."""

from datetime import datetime, timedelta

import pytest

from watchledger.streaming import baselines

T0 = datetime(2024, 1, 1)


def spikes(spark, make_incidents, path, per_day, **options):
    """Hour 9 of each day has as many incidents as given; the days come as files, one batch each."""
    for day, n in enumerate(per_day):
        make_incidents([{"event_id": 1000 * day + i, "timestamp": T0 + timedelta(days=day, hours=9, seconds=i), "source_ip": "10.0.0.1"} for i in range(n)]).coalesce(1).write.mode("append").parquet(path)
    schema = make_incidents([{"event_id": 1, "timestamp": T0, "source_ip": "a"}]).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    found = baselines.drain_spikes(baselines.stream_baseline_spikes(stream, **options))
    return [((r["window_start"] - T0).days, r["incidents"], r["expected"]) for r in found.orderBy("window_start").collect()]


def test_jump_but_no_slow_rise(spark, make_incidents, tmp_path):
    rise = [10, 11, 12, 13, 14, 15, 16, 17]
    assert spikes(spark, make_incidents, str(tmp_path / "rise"), rise, least=3.0) == []
    found = spikes(spark, make_incidents, str(tmp_path / "jump"), [10, 11, 10, 11, 40, 11, 11], least=3.0)
    assert [(d, n) for d, n, _ in found] == [(4, 40)]
    assert found[0][2] == pytest.approx(10 + 0.3 * (1 - 0.3) ** 2 + 0.3, abs=0.2)


def test_state_follows():
    state = None
    for x in (4.0, 6.0, 5.0):
        state = baselines.followed(state, x, 0.5)
    assert state == (5.0, 0.5, 3)
