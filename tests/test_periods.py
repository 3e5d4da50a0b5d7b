"""Stateful periods of activity: state that ends, and a table merged by key."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from watchledger.streaming import jobs, periods

T0 = datetime(2024, 1, 1)


def expected(rows, hours=6):
    """(source, start, end, incidents) by walking through each source's times."""
    out = []
    for source in {s for s, _ in rows}:
        for at in sorted(t for s, t in rows if s == source):
            if out and out[-1][0] == source and at - out[-1][2] < timedelta(hours=hours):
                out[-1] = (source, out[-1][1], at, out[-1][3] + 1)
            else:
                out.append((source, at, at, 1))
    return sorted(out)


def test_joined_periods():
    assert periods.joined_periods([(10, 10, 1, 2), (0, 3, 2, 4), (16, 16, 1, 1), (30, 30, 1, 1)], 7) == [(0, 3, 2, 4), (10, 16, 2, 3), (30, 30, 1, 1)]
    assert periods.joined_periods([(0, 20, 5, 5), (4, 5, 1, 1)], 7) == [(0, 20, 6, 6)]


def test_state_ends_and_a_restart_repeats_nothing(spark, make_incidents, tmp_path):
    rng = random.Random(9)
    rows = [(f"10.0.0.{rng.randrange(6)}", T0 + timedelta(minutes=rng.randrange(4 * 24 * 60))) for _ in range(150)]
    rows += [("10.0.0.77", T0 + timedelta(hours=1)), ("10.0.0.9", T0 + timedelta(days=4, hours=1))]
    rows.sort(key=lambda r: r[1])
    frames = [make_incidents([{"event_id": i, "timestamp": at, "source_ip": s} for i, (s, at) in enumerate(rows) if i * 5 // len(rows) == part]) for part in range(5)]
    path, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def go_on():
        stream = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)
        return periods.run_periods(periods.stream_ip_periods(stream), out, state)

    for part in frames[:2]:
        part.coalesce(1).write.mode("append").parquet(path)
    first, _ = go_on()
    assert first.where("closed").count() > 0
    for part in frames[2:]:
        part.coalesce(1).write.mode("append").parquet(path)
    table, query = go_on()
    got = table.collect()
    assert sorted((r["source_ip"], r["period_start"], r["period_end"], r["incidents"]) for r in got) == expected(rows)
    still = [r for r in got if not r["closed"]]
    assert all(r["period_end"] > T0 + timedelta(days=3) for r in still)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] == len(still) <= 7 < len(got)  # one state row for each open period, none for the closed ones
    again, query = go_on()  # nothing new
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))


def test_batch_tried_again_replaces_itself(spark, tmp_path):
    table = periods.MergedTable(spark, str(tmp_path / "t"), ["k"], F.col("v") > 0, buckets=3)
    frame = lambda rows: spark.createDataFrame(rows, "k string, v long")
    table.merge(frame([("a", 1), ("b", 1), ("c", 1)]), 0)
    for _ in range(2):
        table.merge(frame([("b", 2), ("c", 0), ("d", 5)]), 1)
    assert sorted(map(tuple, table.read("k string, v long").collect())) == [("a", 1), ("b", 2), ("d", 5)]


def test_late_event_bridges_two_periods(spark, make_incidents, tmp_path):
    path = str(tmp_path / "in")
    for part in ([(1, 0.0), (2, 7.0)], [(3, 6.5), (4, 3.5)]):
        make_incidents([{"event_id": i, "timestamp": T0 + timedelta(hours=h), "source_ip": "10.0.0.1"} for i, h in part]).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(make_incidents([{"event_id": 1, "timestamp": T0, "source_ip": "a"}]).schema).option("maxFilesPerTrigger", 1).parquet(path)
    found = periods.drain_periods(periods.stream_ip_periods(jobs.with_end(stream, "timestamp"), lateness="5 hours")).collect()
    assert [(r["incidents"], r["closed"]) for r in found] == [(4, True)]


def test_a_source_has_one_timer(spark, make_incidents, tmp_path):
    """However many periods a source has: their state is read and written once a batch, not once for each."""
    path = str(tmp_path / "in")
    rows = [(f"10.0.0.{s}", T0 + timedelta(hours=8 * i + s)) for s in range(3) for i in range(40)]
    make_incidents([{"event_id": i, "timestamp": at, "source_ip": s} for i, (s, at) in enumerate(rows)]).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(make_incidents([{"event_id": 1, "timestamp": T0, "source_ip": "a"}]).schema).parquet(path)
    table, query = periods.run_periods(periods.stream_ip_periods(jobs.with_end(stream, "timestamp")), str(tmp_path / "out"), str(tmp_path / "state"))
    got = table.where(F.col("period_start") < "2200-01-01").collect()
    assert sorted((r["source_ip"], r["period_start"], r["period_end"], r["incidents"]) for r in got) == expected(rows) and all(r["closed"] for r in got)
    timers = [p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress if p["stateOperators"]]
    assert sum(timers) <= 4  # three sources and the row that ends the input


def test_busy_source_and_late_rows_of_a_closed_period(spark, make_incidents, tmp_path, monkeypatch):
    monkeypatch.setattr(periods, "INPUT_ROWS", 7)
    rng = random.Random(4)
    rows = sorted(((s, T0 + timedelta(minutes=rng.randrange(3 * 24 * 60))) for s in ["10.0.0.1"] * 150 + [f"10.0.0.{i}" for i in range(2, 30)]), key=lambda r: r[1])
    late = [("10.0.0.1", T0 - timedelta(days=2))]  # below the watermark of the last batch: dropped
    path, frames = str(tmp_path / "in"), [rows[:90], rows[90:], late]
    for n, part in enumerate(frames):
        make_incidents([{"event_id": 1000 * n + i, "timestamp": at, "source_ip": s} for i, (s, at) in enumerate(part)]).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(make_incidents([{"event_id": 1, "timestamp": T0, "source_ip": "a"}]).schema).option("maxFilesPerTrigger", 1).parquet(path)
    table, _ = periods.run_periods(periods.stream_ip_periods(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted((r["source_ip"], r["period_start"], r["period_end"], r["incidents"]) for r in table.collect()) == expected(rows)
