from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from watchledger.operators import patterns

T0 = datetime(2024, 1, 1)


@pytest.fixture()
def events(make_incidents):
    rows, n = [], 0
    for ip, gap, types in [
        ("burst", 60, "ABABAB"), ("slow", 400, "ABABAB"), ("other", 10, "ABC"), ("short", 10, "AB"), ("single", 10, "A"), ("twin", 500, "ABC"),
    ]:
        for i, kind in enumerate(types):
            rows.append({"event_id": n, "timestamp": T0 + timedelta(seconds=i * gap), "source_ip": ip, "event_type": kind, "severity": "Low" if i % 2 else "High"})
            n += 1
    # Ties: two events at one instant are ordered by identifier.
    for i, kind in enumerate("CBA"):
        rows.append({"event_id": n + i, "timestamp": T0, "source_ip": "tied", "event_type": kind})
    return make_incidents(rows)


def whole(rows):
    text = {}
    for r in sorted(rows, key=lambda r: (r["source_ip"], r["segment"])):
        text.setdefault(r["source_ip"], []).append(r["sequence"])
    return {ip: patterns.ARROW.join(parts) for ip, parts in text.items()}


@pytest.mark.parametrize("size", [1, 2, 4, 4096])
def test_segments_join_to_the_whole_sequence(events, size):
    rows = patterns.ip_sequences(events, segment_size=size).collect()
    assert whole(rows) == {ip: patterns.ARROW.join(t) for ip, t in {
        "burst": "ABABAB", "slow": "ABABAB", "other": "ABC", "twin": "ABC", "tied": "CBA"}.items()}
    assert max(len(r["sequence"].split(patterns.ARROW)) for r in rows) <= size
    assert {r["source_ip"]: r["severity"] for r in rows}["burst"] == "High"


@pytest.mark.parametrize("size", [2, 4096])
def test_common_sequences(events, size):
    rows = patterns.common_sequences(events, segment_size=size).collect()
    found = {r["source_ip"]: (r["occurrences"], r["events"]) for r in rows}
    assert found == {"burst": (2, 6), "other": (2, 3), "tied": (1, 3)}
    spans = {r["source_ip"]: (r["first_span_hours"], r["avg_span_hours"]) for r in rows}
    assert spans["burst"] == pytest.approx((300 / 3600, (300 + 2000) / 2 / 3600))


def test_rapid_campaigns(events):
    assert [r["source_ip"] for r in patterns.rapid_campaigns(events).collect()] == ["burst"]
    wide = {r["source_ip"]: r["avg_gap_seconds"] for r in patterns.rapid_campaigns(events, max_gap_s=401).collect()}
    assert wide == {"burst": 60.0, "slow": 400.0}


def test_behavior_against_pandas(tables, incidents_pdf):
    got = patterns.ip_behavior(tables.prepared).toPandas().set_index("source_ip").sort_index()
    groups = incidents_pdf.groupby("source_ip")
    assert got["timing_variability"].to_dict() == pytest.approx(groups["hour"].std().to_dict())
    assert got["location_diversity"].to_dict() == groups["location"].nunique().to_dict()
    assert got["primary_severity"].to_dict() == groups["severity"].agg(lambda s: s.mode().iloc[0]).to_dict()


def test_clusters_cover_all_active_sources(tables):
    clustered = patterns.behavior_clusters(tables.prepared, restarts=2)
    assert clustered.count() == patterns.ip_behavior(tables.prepared).where(F.col("total_events") >= 3).count()
    assert 1 < clustered.select("behavior_cluster").distinct().count() <= 4


def test_too_few_sources_give_no_cluster(make_incidents):
    rows = [{"event_id": i, "timestamp": T0 + timedelta(hours=i), "source_ip": f"10.0.0.{i % 2}"} for i in range(8)]
    from watchledger.functions.cleaning import prepare_incidents

    clustered = patterns.behavior_clusters(prepare_incidents(make_incidents(rows)), restarts=1)
    assert [r["behavior_cluster"] for r in clustered.collect()] == [None, None]
