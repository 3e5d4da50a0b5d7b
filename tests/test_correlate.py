from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from watchledger.functions.cleaning import clean_incidents, clean_logins
from watchledger.operators import correlate as pairs
from watchledger.operators.correlate import correlate, correlate_features, incidents_logins_by_ip

T0 = datetime(2024, 1, 1, 12)


@pytest.fixture()
def edges(spark, make_incidents):
    """Logins exactly at the window ends and one microsecond beyond."""
    gaps = [-60 * 60, 60 * 60, 0]
    incidents = make_incidents([
        {"event_id": 1, "timestamp": T0, "source_ip": "10.0.0.1"},
        {"event_id": 2, "timestamp": T0, "source_ip": "10.0.0.2"},
        {"event_id": 3, "timestamp": T0, "source_ip": None},
    ])
    logins = [(i, "u", T0 + timedelta(seconds=g), "No", "10.0.0.1") for i, g in enumerate(gaps)]
    logins += [(10, "u", T0 + timedelta(seconds=3600, microseconds=1), "Yes", "10.0.0.1"), (11, "u", T0 - timedelta(seconds=3600, microseconds=1), "Yes", "10.0.0.1"),
               (12, "u", T0, "Yes", None)]
    return incidents, spark.createDataFrame(logins, "login_id long, user_id string, login_time timestamp_ntz, success string, ip_address string")


def test_window_ends_are_inclusive(edges):
    got = {(r["incident_event_id"], r["login_login_id"]) for r in correlate(*edges).collect()}
    assert got == {(1, 0), (1, 1), (1, 2), (2, None), (3, None)}


@pytest.mark.parametrize("hot_rows", [1, 3, 1_000_000])
def test_hot_slices_do_not_change_the_result(tables, hot_rows):
    """Slicing hot buckets gives the pairs of a plain range join."""
    incidents = tables.incidents.withColumn("source_ip", F.when(F.col("event_id") % 3 == 0, "10.9.9.9").otherwise(F.col("source_ip")))
    logins = tables.logins.withColumn("ip_address", F.when(F.col("login_id") % 2 == 0, "10.9.9.9").otherwise(F.col("ip_address")))
    got = correlate(incidents, logins, hot_rows=hot_rows).toPandas()
    inc, log = incidents.toPandas(), logins.toPandas()
    pairs = inc.merge(log, left_on="source_ip", right_on="ip_address")
    pairs = pairs[(pairs["login_time"] - pairs["timestamp"]).abs() <= timedelta(minutes=60)]
    matched = got.dropna(subset=["login_login_id"])
    assert set(zip(matched["incident_event_id"], matched["login_login_id"].astype(int))) == set(zip(pairs["event_id"], pairs["login_id"]))
    assert len(matched) == len(pairs)
    assert set(got["incident_event_id"]) == set(inc["event_id"])
    assert len(got) == len(pairs) + len(set(inc["event_id"]) - set(pairs["event_id"]))


def test_duplicates_collapse(edges):
    incidents, logins = edges
    assert correlate(incidents.unionAll(incidents), logins.unionAll(logins)).count() == 5


def test_features(edges):
    incidents, logins = edges
    rows = correlate_features(correlate(clean_incidents(incidents), clean_logins(logins))).collect()
    by_pair = {(r["incident_event_id"], r["login_login_id"]): r for r in rows}
    assert by_pair[(1, 0)]["combined_risk_score"] == 5.0 and by_pair[(2, None)]["combined_risk_score"] == 3.0
    assert by_pair[(1, 0)]["login_hour"] == 11 and by_pair[(2, None)]["login_is_business_hours"] is False


def test_semi_and_anti_split_the_incidents(tables):
    semi = incidents_logins_by_ip(tables.incidents, tables.logins, "semi").count()
    anti = incidents_logins_by_ip(tables.incidents, tables.logins, "anti").count()
    assert semi and anti and semi + anti == tables.incidents.count()


def test_published_tables_join_without_an_exchange(spark, tables):
    """The same rows as the plain join, incidents without address or time included, and no shuffle below the join."""
    incidents = tables.incidents.withColumn("source_ip", F.when(F.col("event_id") % 10 != 0, F.col("source_ip")))
    pairs.publish_pairs(incidents, tables.logins, "test_pairs", buckets=4)
    found = pairs.correlate_published(spark, "test_pairs")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = correlate(incidents, tables.logins)
    assert sorted(map(repr, found.select(*sorted(want.columns)).collect())) == sorted(map(repr, want.select(*sorted(want.columns)).collect()))
    for part in ("incidents", "logins", "nowhere"):
        spark.sql(f"DROP TABLE test_pairs_{part}")
