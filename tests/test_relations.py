"""Groups of related sources."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from watchledger.operators import relations

T0 = datetime(2024, 1, 1)


def groups_of(spark, links):
    df = spark.createDataFrame(links, "a string, b string")
    return {r["node"]: r["group"] for r in relations.connected_groups(df).collect()}


def test_small_graphs(spark):
    assert groups_of(spark, [("a", "b"), ("c", "b"), ("d", "e"), ("e", "d"), ("f", "f")]) == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}
    assert groups_of(spark, [("a", "a")]) == {}


def test_star(spark):
    links = spark.range(1, 100_001).select(F.format_string("s%06d", "id").alias("a"), F.lit("s000000").alias("b"))
    found = relations.connected_groups(links)
    assert (found.count(), found.select("group").distinct().collect()[0][0]) == (100_001, "s000000")


def test_chain(spark):
    links = spark.range(2000).select(F.format_string("s%05d", "id").alias("a"), F.format_string("s%05d", F.col("id") + 1).alias("b"))
    found = relations.connected_groups(links)
    assert (found.count(), found.select("group").distinct().count(), found.agg(F.min("group")).first()[0]) == (2001, 1, "s00000")


def test_random_graph_equals_search(spark):
    import random

    rng = random.Random(3)
    links = [(f"n{rng.randrange(300):03d}", f"n{rng.randrange(300):03d}") for _ in range(220)]
    around = {}
    for a, b in links:
        if a != b:
            around.setdefault(a, set()).add(b)
            around.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(around):
        waiting = [n] if n not in want else []
        while waiting:
            x = waiting.pop()
            if x not in want:
                want[x] = n
                waiting += around[x]
    assert groups_of(spark, links) == want


def test_sources_by_device_and_period(make_incidents):
    rows = [("10.0.0.1", "A", 0), ("10.0.0.2", "A", 5), ("10.0.0.2", "B", 70), ("10.0.0.3", "B", 90), ("10.0.0.4", "A", 70), ("10.0.0.5", "C", 0), (None, "C", 0)]
    df = make_incidents([{"event_id": i, "timestamp": T0 + timedelta(minutes=m), "source_ip": s, "destination_device": d} for i, (s, d, m) in enumerate(rows)])
    found = {r["source_ip"]: (r["group_id"][-1], r["group_size"]) for r in relations.source_groups(df, "hour").collect()}
    assert found == {"10.0.0.1": ("1", 3), "10.0.0.2": ("1", 3), "10.0.0.3": ("1", 3), "10.0.0.4": ("4", 1), "10.0.0.5": ("5", 1)}
    summary = relations.source_group_summary(df, "hour").collect()
    assert [(r["group_id"], r["incidents"], r["devices"]) for r in summary] == [("10.0.0.1", 4, 2)]


@pytest.mark.parametrize("grain", ["day"])
def test_no_incidents(make_incidents, grain):
    df = make_incidents([{"event_id": 1, "timestamp": T0, "source_ip": "10.0.0.1"}]).where("event_id > 1")
    assert relations.source_groups(df, grain).count() == 0
