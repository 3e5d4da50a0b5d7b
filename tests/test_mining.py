"""Frequent sequences, clusters, boosted trees and login shifts on planted cases."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from watchledger.functions.cleaning import prepare_incidents
from watchledger.operators import patterns, shifts, trees

T0 = datetime(2024, 1, 1)
TYPES = ["Malware", "Port Scan", "Failed Login"]


def counted(rows, share, most, gap_hours=None):
    """Sources and occurrences of every stretch of events, one by one."""
    of = defaultdict(list)
    for i, (source, at, kind) in enumerate(rows):
        of[source].append((at, i, kind))
    sources, times = defaultdict(set), defaultdict(int)
    for source, events in of.items():
        events.sort()
        for a in range(len(events)):
            for b in range(a, min(a + most, len(events))):
                if b > a and gap_hours is not None and events[b][0] - events[b - 1][0] > timedelta(hours=gap_hours):
                    break
                key = tuple(e[2] for e in events[a : b + 1])
                sources[key].add(source)
                times[key] += 1
    least = max(1, -(-len(of) * share // 1))
    listed = {k: (len(s), times[k]) for k, s in sources.items() if len(s) >= least}
    longer = lambda k: max((listed[o][0] for o in listed if len(o) == len(k) + 1 and k in (o[1:], o[:-1])), default=0)
    return {" → ".join(k): (len(k), *v, longer(k) < v[0]) for k, v in listed.items()}


@pytest.mark.parametrize("gap", [None, 5])
def test_frequent_sequences_equal_counting(make_incidents, gap):
    rng = random.Random(4)
    rows = [(f"10.0.0.{rng.randrange(12)}", T0 + timedelta(hours=rng.randrange(200)), rng.choice(TYPES)) for _ in range(300)]
    rows += [("10.0.0.99", T0 + timedelta(hours=h), TYPES[h % 2]) for h in range(300)]  # half of all rows
    df = make_incidents([{"event_id": i, "timestamp": at, "source_ip": s, "event_type": k} for i, (s, at, k) in enumerate(rows)])
    found = {r["sequence"]: (r["length"], r["sources"], r["occurrences"], r["closed"]) for r in patterns.frequent_sequences(df, 0.3, 6, gap).collect()}
    assert found == counted(rows, 0.3, 6, gap)


def test_sequences_end_by_themselves(make_incidents):
    rows = [{"event_id": 10 * s + i, "timestamp": T0 + timedelta(hours=i), "source_ip": f"10.0.0.{s}", "event_type": TYPES[i % 3]} for s in range(3) for i in range(7)]
    found = patterns.frequent_sequences(make_incidents(rows), 1.0)
    assert found.agg(F.max("length")).first()[0] == 7
    assert [r["length"] for r in found.where("closed").collect()] == [7]
    assert patterns.frequent_sequences(make_incidents(rows[:1]).where("event_id > 5")).collect() == []


def test_clusters_find_planted_groups(make_incidents):
    rows, n = [], 0
    for s in range(40):
        kind = s % 4
        for i in range((3, 12, 30, 60)[kind]):
            rows.append({"event_id": (n := n + 1), "timestamp": T0 + timedelta(hours=i * (1, 10, 2, 0.1)[kind]), "source_ip": f"10.0.{kind}.{s}", "event_type": TYPES[i % (1 + kind % 3)], "location": f"L{i % (1 + 3 * kind)}"})
    found = patterns.behavior_clusters(prepare_incidents(make_incidents(rows))).collect()
    labels = defaultdict(set)
    for r in found:
        labels[r["source_ip"].split(".")[2]].add(r["behavior_cluster"])
    assert all(len(x) == 1 for x in labels.values()) and len(set.union(*labels.values())) == 4


def test_trees_see_what_a_line_cannot(make_incidents):
    """A source has many incidents if the week before was either all successful or of two types, but not both."""
    rng, rows = random.Random(2), []
    for s in range(150):
        n = 4
        for week in range(5):
            wins, kinds = rng.randrange(2), 1 + rng.randrange(2)
            for i in range(n):
                rows.append({"event_id": len(rows), "timestamp": T0 + timedelta(days=7 * week, minutes=i), "source_ip": f"10.0.1.{s}", "severity": "Low",
                             "status": "Successful" if wins else "Failed", "event_type": TYPES[i % kinds]})
            n = 12 if wins != (kinds == 2) else 2
    errors = {r["model"]: r["mean_absolute_error"] for r in trees.risk_model_errors(prepare_incidents(make_incidents(rows)), rounds=15, depth=3, bins=8, shrink=2).collect()}
    assert errors["trees"] < 0.3 * errors["linear"]


def test_tree_cuts_equal_trying_all():
    rng = random.Random(6)
    rows = [(rng.randrange(4), rng.randrange(4), rng.randrange(-50, 50)) for _ in range(60)]
    cells = defaultdict(lambda: [0, 0])
    for a, b, y in rows:
        for f, x in enumerate((a, b)):
            cells[0, f, x][0] += 1
            cells[0, f, x][1] += y
    (cut,), sides = trees._best_cuts([(*k, *v) for k, v in cells.items()], 1, 2, 4)
    spread = lambda part: sum(part) ** 2 / len(part) if part else 0
    tried = {(f, c): spread([r[2] for r in rows if r[f] <= c]) + spread([r[2] for r in rows if r[f] > c]) for f in range(2) for c in range(3)}
    assert cut == max(tried, key=lambda k: (tried[k], -k[0], -k[1]))
    assert sides == [(len(p), sum(p)) for p in ([r[2] for r in rows if r[cut[0]] <= cut[1]], [r[2] for r in rows if r[cut[0]] > cut[1]])]


def login_rows(spark, per_day):
    rows = [(f"{u}-{d}-{i}", u, T0 + timedelta(days=d, minutes=i), "No" if i % 2 else "Yes", "10.0.0.1") for u, counts in per_day.items() for d, n in enumerate(counts) for i in range(n)]
    return spark.createDataFrame(rows, "login_id string, user_id string, login_time timestamp_ntz, success string, ip_address string")


def test_planted_shift_is_found_and_steady_user_is_not(spark):
    rng = random.Random(1)
    steady = [200 + rng.randrange(-40, 41) for _ in range(30)]
    per_day = {"heavy": steady, "risen": [3] * 14 + [14] * 5 + [3] * 11, "gone": [20] * 15 + [0] * 15, "rare": [1] + [0] * 28 + [1]}
    found = {(r["user_id"], r["direction"]): r for r in shifts.login_shifts(login_rows(spark, per_day)).collect()}
    assert set(found) == {("risen", "more"), ("gone", "fewer")} | {k for k in found if k == ("risen", "fewer")}
    up = found["risen", "more"]
    assert (up["first_day"] - T0.date()).days == 14 and up["level_before"] == 3.0 and up["level_during"] == 14.0 and up["excess"] > 8
    assert (found["gone", "fewer"]["first_day"] - T0.date()).days == 15 and found["gone", "fewer"]["level_during"] < 10


def test_shifts_equal_sums_carried_from_day_to_day(spark):
    rng = random.Random(8)
    per_day = {f"u{k}": [rng.randrange(0, rng.choice([2, 5, 9])) + 1 for _ in range(40)] for k in range(15)}
    want = set()
    for user, x in per_day.items():
        for name, sign in (("more", 1), ("fewer", -1)):
            s, first, top = 0, None, 0
            for i in range(7, len(x)):
                level = sum(x[i - 7 : i]) * 1000 // 7
                s = max(0, s + sign * (x[i] * 1000 - level) - level // 2 - 1000)
                first, top = (None, 0) if s == 0 else (i if first is None else first, max(top, s))
                if top > 2000:
                    want.add((user, name, first))
    found = {(r["user_id"], r["direction"], (r["first_day"] - T0.date()).days) for r in shifts.login_shifts(login_rows(spark, per_day), limit=2.0).collect()}
    assert found == want
