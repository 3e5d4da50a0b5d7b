import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from watchledger.functions.cleaning import prepare_incidents
from watchledger.functions.statistics import abs_zscore, histogram, minmax, round_even, safe_corr, standard_scale, t_test_p
from watchledger.operators import event_risk, measures, source_risk


@pytest.fixture(scope="module")
def profile(tables):
    return source_risk.ip_risk_profile(tables.incidents).toPandas()


def test_profile_is_complete_sorted_and_banded(tables, profile):
    assert len(profile) == tables.incidents.select("source_ip").distinct().count()
    scores = profile["ensemble_risk_score"]
    assert scores.is_monotonic_decreasing and scores.between(0, 100).all()
    expected = pd.cut(scores, [0, 30, 55, 80, math.inf], labels=["Low", "Medium", "High", "Critical"]).astype(object)
    assert [a if isinstance(a, str) else None for a in profile["final_risk_level"]] == [b if isinstance(b, str) else None for b in expected]
    assert set(profile["risk_trend"]) == {"Stable"}


def test_profile_ensemble_from_its_own_scores(profile):
    total = sum((profile[c] - profile[c].min()) / ((profile[c].max() - profile[c].min()) or 1) * w * 100 for c, w in source_risk.ENSEMBLE_WEIGHTS.items())
    assert np.allclose(total.round(2), profile["ensemble_risk_score"], atol=0.011)


def test_advanced_risk_against_pandas(tables, incidents_pdf):
    got = source_risk.ip_advanced_risk(tables.incidents).toPandas().set_index("source_ip").sort_index()
    g = incidents_pdf.groupby("source_ip")
    metrics = pd.DataFrame({
        "frequency": g["event_id"].count(), "avg_severity": g["severity_score"].mean(), "success_rate": g["status"].agg(lambda s: (s == "Successful").mean()),
        "event_diversity": g["event_type"].nunique(), "persistence_days": g["timestamp"].agg(lambda t: (t.max() - t.min()).days)}).round(3).sort_index()
    spread = (metrics - metrics.min()) / (metrics.max() - metrics.min()).replace(0, 1)
    want = sum(spread[c] * w * 100 for c, w in source_risk.ADVANCED_WEIGHTS.items()).round(2)
    assert got["advanced_risk_score"].to_dict() == pytest.approx(want.to_dict(), abs=0.0101)


def test_anomaly_alerts_and_summary(tables, profile, spark):
    summary = source_risk.risk_summary(spark.createDataFrame(profile)).first()
    assert summary["total_ips_analyzed"] == len(profile)
    assert summary["high_risk_ips"] == (profile["final_risk_level"] == "High").sum()
    assert measures.alert_critical_ips(spark.createDataFrame(profile), limit=50).count() == (profile["ensemble_risk_score"] > 50).sum()


def test_null_sources_are_left_out(make_incidents):
    from datetime import datetime

    df = make_incidents([{"event_id": i, "timestamp": datetime(2024, 1, 1, i), "source_ip": ip, "location": None} for i, ip in enumerate(["a", "a", None, "b"])])
    basic = {r["source_ip"]: r for r in source_risk.ip_basic_risk(df).collect()}
    assert set(basic) == {"a", "b"} and basic["a"]["active_days"] == 2 and basic["a"]["active_dates"] == 1
    geo = {r["source_ip"]: r["location_diversity"] for r in source_risk.ip_geo_risk(df).collect()}
    assert geo == {"a": 1, "b": 1}


def test_event_ensemble_bounds_and_null_location(tables):
    scored = event_risk.event_ensemble(tables.prepared).toPandas()
    known = scored[scored["location"].notna()]
    assert len(scored) == tables.incidents.count()
    assert scored.loc[scored["location"].isna(), "ensemble_risk_score"].isna().all()
    assert known["ensemble_risk_score"].between(0, 100).all()


def test_constant_columns_score_zero(make_incidents):
    from datetime import datetime

    df = prepare_incidents(make_incidents([{"event_id": i, "timestamp": datetime(2024, 1, 1), "source_ip": "a"} for i in range(3)]))
    assert [r["ensemble_risk_score"] for r in event_risk.event_ensemble(df, use_anomaly=False).collect()] == [0.0] * 3


def test_minmax_scale_and_z(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (None, 5.0)], "x double, c double")
    assert sorted((r[0] is None, r[0]) for r in minmax(df, ["x"]).select("x_norm").collect()) == [(False, 0.0), (False, 1 / 3), (False, 1.0), (True, None)]
    assert {r[0] for r in minmax(df, ["c"]).select("c_norm").collect()} == {0.0}
    assert {r[0] for r in standard_scale(df, ["c"]).select("c_z").collect()} == {0.0}
    z = [r[0] for r in abs_zscore(df.dropna(), ["x"]).orderBy("x").select("z_score_max").collect()]
    x = np.array([1, 2, 4.0])
    assert z == pytest.approx(list(np.abs((x - x.mean()) / x.std())))


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    counts = [r["count"] for r in histogram(df, "v", 5).orderBy("bin").collect()]
    assert counts == np.histogram(range(11), 5)[0].tolist()
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert sum(r["count"] for r in histogram(flat, "v", 3).collect()) == 2


def test_round_even_matches_numpy(spark):
    values = [0.0125, 2.5, 55 * 2.473, 1.005, -0.125, 1e9 + 0.005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(round_even(F.col("v"), 2)).collect()] == np.round(values, 2).tolist()


def test_constant_side_gives_null_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "x double, y double")
    assert df.agg(safe_corr(F.col("x"), F.col("y"))).first()[0] is None


# Critical values of Student's t: (degrees of freedom, t, two-sided p).
T_TABLE = [(1, 12.706, 0.05), (2, 4.303, 0.05), (3, 3.182, 0.05), (4, 2.776, 0.05), (5, 4.032, 0.01), (10, 2.228, 0.05), (28, 2.763, 0.01), (29, 2.045, 0.05), (120, 1.980, 0.05)]


def test_p_values_against_the_table(spark):
    rows = [(t / math.sqrt(t * t + nu), nu + 2, p) for nu, t, p in T_TABLE]
    df = spark.createDataFrame([(float(r), n, float(p)) for r, n, p in rows], "r double, n long, p double")
    for r in df.withColumn("got", t_test_p(F.col("r"), F.col("n"))).collect():
        assert r["got"] == pytest.approx(r["p"], rel=2e-3)


def test_p_value_limits(spark):
    df = spark.createDataFrame([(0.0, 10), (1.0, 10), (0.5, 2)], "r double, n long")
    assert [r[0] for r in df.select(t_test_p(F.col("r"), F.col("n"))).collect()] == [1.0, 0.0, None]
