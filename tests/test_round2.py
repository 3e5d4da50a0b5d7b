"""Batch jobs, workspace, null and hot keys, and the forest's sample."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from watchledger import jobs as batch
from watchledger import workspace
from watchledger.operators import correlate, event_risk, forest, incident_sql, measures, patterns, quality, timeseries
from watchledger.sources import sinks


@pytest.fixture(scope="module")
def folders(spark, tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    for name, df in (("incidents.csv", tables.incidents), ("logins.csv", tables.logins)):
        df.write.option("header", True).option("timestampNTZFormat", sinks.CSV_TIMESTAMP).csv(str(root / "raw" / name))
    return root


def test_clean_and_score_jobs(spark, tables, folders):
    clean = batch.clean_job(spark, str(folders / "raw"), str(folders / "clean"))
    assert spark.read.parquet(clean["incidents_cleaned"]).count() == tables.incidents.count()
    merged = spark.read.parquet(clean["security_events_merged"])
    assert merged.count() == correlate.correlate(tables.incidents, tables.logins).count() and "combined_risk_score" in merged.columns
    scored = batch.score_job(spark, str(folders / "clean"), str(folders / "scored"), top=5)
    profile = spark.read.parquet(scored["risk_profiles"])
    assert profile.count() == tables.incidents.select("source_ip").distinct().count()
    top = spark.read.option("header", True).csv(scored["top_risk"] + "/top_risk_profiles")
    assert top.count() == 5 and "anomaly_score" in top.columns
    assert spark.read.parquet(scored["risk_summary"]).first()["total_ips_analyzed"] == profile.count()


def test_jobs_need_a_program_and_two_folders(capsys):
    assert batch.main([]) == 2 and "clean RAW OUT" in capsys.readouterr().out


def test_workspace_is_removed_by_its_owner(spark, tables):
    table = workspace.materialize(tables.logins, "probe")
    path = workspace.session_dir(spark)
    assert all(path in f for f in table.inputFiles())
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(place)
    workspace.release(spark)
    assert not files.exists(place)


def test_trees_draw_from_the_whole_table(spark):
    df = spark.range(100_000).select("id", F.rand(1).alias("x"))
    rows = forest.tree_samples(df, ["x"], ["id"])
    counts = rows.groupBy("tree").count().agg(F.min("count"), F.max("count"), F.count(F.lit(1))).first()
    assert tuple(counts) == (256, 256, 100)
    assert rows.select("id").distinct().count() > 20_000


def test_rows_and_combinations_score_alike(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(pd.DataFrame({"id": range(500), "x": rng.integers(0, 9, 500), "y": rng.integers(0, 9, 500)}))
    few = forest.isolation_forest(df, ["x", "y"], ["id"], 0.1, few_values=True).select("id", "iso_anomaly", "iso_score")
    every = forest.isolation_forest(df, ["x", "y"], ["id"], 0.1).select("id", "iso_anomaly", "iso_score")
    assert few.orderBy("id").collect() == every.orderBy("id").collect()


@pytest.fixture(scope="module")
def gaps(tables):
    """Incidents of which a third lack address, location or time."""
    third = lambda column, k: F.when(F.col("event_id") % 3 == k, F.lit(None)).otherwise(F.col(column)).alias(column)
    df = tables.incidents
    return workspace.materialize(df.select("event_id", third("timestamp", 0), "event_type", "severity", third("source_ip", 1), "destination_device", "status", third("location", 2)), "gaps")


def test_null_keys_stay_out_of_the_joins_and_in_the_result(tables, gaps):
    joined = correlate.correlate(gaps, tables.logins)
    assert joined.select("incident_event_id").distinct().count() == gaps.count()
    assert joined.where("(source_ip is null or incident_timestamp is null) and login_login_id is not null").count() == 0


def test_null_keys_of_look_ups_are_spread(spark, gaps):
    looked = correlate.map_lookup(gaps, gaps.groupBy("location").count(), "location")
    assert looked.count() == gaps.count() and looked.where("location is null and count is not null").count() == 0
    assert looked.where("location is not null and count is null").count() == 0
    off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = correlate.map_lookup(gaps, gaps.groupBy("location").count(), "location")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", off)
    assert "_salt" in plan.split("SortMergeJoin")[1].split("\n")[0]


def test_temporal_risk_with_missing_times(spark, gaps):
    scored = event_risk.event_temporal_risk(gaps.withColumn("severity_score", F.lit(2)))
    assert scored.count() == gaps.count() and scored.where("timestamp is null and rolling_incidents_24h is not null").count() == 0


def test_type_correlation_of_many_types(spark):
    rng = np.random.default_rng(2)
    rows = pd.DataFrame({"source_ip": rng.integers(0, 40, 12_000).astype(str), "event_type": [f"t{i}" for i in rng.integers(0, 200, 12_000)]})
    found = {(r["type_a"], r["type_b"]): r["r"] for r in measures.attack_type_correlation(spark.createDataFrame(rows)).collect()}
    table = rows.groupby(["source_ip", "event_type"]).size().unstack(fill_value=0)
    want = table.corr()
    assert len(found) > 30_000
    for (a, b), r in list(found.items())[:500]:
        assert r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_type_correlation_has_every_pair(spark):
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"source_ip": rng.integers(0, 300, 2_000).astype(str), "event_type": [f"t{i}" for i in np.append(np.arange(200), rng.integers(0, 200, 1_800))]})
    found = {(r["type_a"], r["type_b"]): r["r"] for r in measures.attack_type_correlation(spark.createDataFrame(rows)).collect()}
    want = rows.groupby(["source_ip", "event_type"]).size().unstack(fill_value=0).corr()
    assert len(found) == 40_000
    assert max(abs(r - want.loc[a, b]) for (a, b), r in found.items()) < 1e-9


def test_locations_only_of_reported_attackers(tables):
    plan = incident_sql.top_attackers(tables.incidents)
    assert plan.count() == min(20, tables.incidents.select("source_ip").distinct().count())


def test_each_source_lies_at_its_nearest_centre(tables):
    clustered = patterns.behavior_clusters(tables.prepared).toPandas().fillna(0)
    x = clustered[patterns.CLUSTER_FEATURES].to_numpy(dtype=float)
    spread = x.std(axis=0)
    x = (x - x.mean(axis=0)) / np.where(spread == 0, 1, spread)
    labels = clustered["behavior_cluster"].to_numpy()
    centres = {c: x[labels == c].mean(axis=0) for c in set(labels)}
    for point, label in zip(x, labels):
        assert min(centres, key=lambda c: ((point - centres[c]) ** 2).sum()) == label


def test_sketched_cardinality_is_close(tables):
    exact = {r["column"]: r["unique_values"] for r in quality.cardinality_profile(tables.raw_incidents).collect()}
    for r in quality.cardinality_profile(tables.raw_incidents, approximate=True).collect():
        assert r["unique_values"] == pytest.approx(exact[r["column"]], rel=0.1)


def test_calendar_window_over_missing_days(make_incidents):
    from datetime import datetime

    days = [1, 2, 9, 10]
    found = timeseries.moving_average_calendar(make_incidents([{"event_id": i, "timestamp": datetime(2024, 1, d), "source_ip": "a"} for i, d in enumerate(days * 2 + [1])]))
    assert [(r["date"].day, r["ma"]) for r in found.orderBy("date").collect()] == [(1, 3.0), (2, 2.5), (9, 2.0), (10, 2.0)]
