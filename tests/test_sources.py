import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from watchledger.functions.cleaning import clean_incidents, clean_logins
from watchledger.operators import quality
from watchledger.operators.correlate import correlate
from watchledger.schemas import CONSTRAINTS, INCIDENTS, LOGINS, table_schemas
from watchledger.sources import readers, sinks
from watchledger.streaming import jobs
from watchledger.workspace import materialize, shared_dir


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_round_trip(spark, tables, tmp_path):
    path = sinks.export_cleaned(tables.incidents, str(tmp_path), "incidents")
    back = readers.read_incidents(spark, path)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, clean_incidents(tables.incidents).select(*back.columns).collect()))


def test_columns_in_any_order_and_extra_columns(spark, tmp_path):
    path = write(tmp_path / "l.csv", "user_id,login_id,extra,login_time,ip_address,success\nu1,7,x,2024-01-02 03:04:05,10.0.0.1,yes\n")
    row = readers.read_logins(spark, path).first()
    assert (row["login_id"], row["user_id"], row["success"], row["hour"]) == (7, "u1", True, 3)


def test_missing_columns_raise(spark, tmp_path, tables):
    path = write(tmp_path / "l.csv", "login_id,user_id\n1,u\n")
    with pytest.raises(ValueError, match="login_time"):
        readers.read_logins(spark, path)
    with pytest.raises(ValueError, match="nothing"):
        readers.require_columns(tables.incidents, ["event_id", "nothing"])
    assert readers.require_columns(tables.incidents, INCIDENTS.names) is tables.incidents


def test_malformed_lines_are_kept(spark, tmp_path):
    path = write(tmp_path / "l.csv", "login_id,user_id,login_time,success,ip_address\n1,u,2024-01-02 03:04:05,Yes,1.1.1.1\nx,u,not-a-date,Yes,1.1.1.1\n")
    assert readers.read_logins(spark, path).count() == 2
    assert [r[readers.CORRUPT] for r in readers.malformed_lines(spark, path, LOGINS, "logins").collect()] == ["x,u,not-a-date,Yes,1.1.1.1"]


def test_exports(spark, tables, tmp_path):
    inc, log = clean_incidents(tables.incidents), clean_logins(tables.logins)
    paths = sinks.export_for_dashboard(str(tmp_path), inc, log, correlate(inc, log), fmt="parquet")
    assert spark.read.parquet(paths["incidents_cleaned"]).count() == inc.count()
    dated = sinks.export_cleaned(inc, str(tmp_path), "dated", fmt="parquet", date_column="timestamp")
    assert spark.read.parquet(dated).select("day").distinct().count() == inc.select(F.to_date("timestamp")).distinct().count()


def test_schemas_and_dtypes(tables):
    assert {k: [f.name for f in v] for k, v in table_schemas().items()} == {"incidents": tables.incidents.columns, "logins": tables.logins.columns}
    types = {r["column"]: r["dtype"] for r in quality.dtype_profile(tables.incidents).collect()}
    assert types["event_id"] == "bigint" and types["timestamp"] == "timestamp_ntz"


def test_violations_on_dirty_input(spark, tables):
    rows = {(r["table"], r["column"], r["rule"]): r["violations"] for r in quality.rule_violations({"incidents": tables.raw_incidents, "logins": tables.logins}, CONSTRAINTS).collect()}
    raw = tables.raw_incidents.toPandas()
    assert rows[("incidents", "event_id", "unique")] == raw["event_id"].duplicated(keep=False).sum()
    assert rows[("incidents", "source_ip", "not_null")] == raw["source_ip"].isna().sum()
    assert rows[("logins", "login_id", "unique")] == 0


def test_empty_tables(tables):
    empty = tables.incidents.where("false")
    assert quality.missing_profile(empty).where("missing_percent is not null").count() == 0
    assert quality.duplicate_count(empty).first()["rows"] == 0
    assert correlate(empty, tables.logins).count() == 0


def test_materialized_tables_live_in_the_shared_folder(spark, tables):
    table = materialize(tables.logins, "probe")
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints")
    assert all("watchledger/" in f for f in table.inputFiles()) and table.count() == tables.logins.count()


def batches(spark, df, path, ts, n=4):
    """The table as ``n`` files in time order, one micro-batch each."""
    bounds = [r[1] for r in df.select(F.ntile(n).over(Window.orderBy(ts)).alias("b"), ts).groupBy("b").agg(F.max(ts)).orderBy("b").collect()]
    last = None
    for bound in bounds:
        part = df.where(F.col(ts) <= bound)
        (part if last is None else part.where(F.col(ts) > last)).coalesce(1).write.mode("append").parquet(path)
        last = bound
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(path)


def test_update_mode_over_several_batches(spark, tables, tmp_path):
    stream = batches(spark, tables.incidents, str(tmp_path / "in"), "timestamp")
    got = {r["source_ip"]: r["incidents"] for r in jobs.drain_updates(jobs.stream_ip_profile(stream), "source_ip", "p").collect()}
    assert got == {r["source_ip"]: r["count"] for r in tables.incidents.groupBy("source_ip").count().collect()}


def test_counts_over_several_batches(spark, tables, tmp_path):
    stream = batches(spark, tables.incidents, str(tmp_path / "in"), "timestamp")
    got = jobs.drain(jobs.stream_incident_counts(stream), "c").toPandas()
    batch = tables.incidents.groupBy(F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("window_start"), "severity").count().toPandas()
    merged = got.merge(batch, on=["window_start", "severity"], how="left")
    assert len(got) > 0.9 * len(batch) and (merged["incidents"] == merged["count"]).all()


def test_late_events_are_dropped(spark, make_incidents, tmp_path):
    from datetime import datetime, timedelta

    t0, path = datetime(2024, 1, 1), str(tmp_path / "in")
    row = lambda i, hours: {"event_id": i, "timestamp": t0 + timedelta(hours=hours), "source_ip": "a"}
    # The late filter trails the watermark by one batch, so the late event comes two batches after.
    for part in ([row(1, 0.5), row(2, 5)], [row(4, 9)], [row(3, 0.6)], [row(5, 20)]):
        make_incidents(part).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(make_incidents([row(1, 0)]).schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = {r["window_start"].hour: r["incidents"] for r in jobs.drain(jobs.stream_incident_counts(stream), "late").collect()}
    assert got == {0: 1, 5: 1, 9: 1}
