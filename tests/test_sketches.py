"""Sketch tables: errors, plans, days added later."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from watchledger.operators import sketches

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def busy(spark):
    """Ten days, 300,000 rows, 60,000 different sources."""
    return spark.range(300_000).select(
        (F.lit(T0) + F.make_dt_interval(F.col("id") % 10)).cast("timestamp_ntz").alias("at"), F.concat(F.lit("s"), F.pmod(F.xxhash64("id"), F.lit(60_000))).alias("source"),
        F.when(F.col("id") % 7 != 0, F.pmod(F.xxhash64(F.col("id") + 1), F.lit(1000)) / 10).alias("value"), F.lit(None).cast("string").alias("nothing"))


def test_seven_days_within_the_stated_error(spark, busy, tmp_path):
    path = str(tmp_path / "s")
    sketches.publish_sketches(busy, path, "at", ["source", "nothing"], ["value"])
    table = sketches.read_sketches(spark, path)
    span = {r["column"]: r for r in sketches.span_profile(table, date(2024, 1, 2), date(2024, 1, 8), [0.5, 0.95]).collect()}
    week = busy.where("at >= '2024-01-02' and at < '2024-01-09'")
    assert span["source"]["distinct_values"] == pytest.approx(week.select("source").distinct().count(), rel=3 * 0.0065)
    assert (span["nothing"]["distinct_values"], span["nothing"]["present"], span["source"]["q50"]) == (0, 0, None)
    for q, p in (("q50", 0.5), ("q95", 0.95)):
        assert week.where(F.col("value") <= span["value"][q]).count() / week.where("value is not null").count() == pytest.approx(p, abs=0.015)
    rolling = {(r["until"].day, r["column"]): r for r in sketches.rolling_profile(table).collect()}
    assert len(rolling) == 30
    assert rolling[8, "source"]["distinct_values"] == span["source"]["distinct_values"] and rolling[1, "source"]["rows"] == 30_000


def test_reports_read_the_sketches_only(spark, busy, tmp_path):
    path = str(tmp_path / "s")
    sketches.publish_sketches(busy, path, "at", ["source"])
    plan = sketches.span_profile(sketches.read_sketches(spark, path), date(2024, 1, 3))._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(day" in plan


def test_later_days_leave_earlier_ones_alone(spark, busy, tmp_path):
    path = str(tmp_path / "s")
    sketches.publish_sketches(busy.where("at < '2024-01-06'"), path, "at", ["source"])
    earlier = lambda: {f for f in sketches.read_sketches(spark, path).inputFiles() if "day=2024-01-05" > f.split("/")[-2]}
    files = earlier()
    sketches.publish_sketches(busy, path, "at", ["source"], since=date(2024, 1, 5))
    again = sketches.read_sketches(spark, path)
    assert len(files) == 4 and files == earlier()
    assert again.agg(F.sum("rows")).first()[0] == 300_000 and again.select("day").distinct().count() == 10
