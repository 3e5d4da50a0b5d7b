from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from watchledger.operators.ordering import exact_quantiles, label_encode, running_total, trailing_count


def skewed(n=3000, seed=1):
    """One key holds half of the rows."""
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.5, "hot", np.char.add("k", rng.integers(0, 20, n).astype(str)))
    return pd.DataFrame({"k": keys, "id": rng.permutation(n), "v": rng.integers(0, 50, n)})


def test_running_total_per_key(spark):
    pdf = skewed()
    got = running_total(spark.createDataFrame(pdf).repartition(7), ["id"], F.col("v"), by=["k"]).toPandas()
    want = pdf.sort_values("id")
    want["running"] = want.groupby("k")["v"].cumsum()
    merged = got.merge(want, on="id")
    assert len(merged) == len(pdf) and (merged["running_x"] == merged["running_y"]).all()


def test_running_total_spreads_a_hot_key(spark):
    """The hot key is cut into several slices; no task gets all of it."""
    pdf = pd.DataFrame({"k": "hot", "id": range(4000), "v": 1})
    df = spark.createDataFrame(pdf).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = df.repartitionByRange("k", "id").groupBy(F.spark_partition_id()).count()
        assert ranged.count() == 4 and ranged.agg(F.max("count")).first()[0] < 2000
        got = running_total(df, ["id"], F.col("v"), by=["k"])
        assert got.where(F.col("running") != F.col("id") + 1).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_running_total_without_key(spark):
    pdf = skewed()
    got = running_total(spark.createDataFrame(pdf), ["id"], F.lit(1)).toPandas().sort_values("id")
    assert list(got["running"]) == list(range(1, len(pdf) + 1))


@pytest.mark.parametrize("p", [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0])
def test_quantiles_equal_numpy(spark, p):
    pdf = skewed()
    got = exact_quantiles(spark.createDataFrame(pdf), "v", {"q": p}).first()[0]
    assert got == pytest.approx(np.percentile(pdf["v"], 100 * p))


def test_quantiles_per_key_and_weighted(spark):
    pdf = skewed(500)
    got = exact_quantiles(spark.createDataFrame(pdf), "v", {"q": 0.3}, by=["k"]).toPandas().set_index("k")["q"]
    want = pdf.groupby("k")["v"].quantile(0.3)
    assert got.sort_index().to_dict() == pytest.approx(want.sort_index().to_dict())
    weights = pdf.groupby("v").size().reset_index(name="w")
    assert exact_quantiles(spark.createDataFrame(weights), "v", {"q": 0.3}, weight="w").first()[0] == pytest.approx(pdf["v"].quantile(0.3))


def test_trailing_count_with_ties_and_edges(spark):
    base = datetime(2024, 1, 1)
    offsets = [0, 0, 1, 3600, 86399, 86400, 86400, 86401, 100000, 172800, 172800, 400000]
    stamps = [base + timedelta(seconds=s) for s in offsets] + [base + timedelta(seconds=86400, microseconds=1), None]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz")
    got = {r[0]: r[1] for r in trailing_count(df, "t").collect()}
    known = [s for s in stamps if s is not None]
    want = {t: sum(t - timedelta(hours=24) < u <= t for u in known) for t in known}
    assert got == want


def test_trailing_count_equals_pandas(tables, incidents_pdf):
    got = trailing_count(tables.prepared, "timestamp").toPandas().set_index("timestamp")["events"].sort_index()
    ordered = incidents_pdf.sort_values("timestamp")
    want = ordered.rolling("24h", on="timestamp")["event_id"].count()
    assert list(got) == list(want.astype(int))


def test_label_encode_is_sorted_and_null_safe(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c"), (5, "a")], "i int, v string")
    assert {r["i"]: r["code"] for r in label_encode(df, "v", "code").collect()} == {1: 1, 2: 0, 3: None, 4: 2, 5: 0}
