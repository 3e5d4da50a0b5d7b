import ipaddress
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from watchledger.functions import cleaning

ADDRESSES = [
    "192.168.1.1", "0.0.0.0", "255.255.255.255", "256.1.1.1", "01.2.3.4", "1.2.3", "1.2.3.4.5", " 10.0.0.1 ", "10.0.0.1x", "10.0.0.1/24",
    "10 .0.0.1", "abc", "", "...", "1..2.3", "::", "::1", "fe80::1", "fe80::1%eth0", "fe80::1%", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9",
    "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::2::3", ":::", "1:2:3:4:5:6:7:8::", "::ffff:10.0.0.1", "::ffff:10.0.0.256", "1:2:3:4:5:6:1.2.3.4",
    "12345::1", "g::1", "2001:DB8::A", "\t8.8.8.8\n", "8.8.8.8,", "999.1.1.1", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "::1.2.3", None,
]


def expected_ip(text):
    if text is None:
        return None
    text = text.strip()
    for candidate in (text, re.sub(r"[^\d.]", "", text)):
        try:
            ipaddress.ip_address(candidate)
            return candidate
        except ValueError:
            continue
    return None


def apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", fn(F.col("v"))).orderBy("i").collect()]


def test_clean_ip_matches_the_standard_library(spark):
    got = apply(spark, ADDRESSES, cleaning.clean_ip)
    assert dict(zip(ADDRESSES, got)) == {a: expected_ip(a) for a in ADDRESSES}


def test_title_case_matches_python(spark):
    words = ["north korea", "NORTH-KOREA", "o'brien 2x", "  low ", "a", "", "CRITICAL?", "côte d'ivoire", None]
    assert apply(spark, words, cleaning.title_case) == [w.title() if w is not None else None for w in words]


def test_canonical_severity_keeps_unknown_values(spark):
    assert apply(spark, ["low", "CRITICAL", "High?", " low", None], cleaning.canon_severity) == ["Low", "Critical", "High?", " low", None]


def test_scores_differ_only_on_unknown(spark):
    values = ["Low", "Medium", "High", "Critical", "low", None]
    assert apply(spark, values, cleaning.severity_score) == [1, 2, 3, 4, None, None]
    assert apply(spark, values, cleaning.severity_score_sql) == [1, 2, 3, 4, 0, 0]


def test_login_success(spark):
    assert apply(spark, ["Yes", "yes", "No", "no", "YES", None], cleaning.login_success_bool) == [True, True, False, False, None, None]


def test_band_edges(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([-1.0, 0.0, 0.01, 5.0, 5.01, 30.0, 30.01, None])], "i int, v double")
    labels = ["Low", "Medium", "High", "Critical"]
    right = [r[0] for r in df.orderBy("i").select(cleaning.band(F.col("v"), [0, 5, 15, 30, float("inf")], labels)).collect()]
    assert right == [None, None, "Low", "Low", "Medium", "High", "Critical", None]
    left = [r[0] for r in df.orderBy("i").select(cleaning.band_ge(F.col("v"), [30, 5], ["High", "Medium"], "Low")).collect()]
    assert left == ["Low", "Low", "Low", "Medium", "Medium", "High", "High", "Low"]


def test_band_open_below(spark):
    df = spark.createDataFrame([(-5.0,), (0.5,), (0.6,), (2.0,)], "v double")
    got = [r[0] for r in df.select(cleaning.band(F.col("v"), [float("-inf"), 0.5, 1.0, float("inf")], ["a", "b", "c"])).collect()]
    assert got == ["a", "a", "b", "c"]


@pytest.mark.parametrize("year", [1999, 2000, 2023, 2024, 2028])
def test_monday_week_over_year_boundaries(spark, year):
    days = [datetime(year, 12, 20) + timedelta(days=i) for i in range(30)]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
    got = [r[0] for r in df.orderBy("d").select(cleaning.monday_week(F.col("d"))).collect()]
    assert got == [d.strftime("%Y-%W") for d in days]


def test_business_hours(spark):
    stamps = [datetime(2024, 1, 5, 8, 59), datetime(2024, 1, 5, 9), datetime(2024, 1, 5, 17, 59), datetime(2024, 1, 5, 18), datetime(2024, 1, 6, 12)]
    df = spark.createDataFrame([(d,) for d in stamps], "d timestamp_ntz").orderBy("d")
    assert [r[0] for r in df.select(cleaning.is_business_hours(F.col("d"))).collect()] == [False, True, True, False, True]
    assert [r[0] for r in df.select(cleaning.is_business_hours_weekday(F.col("d"))).collect()] == [False, True, True, False, False]


def test_eda_cleaning_drops_duplicates_and_bad_dates(tables):
    raw = tables.raw_incidents
    cleaned = cleaning.clean_incidents_eda(raw).toPandas()
    assert len(cleaned) == raw.distinct().count()
    assert cleaned["timestamp"].isna().sum() == (cleaned["event_id"] % 97 == 0).sum()
