"""Exploratory counts and headline metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.functions.cleaning import day_name, month_name, severity_score
from watchledger.operators.ordering import top_k
from watchledger.schemas import MONTHS, WEEKDAYS


def _n() -> Column:
    return F.count(F.lit(1))


def total_over_groups(column: str) -> Column:
    """Sum over all rows of an *aggregated* table with few groups; saves a second scan for the total."""
    return F.sum(column).over(Window.partitionBy())


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value, nulls left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(_n().alias("count"))


def severity_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "severity").orderBy(F.desc("count"), "severity")


def top_event_types(df: DataFrame, n: int = 10) -> DataFrame:
    return top_k(value_counts(df, "event_type"), n, F.desc("count"), F.col("event_type"))


def top_locations(df: DataFrame, n: int = 10) -> DataFrame:
    return top_k(value_counts(df, "location"), n, F.desc("count"), F.col("location"))


def login_success_counts(logins: DataFrame) -> DataFrame:
    return value_counts(logins, "success").withColumn("percent", F.try_divide(F.col("count") * 100.0, total_over_groups("count")))


def hourly_counts(df: DataFrame) -> DataFrame:
    return df.where("timestamp is not null").groupBy(F.hour("timestamp").alias("hour")).agg(_n().alias("incidents")).orderBy("hour")


def _calendar(df: DataFrame, names: list[str], key: str, counts: DataFrame) -> DataFrame:
    """Fixed-name rows in calendar order; absent names keep a null count."""
    frame = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(n) for n in names])).alias("position", key))
    return frame.join(F.broadcast(counts), key, "left").orderBy("position").select("position", key, "incidents")  # at most 12 rows


def weekday_counts(df: DataFrame) -> DataFrame:
    counts = df.groupBy(day_name(F.col("timestamp")).alias("day_of_week")).agg(_n().alias("incidents"))
    return _calendar(df, WEEKDAYS, "day_of_week", counts)


def month_pattern(df: DataFrame) -> DataFrame:
    counts = df.groupBy(month_name(F.col("timestamp")).alias("month_name")).agg(_n().alias("incidents"))
    return _calendar(df, MONTHS, "month_name", counts)


def key_metrics(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    """Headline numbers as one row; takes the raw severity and Yes/No outcome."""
    inc = incidents.agg(
        _n().alias("total_incidents"), F.count_if(F.col("severity") == "Critical").alias("critical_incidents"),
        F.count_if(F.col("severity") == "High").alias("high_incidents"), F.count_distinct("event_type").alias("unique_event_types"),
        F.count_distinct("source_ip").alias("unique_source_ips"), F.count_distinct("location").alias("unique_locations"),
        F.avg(severity_score(F.col("severity"))).alias("avg_severity_score"),
    )
    log = logins.agg(F.struct(
        _n().alias("total_login_attempts"), F.count_if(F.col("success") == "Yes").alias("successful_logins"),
        F.count_if(F.col("success") == "No").alias("failed_logins"), F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("ip_address").alias("unique_login_ips"),
    ).alias("s")).scalar()
    rate = lambda part, whole: F.try_divide(F.col(part) * 100.0, F.col(whole))
    return inc.withColumn("_log", log).select("*", "_log.*").drop("_log").withColumns({
        "login_success_rate": rate("successful_logins", "total_login_attempts"),
        "critical_incident_rate": rate("critical_incidents", "total_incidents"),
    })
