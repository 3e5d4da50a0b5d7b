"""The incident report suite: trends, attack types, severities, attackers, devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.functions.cleaning import band_ge, monday_week, severity_score_sql
from watchledger.operators.explore import total_over_groups
from watchledger.operators.ordering import top_k
from watchledger.schemas import SEVERITIES
from watchledger.workspace import materialize


def _n() -> Column:
    return F.count(F.lit(1))


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), 3)


def _score() -> Column:
    return severity_score_sql(F.col("severity"))


def _successes() -> Column:
    return F.count_if(F.col("status") == "Successful")


def security_events(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    """Both tables as one event list, padded with nulls."""
    failed = F.col("success") == "No"
    left = incidents.select(
        F.lit("incident").alias("event_category"), "event_id", "timestamp", "event_type", "severity", "source_ip",
        "destination_device", "status", "location",
    )
    right = logins.select(
        F.lit("login").alias("event_category"), F.col("login_id").alias("event_id"), F.col("login_time").alias("timestamp"),
        F.when(failed, "Failed Login").otherwise("Successful Login").alias("event_type"),
        F.when(failed, "Medium").otherwise("Low").alias("severity"), F.col("ip_address").alias("source_ip"),
        F.col("success").alias("status"), "user_id", F.col("success").alias("login_success"),
    )
    return left.unionByName(right, allowMissingColumns=True)


def daily_trend(df: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("severity") == s).alias(f"{s.lower()}_count") for s in ("Critical", "High", "Medium", "Low")]
    return df.groupBy(F.to_date("timestamp").alias("incident_date")).agg(_n().alias("total_incidents"), *counts).orderBy("incident_date")


def hourly_pattern(df: DataFrame) -> DataFrame:
    hour = F.date_format("timestamp", "HH").alias("hour_of_day")
    return df.groupBy(hour).agg(_n().alias("incident_count"), F.avg(_score()).alias("avg_severity_score")).orderBy("hour_of_day")


def weekly_trend(df: DataFrame) -> DataFrame:
    return df.groupBy(monday_week(F.col("timestamp")).alias("week")).agg(
        _n().alias("weekly_incidents"), F.count_distinct("source_ip").alias("unique_attackers"),
        F.avg(_score()).alias("avg_severity"),
    ).orderBy("week")


def event_type_success(df: DataFrame) -> DataFrame:
    return df.groupBy("event_type").agg(
        _n().alias("total_events"), _successes().alias("successful_attempts"),
        _share(_successes(), _n()).alias("success_rate"), F.avg(_score()).alias("avg_severity"),
    ).orderBy(F.desc("total_events"), "event_type")


def event_type_daily(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("timestamp").alias("date"), "event_type").agg(
        _n().alias("daily_count"), _successes().alias("successful_count"),
    ).orderBy("date", "event_type")


def severity_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("severity").agg(
        _n().alias("count"), F.count_distinct("source_ip").alias("unique_ips"),
        F.count_distinct("location").alias("unique_locations"),
    ).select("severity", "count", _share(F.col("count"), total_over_groups("count")).alias("percentage"), "unique_ips", "unique_locations").orderBy(
        F.desc(_score()), "severity")


def severity_by_event_type(df: DataFrame) -> DataFrame:
    """The window runs over one row per (type, severity)."""
    counts = df.groupBy("event_type", "severity").agg(_n().alias("count"))
    of_type = F.sum("count").over(Window.partitionBy("event_type"))
    return counts.withColumn("severity_percentage", _share(F.col("count"), of_type)).orderBy("event_type", F.desc(_score()), "severity")


def top_attackers(df: DataFrame, n: int = 20) -> DataFrame:
    """Rows shrink to (source, type, location) cells before the per-source roll-up."""
    cells = df.groupBy("source_ip", "event_type", "location").agg(
        _n().alias("rows"), F.max("severity").alias("max_severity"), F.max(_score()).alias("max_score"),
        _successes().alias("ok"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
    )
    by_ip = cells.groupBy("source_ip").agg(
        F.sum("rows").alias("total_incidents"), F.count_distinct("event_type").alias("unique_event_types"),
        F.max("max_severity").alias("max_severity"), F.max("max_score").alias("max_score"),
        F.sum("ok").alias("successful_attacks"),
        F.min("first").alias("first_seen"), F.max("last").alias("last_seen"),
    )
    ranked = F.element_at(F.array(F.lit("Unknown"), *[F.lit(s) for s in SEVERITIES]), F.col("max_score") + 1)
    report = by_ip.select(
        "source_ip", "total_incidents", "unique_event_types", "max_severity", ranked.alias("max_severity_ranked"),
        "successful_attacks", _share(F.col("successful_attacks"), F.col("total_incidents")).alias("success_rate"), "first_seen", "last_seen",
    )
    best = materialize(top_k(report, n, F.desc("total_incidents"), F.asc_nulls_last("source_ip")), "top-attackers")
    # Only the reported sources gather their locations.
    mine = cells.join(F.broadcast(best.select(F.col("source_ip").alias("_ip"))), F.col("source_ip").eqNullSafe(F.col("_ip")))  # n rows
    places = mine.groupBy("_ip").agg(F.array_join(F.array_sort(F.collect_set("location")), ",").alias("locations"))
    joined = best.join(places, best["source_ip"].eqNullSafe(places["_ip"]), "left").drop("_ip")
    return joined.select(*[c for c in best.columns if c not in ("first_seen", "last_seen")], F.coalesce("locations", F.lit("")).alias("locations"), "first_seen", "last_seen").orderBy(
        F.desc("total_incidents"), F.asc_nulls_last("source_ip"))


def persistent_attackers(df: DataFrame, n: int = 15) -> DataFrame:
    days = df.groupBy("source_ip", F.to_date("timestamp").alias("day")).agg(_n().alias("rows"), F.sum(_score()).alias("score"))
    by_ip = days.groupBy("source_ip").agg(
        F.count("day").alias("active_days"), F.sum("rows").alias("total_incidents"),
        F.try_divide(F.sum("score").cast("double"), F.sum("rows").cast("double")).alias("avg_severity"),
    ).where("active_days > 1")
    return top_k(by_ip, n, F.desc("active_days"), F.desc("total_incidents"), F.asc_nulls_last("source_ip"))


def sql_risk_score(df: DataFrame, n: int = 25) -> DataFrame:
    """Frequency times mean severity with inclusive bands."""
    cells = df.groupBy("source_ip", "event_type", F.to_date("timestamp").alias("day")).agg(
        _n().alias("rows"), F.sum(_score()).alias("score"), F.max("timestamp").alias("last"),
    )
    by_ip = cells.groupBy("source_ip").agg(
        F.sum("rows").alias("incident_frequency"), F.sum("score").alias("score"),
        F.count_distinct("event_type").alias("event_type_diversity"), F.count_distinct("day").alias("persistence_days"),
        F.max("last").alias("last_incident"),
    )
    weight = F.col("score").cast("double") / F.col("incident_frequency")
    scored = by_ip.withColumns({
        "severity_weight": F.round(weight, 2), "risk_score": F.round(F.col("incident_frequency") * weight, 2),
    }).withColumn("risk_level", band_ge(F.col("risk_score"), [50, 25, 10], ["Critical", "High", "Medium"], "Low"))
    report = scored.select("source_ip", "incident_frequency", "severity_weight", "risk_score", "event_type_diversity",
                           "persistence_days", "risk_level", "last_incident")
    return top_k(report, n, F.desc("risk_score"), F.asc_nulls_last("source_ip"))


def geo_risk_summary(df: DataFrame) -> DataFrame:
    known = df.where(F.col("location").isNotNull() & (F.col("location") != "Unknown"))
    return known.groupBy("location").agg(
        _n().alias("total_incidents"), F.count_distinct("source_ip").alias("unique_attackers"),
        F.avg(_score()).alias("avg_severity"), _successes().alias("successful_attacks"),
        _share(_successes(), _n()).alias("success_rate"),
    ).orderBy(F.desc("total_incidents"), "location")


def ip_incident_login_correlation(incidents: DataFrame, logins: DataFrame, n: int = 20) -> DataFrame:
    """Each side is aggregated per address first; joining rows would multiply them."""
    left = incidents.groupBy("source_ip").agg(
        F.count_distinct("event_id").alias("security_incidents"),
        F.count_distinct(F.to_date("timestamp")).alias("incident_days"),
    )
    failed = F.col("success") == "No"
    right = logins.groupBy("ip_address").agg(
        F.count_distinct(F.when(failed, F.col("login_id"))).alias("failed_logins"),
        F.count_distinct(F.when(failed, F.to_date("login_time"))).alias("failed_login_days"),
    )
    both = left.join(right, left.source_ip.eqNullSafe(right.ip_address), "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    report = both.select(
        F.coalesce("source_ip", "ip_address").alias("ip_address"), zero("failed_logins"), zero("security_incidents"),
        zero("failed_login_days"), zero("incident_days"),
    ).where("failed_logins > 0 or security_incidents > 0")
    return top_k(report, n, F.desc("failed_logins"), F.desc("security_incidents"), F.asc_nulls_last("ip_address"))


def device_targeting(df: DataFrame) -> DataFrame:
    cells = df.groupBy("destination_device", "source_ip", "event_type", "severity").agg(
        _n().alias("rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    return cells.groupBy("destination_device").agg(
        F.sum("rows").alias("total_incidents"), F.count_distinct("source_ip").alias("unique_attackers"),
        F.count_distinct("event_type").alias("unique_event_types"),
        F.array_join(F.array_sort(F.collect_set("severity")), ",").alias("severities_seen"),
        F.min("first").alias("first_attack"), F.max("last").alias("last_attack"),
    ).orderBy(F.desc("total_incidents"), "destination_device")


def filter_critical(df: DataFrame) -> DataFrame:
    return df.where(F.col("severity") == "Critical")
