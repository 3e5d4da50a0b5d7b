"""Location statistics; operators take prepared incidents (severity_score)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.functions.statistics import minmax
from watchledger.operators.explore import top_locations, value_counts
from watchledger.operators.ordering import exact_quantiles
from watchledger.schemas import SEVERITIES
from watchledger.workspace import materialize


def location_stats(df: DataFrame) -> DataFrame:
    return df.where("location is not null").groupBy("location").agg(
        F.count("event_id").alias("total_incidents"), F.avg("severity_score").alias("avg_severity"),
        F.count_distinct("source_ip").alias("unique_ips"),
    ).orderBy(F.desc("total_incidents"), "location")


def _severity_by_location(df: DataFrame) -> DataFrame:
    return df.where("location is not null").groupBy("location").agg(F.avg("severity_score").alias("avg_severity"))


def global_location_mean(df: DataFrame) -> DataFrame:
    """Unweighted mean of the per-location means."""
    return _severity_by_location(df).agg(F.avg("avg_severity").alias("global_avg_severity"))


def severity_mix_by_location(df: DataFrame, n: int = 10) -> DataFrame:
    """Percent of each severity in the ``n`` most active locations."""
    counts = df.where("location is not null").groupBy("location").pivot("severity", SEVERITIES).agg(F.count(F.lit(1))).na.fill(0)
    total = sum((F.col(s) for s in SEVERITIES[1:]), F.col(SEVERITIES[0]))
    mix = counts.select("location", *[F.try_divide(F.col(s) * 100.0, total).alias(s.lower()) for s in SEVERITIES])
    return mix.join(F.broadcast(top_locations(df, n).select("location")), "location", "left_semi")  # n rows


def high_risk_locations(df: DataFrame, quantile: float = 0.75) -> DataFrame:
    """Mean severity strictly above the quantile over locations."""
    stats = materialize(location_stats(df), "locations")
    limit = exact_quantiles(stats, "avg_severity", {"q": quantile}).scalar()
    return stats.withColumn("severity_limit", limit).where(F.col("avg_severity") > F.col("severity_limit"))


def location_overview(df: DataFrame) -> DataFrame:
    counts = value_counts(df, "location")
    # Ties go to the first name: max_by would need a reversed string, min_by over the negated count does not.
    first = F.min_by("location", F.struct((-F.col("count")).alias("n"), F.col("location").alias("name")))
    return counts.agg(
        first.alias("most_active_location"), F.max("count").alias("most_active_count"),
        F.count(F.lit(1)).alias("total_locations"), F.avg("count").alias("avg_incidents_per_location"))


def critical_hotspot(df: DataFrame) -> DataFrame:
    """Location with most Critical incidents, first name on ties; empty without any."""
    return top_locations(df.where(F.col("severity") == "Critical"), 1).select("location", F.col("count").alias("critical_count"))


def location_risk(df: DataFrame) -> DataFrame:
    """.5 mean severity, .3 incidents, .2 addresses, each min-max scaled, times 100."""
    stats = df.where("location is not null").groupBy("location").agg(
        F.avg("severity_score").alias("severity"), F.count("event_id").alias("incidents"), F.count_distinct("source_ip").alias("ips"))
    scaled = minmax(materialize(stats, "locations"), ["severity", "incidents", "ips"])
    score = (F.col("severity_norm") * 0.5 + F.col("incidents_norm") * 0.3 + F.col("ips_norm") * 0.2) * 100
    return scaled.select("location", score.alias("geo_risk_score"))


def geo_multiplier(df: DataFrame) -> DataFrame:
    """Per-location multiplier: mean severity relative to the overall mean."""
    sums = df.groupBy("location").agg(F.sum("severity_score").alias("s"), F.count("severity_score").alias("n"))
    ratio = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    overall = df.agg(F.avg(F.col("severity_score").cast("double")).alias("mean")).scalar()
    mean = ratio(F.col("s"), F.col("n"))
    return sums.where("location is not null").withColumn("_overall", overall).select("location", mean.alias("avg_severity"), F.try_divide(mean, F.col("_overall")).alias("multiplier"))
