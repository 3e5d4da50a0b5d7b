"""Risk profile per source address.

Null addresses are left out.  The scores read one per-source table
(``source_metrics``), so the events are scanned and shuffled once, not five times.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.functions.cleaning import band, severity_score
from watchledger.functions.statistics import abs_zscore, minmax, round_even
from watchledger.operators import forest
from watchledger.operators.correlate import join_scores
from watchledger.operators.ordering import top_k
from watchledger.schemas import ANOMALY_LEVELS, HIGH_RISK_LOCATIONS, RISK_LEVELS
from watchledger.workspace import materialize

INF = float("inf")

# Weights and band edges of the scores.
ADVANCED_WEIGHTS = {"frequency": 0.30, "avg_severity": 0.25, "success_rate": 0.20, "event_diversity": 0.10, "persistence_days": 0.15}
ENSEMBLE_WEIGHTS = {
    "basic_risk_score": 0.2, "advanced_risk_score": 0.3, "temporal_risk_score": 0.25, "anomaly_score": 0.15, "geo_risk_score": 0.1,
}
BASIC_EDGES = [0, 5, 15, 30, INF]
ADVANCED_EDGES = [0, 25, 50, 75, INF]
TEMPORAL_EDGES = [0, 10, 25, 50, INF]
ANOMALY_EDGES = [-INF, 0.5, 1.0, 1.5, INF]
GEO_EDGES = [0, 10, 30, 70, INF]
FINAL_EDGES = [0, 30, 55, 80, INF]

FEATURES = ["frequency", "avg_severity", "success_rate", "event_diversity", "avg_hour", "location_count"]


def weighted_sum(weights: dict[str, float], suffix: str = "_norm") -> Column:
    return reduce(lambda a, b: a + b, [F.col(c + suffix) * w * 100 for c, w in weights.items()])


def source_metrics(df: DataFrame, window_days: int = 7, high_risk: Sequence[str] = HIGH_RISK_LOCATIONS) -> DataFrame:
    """One row per address with every measure the scores need.

    Events first shrink to (address, type, location) cells with map-side
    aggregation, so a hot address costs a few dozen cells.
    """
    latest = df.agg(F.max("timestamp").alias("t")).scalar()
    rows = df.where("source_ip is not null").withColumn("_latest", latest).select(
        "source_ip", "event_type", "location", "timestamp", "event_id",
        F.timestamp_diff("DAY", F.col("timestamp"), F.col("_latest")).alias("age"),
        severity_score(F.col("severity")).alias("score"), (F.col("status") == "Successful").alias("ok"),
    ).withColumn("decay", F.exp(-F.col("age") / F.lit(float(window_days))))
    cells = rows.groupBy("source_ip", "event_type", "location").agg(
        F.count(F.lit(1)).alias("rows"), F.count("event_id").alias("ids"), F.sum("score").alias("score_sum"),
        F.count("score").alias("score_n"), F.count_if("ok").alias("ok"), F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"), F.sum(F.hour("timestamp")).alias("hour_sum"), F.count("timestamp").alias("hour_n"),
        F.sum(F.col("score") * F.col("decay")).alias("weighted"), F.sum("decay").alias("weight"), F.min("age").alias("age"),
    )
    risk = F.when(F.col("location").isin(list(high_risk)), 3).otherwise(1)
    ratio = lambda a, b: round_even(F.try_divide(F.sum(a).cast("double"), F.sum(b).cast("double")), 3)
    nullable = F.max(F.col("location").isNull().cast("int"))
    return cells.groupBy("source_ip").agg(
        F.sum("ids").alias("frequency"),
        ratio("score_sum", "score_n").alias("avg_severity"),
        ratio("ok", "rows").alias("success_rate"),
        F.min("first").alias("first_seen"), F.max("last").alias("last_seen"),
        F.count_distinct("event_type").alias("event_diversity"),
        F.count_distinct("location").alias("location_diversity"),
        (F.count_distinct("location") + nullable).alias("location_count"),
        F.timestamp_diff("DAY", F.min("first"), F.max("last")).alias("persistence_days"),
        ratio("hour_sum", "hour_n").alias("avg_hour"),
        round_even(F.try_divide(F.sum(risk * F.col("rows")).cast("double"), F.sum("rows").cast("double")), 3).alias("avg_country_risk"),
        round_even(F.sum("weighted"), 3).alias("weighted_severity_sum"),
        round_even(F.sum("weight"), 3).alias("total_weight"),
        F.min("age").alias("most_recent_days"),
    )


def _basic(metrics: DataFrame) -> DataFrame:
    score = round_even(F.col("frequency") * F.col("avg_severity"), 2)
    return metrics.withColumn("basic_risk_score", score).withColumn("risk_level", band(F.col("basic_risk_score"), BASIC_EDGES, RISK_LEVELS))


def _advanced(metrics: DataFrame) -> DataFrame:
    scaled = minmax(metrics, list(ADVANCED_WEIGHTS))
    scored = scaled.withColumn("advanced_risk_score", round_even(weighted_sum(ADVANCED_WEIGHTS), 2))
    return scored.drop(*[c + "_norm" for c in ADVANCED_WEIGHTS]).withColumn(
        "advanced_risk_level", band(F.col("advanced_risk_score"), ADVANCED_EDGES, RISK_LEVELS))


def _temporal(metrics: DataFrame) -> DataFrame:
    weight = F.when(F.col("total_weight") == 0, F.lit(1.0)).otherwise(F.col("total_weight"))
    bonus = F.exp(-F.col("most_recent_days") / F.lit(30.0))
    score = round_even(F.col("weighted_severity_sum") / weight * 10, 2) * (1 + bonus)
    return metrics.withColumns({"recency_bonus": bonus, "temporal_risk_score": score}).withColumn(
        "temporal_risk_level", band(F.col("temporal_risk_score"), TEMPORAL_EDGES, RISK_LEVELS))


def _geo(metrics: DataFrame) -> DataFrame:
    score = F.col("frequency") * F.col("avg_severity") * F.col("avg_country_risk") * F.log1p(F.col("location_count").cast("double"))
    return metrics.withColumn("geo_risk_score", round_even(score, 2)).withColumn(
        "geo_risk_level", band(F.col("geo_risk_score"), GEO_EDGES, RISK_LEVELS))


def _anomaly(metrics: DataFrame, contamination: float = 0.1, seed: int = 42) -> DataFrame:
    """Isolation label (+1 outlier, -1 inlier) and z-scores over seven columns, the label included."""
    flagged = forest.isolation_forest(metrics, FEATURES, ["source_ip"], contamination, seed)
    labelled = flagged.withColumn("isolation_score", F.when(F.col("iso_anomaly") == 1, 1).otherwise(-1))
    return composite_anomaly(labelled)


def composite_anomaly(labelled: DataFrame) -> DataFrame:
    """The composite for rows that already carry ``isolation_score``."""
    scored = abs_zscore(labelled, [*FEATURES, "isolation_score"])
    score = round_even(F.col("isolation_score") * 0.6 + F.col("z_score_max") * 0.4, 3)
    return scored.withColumn("anomaly_score", score).withColumn(
        "anomaly_level", band(F.col("anomaly_score"), ANOMALY_EDGES, ANOMALY_LEVELS))


def ip_basic_risk(df: DataFrame) -> DataFrame:
    """``active_days`` counts distinct instants; ``active_dates`` counts calendar days."""
    spans = df.where("source_ip is not null").groupBy("source_ip", F.to_date("timestamp").alias("day")).agg(
        F.count_distinct("timestamp").alias("instants"))
    active = spans.groupBy("source_ip").agg(F.sum("instants").alias("active_days"), F.count("day").alias("active_dates"))
    scored = _basic(source_metrics(df)).join(active, "source_ip", "left")
    return scored.select("source_ip", F.col("frequency").alias("incident_count"), "avg_severity", "success_rate", "first_seen",
                         "last_seen", "active_days", "active_dates", "basic_risk_score", "risk_level")


def ip_advanced_risk(df: DataFrame) -> DataFrame:
    targets = df.where("source_ip is not null").groupBy("source_ip").agg(F.count_distinct("destination_device").alias("target_diversity"))
    scored = _advanced(materialize(source_metrics(df), "source-metrics"))
    return scored.join(targets, "source_ip", "left").select(
        "source_ip", *ADVANCED_WEIGHTS, "location_diversity", "target_diversity", "advanced_risk_score", "advanced_risk_level")


def ip_temporal_risk(df: DataFrame, window_days: int = 7) -> DataFrame:
    return _temporal(source_metrics(df, window_days)).select(
        "source_ip", F.col("frequency").alias("total_incidents"), "weighted_severity_sum", "total_weight", "most_recent_days",
        "event_diversity", "recency_bonus", "temporal_risk_score", "temporal_risk_level")


def ip_anomaly_scores(df: DataFrame, contamination: float = 0.1, seed: int = 42) -> DataFrame:
    scored = _anomaly(materialize(source_metrics(df), "source-metrics"), contamination, seed)
    return scored.select("source_ip", *FEATURES, "isolation_score", "z_score_max", "z_score_avg", "anomaly_score", "anomaly_level")


def ip_geo_risk(df: DataFrame, high_risk: Sequence[str] = HIGH_RISK_LOCATIONS) -> DataFrame:
    return _geo(source_metrics(df, high_risk=high_risk)).select(
        "source_ip", "frequency", "avg_country_risk", F.col("location_count").alias("location_diversity"), "avg_severity",
        "geo_risk_score", "geo_risk_level")


def ensemble(profile: DataFrame, weights: dict[str, float] = ENSEMBLE_WEIGHTS) -> DataFrame:
    """Min-max of each score over all addresses, weighted, times 100, banded."""
    scaled = minmax(profile, list(weights)).withColumn("ensemble_risk_score", round_even(weighted_sum(weights), 2))
    return scored_profile(scaled.drop(*[c + "_norm" for c in weights]))


def scored_profile(scaled: DataFrame) -> DataFrame:
    return scaled.withColumns({
        "final_risk_level": band(F.col("ensemble_risk_score"), FINAL_EDGES, RISK_LEVELS), "risk_trend": F.lit("Stable"),
    })


_LEVELS = {"basic_risk_score": "risk_level", "advanced_risk_score": "advanced_risk_level", "temporal_risk_score": "temporal_risk_level",
           "anomaly_score": "anomaly_level", "geo_risk_score": "geo_risk_level"}


def ip_risk_profile(df: DataFrame, use_anomaly: bool = True) -> DataFrame:
    """All scores of every address, highest ensemble first.

    The scores are computed side by side on the one per-source table; the
    anomaly score needs its own passes and is joined by address.
    """
    metrics = materialize(source_metrics(df), "source-metrics")
    scores = _geo(_temporal(_advanced(_basic(metrics))))
    weights = {c: w for c, w in ENSEMBLE_WEIGHTS.items() if use_anomaly or c != "anomaly_score"}
    if use_anomaly:
        scores = join_scores(scores, _anomaly(metrics).select("source_ip", "anomaly_score", "anomaly_level"))
    columns = [c for score in weights for c in (score, _LEVELS[score])]
    profile = materialize(scores.select("source_ip", *columns), "profile")
    return ensemble(profile, weights).orderBy(F.desc_nulls_last("ensemble_risk_score"), "source_ip")


def risk_summary(profile: DataFrame) -> DataFrame:
    """Number of addresses, High and Critical ones, mean and maximum score, and one column per level."""
    level = lambda name: F.count_if(F.col("final_risk_level") == name)
    return profile.agg(
        F.count(F.lit(1)).alias("total_ips_analyzed"), level("High").alias("high_risk_ips"), level("Critical").alias("critical_risk_ips"),
        round_even(F.avg("ensemble_risk_score"), 2).alias("avg_ensemble_score"), F.max("ensemble_risk_score").alias("max_risk_score"),
        *[level(name).alias(f"level_{name.lower()}") for name in RISK_LEVELS],
        F.count_if(F.col("final_risk_level").isNull()).alias("level_none"),
    )


def top_risk(profile: DataFrame, n: int = 20) -> DataFrame:
    return top_k(profile, n, F.desc_nulls_last("ensemble_risk_score"), F.col("source_ip"))
