"""Risk score per incident; operators take prepared incidents (hour, severity_score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.functions.cleaning import band
from watchledger.functions.statistics import histogram, minmax, stats_of
from watchledger.operators import forest
from watchledger.operators.correlate import map_lookup
from watchledger.operators.geo import location_risk
from watchledger.operators.ordering import label_encode, top_k, trailing_count
from watchledger.operators.source_risk import FINAL_EDGES, weighted_sum
from watchledger.schemas import RISK_LEVELS, SEVERITIES
from watchledger.workspace import materialize

# Weights of the ensemble and the off-hours factor.
WEIGHTS = {"basic_risk_score": 0.25, "advanced_risk_score": 0.25, "temporal_risk_score": 0.2, "anomaly_score": 0.15, "geo_risk_score": 0.15}
OFF_HOURS_FACTOR = 1.3


def _base() -> Column:
    return F.col("severity_score") * F.lit(100.0)


def event_basic_risk(df: DataFrame) -> DataFrame:
    return df.withColumn("basic_risk_score", _base())


def event_rarity(df: DataFrame) -> DataFrame:
    """Rows over rows of the type, per event type."""
    counts = df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.where("event_type is not null").withColumn("_total", total).select("event_type", (F.lit(1.0) / (F.col("n") / F.col("_total"))).alias("event_rarity"))


def event_advanced_risk(df: DataFrame) -> DataFrame:
    """Rarity of the type and an off-hours factor."""
    business = F.coalesce(F.col("hour").between(9, 17), F.lit(False))
    score = _base() * (1 + F.col("event_rarity") / 10) * F.when(business, F.lit(1.0)).otherwise(F.lit(OFF_HOURS_FACTOR))
    return map_lookup(df, event_rarity(df), "event_type").withColumns({"business_hours": business, "advanced_risk_score": score})


def event_temporal_risk(df: DataFrame) -> DataFrame:
    """Scaled by the number of events of any source in the 24 hours up to the event.

    The per-instant counts meet the events by timestamp; an instant shared by
    many events is split by the adaptive skew join, missing times are dealt over all tasks.
    """
    counted = map_lookup(df, trailing_count(df, "timestamp", 24, "rolling_incidents_24h"), "timestamp")
    return counted.withColumn("temporal_risk_score", _base() * (1 + F.col("rolling_incidents_24h") / 10))


def event_anomaly(df: DataFrame, contamination: float = 0.1, seed: int = 42) -> DataFrame:
    """100 for outliers on (hour, severity, event-type code), else 0."""
    coded = label_encode(df, "event_type", "event_type_code")
    flagged = forest.isolation_forest(coded, ["hour", "severity_score", "event_type_code"], ["event_id"], contamination, seed, few_values=True)
    return flagged.withColumn("anomaly_score", F.col("iso_anomaly") * 100.0).drop("event_type_code", "iso_anomaly", "iso_score")


def event_geo_risk(df: DataFrame) -> DataFrame:
    return map_lookup(df, location_risk(df), "location")


def event_ensemble(df: DataFrame, use_anomaly: bool = True) -> DataFrame:
    """All scores of every incident; the scored rows are written once and then read for bounds and result.

    The forest works on the prepared incidents, before the other scores are attached.
    """
    start = event_anomaly(df) if use_anomaly else df
    scored = materialize(event_geo_risk(event_temporal_risk(event_advanced_risk(event_basic_risk(start)))), "event-scores")
    weights = {c: w for c, w in WEIGHTS.items() if use_anomaly or c != "anomaly_score"}
    total = minmax(scored, list(weights)).withColumn("ensemble_risk_score", weighted_sum(weights)).drop(*[c + "_norm" for c in weights])
    return total.withColumn("final_risk_level", band(F.col("ensemble_risk_score"), FINAL_EDGES, RISK_LEVELS))


def risk_level_distribution(scored: DataFrame) -> DataFrame:
    return scored.where("final_risk_level is not null").groupBy("final_risk_level").agg(F.count(F.lit(1)).alias("incidents"))


def _mean_by(scored: DataFrame, *key: Column | str) -> DataFrame:
    return scored.groupBy(*key).agg(F.avg("ensemble_risk_score").alias("avg_risk_score"))


def risk_by_event_type(scored: DataFrame, n: int = 10) -> DataFrame:
    return top_k(_mean_by(scored, "event_type"), n, F.desc_nulls_last("avg_risk_score"), F.col("event_type"))


def risk_by_location(scored: DataFrame, n: int = 10) -> DataFrame:
    return top_k(_mean_by(scored.where("location is not null"), "location"), n, F.desc_nulls_last("avg_risk_score"), F.col("location"))


def risk_by_severity(scored: DataFrame) -> DataFrame:
    """Four fixed rows, Low to Critical."""
    frame = scored.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(s) for s in SEVERITIES])).alias("position", "severity"))
    means = _mean_by(scored.where(F.col("severity").isin(SEVERITIES)), "severity")
    return frame.join(F.broadcast(means), "severity", "left").orderBy("position").select("severity", "avg_risk_score")  # four rows


def risk_by_day(scored: DataFrame) -> DataFrame:
    return _mean_by(scored, F.to_date("timestamp").alias("date")).orderBy("date")


def risk_by_hour(scored: DataFrame) -> DataFrame:
    return _mean_by(scored, F.hour("timestamp").alias("hour")).orderBy("hour")


def risk_histogram(scored: DataFrame, bins: int = 30) -> DataFrame:
    """Bins with the overall mean beside them."""
    mean = stats_of(scored, m=F.avg("ensemble_risk_score"))
    return histogram(scored, "ensemble_risk_score", bins).withColumn("mean_score", mean["m"])
