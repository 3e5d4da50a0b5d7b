"""Anomalous incidents; operators take prepared incidents (hour, severity_score)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.functions.statistics import any_z_gt
from watchledger.operators import forest
from watchledger.operators.ordering import label_encode, top_k
from watchledger.workspace import materialize

FEATURES = ["hour", "severity_score", "event_type_encoded", "location_encoded"]


def encode_features(df: DataFrame) -> DataFrame:
    """Codes of type and location; a missing location is coded as 'Unknown'."""
    typed = label_encode(df, "event_type", "event_type_encoded")
    placed = label_encode(typed.withColumn("_location", F.coalesce("location", F.lit("Unknown"))), "_location", "location_encoded")
    return placed.drop("_location")


def zscore_flags(df: DataFrame, limit: float = 3.0) -> DataFrame:
    """1 when any feature lies more than ``limit`` standard deviations out."""
    return any_z_gt(encode_features(df), FEATURES, limit)


def event_isolation(df: DataFrame, contamination: float = 0.05, seed: int = 42) -> DataFrame:
    return _isolated(materialize(encode_features(df), "encoded"), contamination, seed)


def _isolated(encoded: DataFrame, contamination: float, seed: int) -> DataFrame:
    return forest.isolation_forest(encoded, FEATURES, ["event_id"], contamination, seed, few_values=True)


def combined_anomalies(df: DataFrame, contamination: float = 0.05, seed: int = 42) -> DataFrame:
    """Isolation score and z flag in one ensemble score; the encoded rows are written once and serve both."""
    encoded = materialize(encode_features(df), "encoded")
    flagged = any_z_gt(encoded, FEATURES)
    both = _isolated(flagged, contamination, seed)
    return both.withColumn("ensemble_anomaly_score", F.col("iso_score") * 0.7 + F.col("zscore_anomaly") * 20)


def top_event_anomalies(df: DataFrame, n: int = 20) -> DataFrame:
    report = combined_anomalies(df).select("event_id", "timestamp", "event_type", "severity", "source_ip", "location", "ensemble_anomaly_score")
    return top_k(report, n, F.desc(F.round("ensemble_anomaly_score", 9)), F.col("event_id"))


def alert_anomaly_events(df: DataFrame) -> DataFrame:
    """The events that the isolation forest or the z-score flags."""
    found = combined_anomalies(df).where((F.col("iso_anomaly") == 1) | (F.col("zscore_anomaly") == 1))
    return found.select("event_id", "timestamp", "event_type", "severity", "source_ip", "location", "iso_anomaly", "zscore_anomaly", "ensemble_anomaly_score")


def top_zscore_events(df: DataFrame, n: int = 20, limit: float = 3.0) -> DataFrame:
    """The report on the z term alone, by event identifier."""
    report = zscore_flags(df, limit).select("event_id", "timestamp", "event_type", "severity", "source_ip", "location",
                                            (F.col("zscore_anomaly") * 20).alias("zscore_term"))
    return top_k(report, n, F.desc("zscore_term"), F.col("event_id"))
