"""Table schemas, allowed values and the column rules of the published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

# Domains, weights and band edges of the data model.
SEVERITIES = ["Low", "Medium", "High", "Critical"]
SEVERITY_SCORES = {"Low": 1, "Medium": 2, "High": 3, "Critical": 4}
STATUSES = ["Successful", "Failed", "Blocked", "Allowed"]
STATUS_WEIGHTS = {"Successful": 1.0, "Failed": 0.3, "Blocked": 0.1, "Allowed": 0.8}
LOGIN_OUTCOMES = ["Yes", "No"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
RISK_LEVELS = ["Low", "Medium", "High", "Critical"]
ANOMALY_LEVELS = ["Normal", "Suspicious", "Anomalous", "Critical_Anomaly"]
HIGH_RISK_LOCATIONS = ["Unknown", "Russia", "China", "North Korea"]

INCIDENTS = StructType([
    StructField("event_id", LongType(), False),
    StructField("timestamp", TimestampNTZType(), False),
    StructField("event_type", StringType(), False),
    StructField("severity", StringType(), False),
    StructField("source_ip", StringType(), False),
    StructField("destination_device", StringType(), False),
    StructField("status", StringType(), False),
    StructField("location", StringType(), True),
])

LOGINS = StructType([
    StructField("login_id", LongType(), False),
    StructField("user_id", StringType(), False),
    StructField("login_time", TimestampNTZType(), False),
    StructField("success", StringType(), False),
    StructField("ip_address", StringType(), False),
])


def table_schemas() -> dict[str, StructType]:
    """The two base tables."""
    return {"incidents": INCIDENTS, "logins": LOGINS}


def create_tables(spark: SparkSession, database: str = "default") -> None:
    """Declare the base tables as Parquet tables."""
    for name, schema in table_schemas().items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


@dataclass(frozen=True)
class Rule:
    """One column rule: ``kind`` is not_null, unique, in, between, positive, ip, not_blank or references."""

    table: str
    column: str
    kind: str
    allowed: tuple = ()
    parent: tuple[str, str] | None = None


# Constraints declared on the base tables.
CONSTRAINTS = [
    Rule("incidents", "event_id", "unique"),
    Rule("incidents", "timestamp", "not_null"),
    Rule("incidents", "event_type", "not_null"),
    Rule("incidents", "severity", "not_null"),
    Rule("incidents", "severity", "in", tuple(SEVERITIES)),
    Rule("incidents", "source_ip", "not_null"),
    Rule("incidents", "destination_device", "not_null"),
    Rule("incidents", "status", "not_null"),
    Rule("incidents", "status", "in", tuple(STATUSES)),
    Rule("logins", "login_id", "unique"),
    Rule("logins", "user_id", "not_null"),
    Rule("logins", "login_time", "not_null"),
    Rule("logins", "success", "not_null"),
    Rule("logins", "success", "in", tuple(LOGIN_OUTCOMES)),
    Rule("logins", "ip_address", "not_null"),
]


def _required(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, column, "not_null") for column in columns]


# Rules of the published (cleaned, merged, profile) tables.
DICTIONARY = [
    *_required("incidents_cleaned", "event_id", "timestamp", "event_type", "severity", "severity_score", "source_ip",
               "destination_device", "status", "hour", "day_of_week", "is_weekend"),
    Rule("incidents_cleaned", "event_id", "unique"),
    Rule("incidents_cleaned", "event_id", "positive"),
    Rule("incidents_cleaned", "severity", "in", tuple(SEVERITIES)),
    Rule("incidents_cleaned", "severity_score", "between", (1, 4)),
    Rule("incidents_cleaned", "source_ip", "ip"),
    Rule("incidents_cleaned", "destination_device", "not_blank"),
    Rule("incidents_cleaned", "status", "in", tuple(STATUSES)),
    Rule("incidents_cleaned", "hour", "between", (0, 23)),
    Rule("incidents_cleaned", "day_of_week", "in", tuple(WEEKDAYS)),
    *_required("logins_cleaned", "login_id", "user_id", "login_time", "success", "ip_address", "hour", "day_of_week",
               "is_weekend"),
    Rule("logins_cleaned", "login_id", "unique"),
    Rule("logins_cleaned", "login_id", "positive"),
    Rule("logins_cleaned", "user_id", "not_blank"),
    Rule("logins_cleaned", "ip_address", "ip"),
    Rule("logins_cleaned", "hour", "between", (0, 23)),
    Rule("logins_cleaned", "day_of_week", "in", tuple(WEEKDAYS)),
    *_required("security_events_merged", "source_ip"),
    Rule("security_events_merged", "source_ip", "ip"),
    Rule("security_events_merged", "incident_event_id", "positive"),
    Rule("security_events_merged", "incident_event_id", "references", parent=("incidents_cleaned", "event_id")),
    Rule("security_events_merged", "incident_severity", "in", tuple(SEVERITIES)),
    Rule("security_events_merged", "incident_severity_score", "between", (1, 4)),
    Rule("security_events_merged", "login_login_id", "positive"),
    Rule("security_events_merged", "login_login_id", "references", parent=("logins_cleaned", "login_id")),
    *_required("top_risk_profiles", "source_ip", "ensemble_risk_score", "final_risk_level", "basic_risk_score",
               "advanced_risk_score", "temporal_risk_score", "anomaly_score", "geo_risk_score"),
    Rule("top_risk_profiles", "source_ip", "unique"),
    Rule("top_risk_profiles", "source_ip", "ip"),
    Rule("top_risk_profiles", "ensemble_risk_score", "between", (0, 100)),
    Rule("top_risk_profiles", "final_risk_level", "in", tuple(RISK_LEVELS)),
]
