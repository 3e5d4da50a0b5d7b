"""Writers of the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.operators.source_risk import top_risk

# Fixed value: microseconds are kept in CSV.
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def export_cleaned(df: DataFrame, directory: str, name: str, fmt: str = "csv", date_column: str | None = None) -> str:
    """Write a table below ``directory``; with ``date_column`` partitioned by its day."""
    path = f"{directory.rstrip('/')}/{name}"
    writer = df
    if date_column:
        writer = df.withColumn("day", F.to_date(date_column)).write.partitionBy("day")
    else:
        writer = df.write
    writer = writer.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def export_for_dashboard(directory: str, incidents: DataFrame, logins: DataFrame, merged: DataFrame, fmt: str = "csv") -> dict[str, str]:
    """The three published tables."""
    tables = {"incidents_cleaned": incidents, "logins_cleaned": logins, "security_events_merged": merged}
    return {name: export_cleaned(df, directory, name, fmt) for name, df in tables.items()}


def export_top_risk(profile: DataFrame, directory: str, n: int = 20) -> str:
    """The ``n`` riskiest sources."""
    return export_cleaned(top_risk(profile, n), directory, "top_risk_profiles")
