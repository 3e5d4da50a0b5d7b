"""The two batch programs: cleaning and merging, then scoring.

Each reads its folder once, writes every table once and lets the next step read
the written table.  ``python -m watchledger.jobs clean RAW OUT`` and
``python -m watchledger.jobs score CLEAN OUT``.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from watchledger.operators import correlate, quality, source_risk
from watchledger.session import build_session
from watchledger.sources import readers, sinks


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_job(spark: SparkSession, raw: str, out: str, minutes: int = 60) -> dict[str, str]:
    """Cleaned incidents and logins, their merge with features, and the quality report; returns the path of each table."""
    paths = {name: f"{out.rstrip('/')}/{name}" for name in ("incidents_cleaned", "logins_cleaned", "security_events_merged", "quality_report")}
    incidents = _stored(readers.read_incidents(spark, f"{raw.rstrip('/')}/incidents.csv"), paths["incidents_cleaned"])
    logins = _stored(readers.read_logins(spark, f"{raw.rstrip('/')}/logins.csv"), paths["logins_cleaned"])
    merged = _stored(correlate.correlate_features(correlate.correlate(incidents, logins, minutes)), paths["security_events_merged"])
    _stored(quality.quality_report(incidents, logins, merged), paths["quality_report"])
    return paths


def score_job(spark: SparkSession, clean: str, out: str, top: int = 20) -> dict[str, str]:
    """Profile of every address, its summary, and the addresses of highest risk as CSV; returns the path of each."""
    paths = {name: f"{out.rstrip('/')}/{name}" for name in ("risk_profiles", "risk_summary", "top_risk")}
    incidents = spark.read.parquet(f"{clean.rstrip('/')}/incidents_cleaned")
    profile = _stored(source_risk.ip_risk_profile(incidents), paths["risk_profiles"])
    _stored(source_risk.risk_summary(profile), paths["risk_summary"])
    sinks.export_top_risk(profile, paths["top_risk"], top)
    return paths


def main(args: list[str]) -> int:
    programs = {"clean": clean_job, "score": score_job}
    if len(args) != 3 or args[0] not in programs:
        print(__doc__)
        return 2
    for name, path in programs[args[0]](build_session("watchledger"), args[1], args[2]).items():
        print(name, path)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
