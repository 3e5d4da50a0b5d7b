"""Structured Streaming forms of the continuous operators.

Every function maps streaming frames to a streaming frame; ``drain`` runs one
to the end of the available input into files.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from watchledger.functions.cleaning import clean_incidents, clean_logins, severity_score
from watchledger.workspace import new_path

LATENESS = "1 hour"


def event_time(df: DataFrame, ts: str, lateness: str) -> DataFrame:
    """Watermarks need an instant; the tables hold wall-clock times, read as session time (UTC)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def stream_incident_counts(incidents: DataFrame, width: str = "1 hour", lateness: str = LATENESS) -> DataFrame:
    """Tumbling counts per severity; data later than the watermark is dropped."""
    counts = event_time(incidents, "timestamp", lateness).groupBy(F.window("timestamp", width).alias("w"), "severity").agg(
        F.count(F.lit(1)).alias("incidents"))
    return wall_clock(counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "severity", "incidents"),
                      "window_start", "window_end")


def hourly_baseline(incidents: DataFrame) -> DataFrame:
    """Static mean incidents per active hour, by hour of day (24 rows at most)."""
    hours = incidents.groupBy(F.date_trunc("hour", "timestamp").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return hours.groupBy(F.hour("h").alias("hour")).agg(F.avg("n").alias("baseline"))


def stream_spikes(incidents: DataFrame, baseline: DataFrame, ratio: float = 2.0, lateness: str = LATENESS) -> DataFrame:
    """Sliding one-hour counts above ``ratio`` times the baseline of their hour."""
    counts = event_time(incidents, "timestamp", lateness).groupBy(F.window("timestamp", "1 hour", "10 minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("incidents")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "incidents")
    return wall_clock(counts, "window_start", "window_end").withColumn("hour", F.hour("window_start")).join(F.broadcast(baseline), "hour").where(
        F.col("incidents") > F.col("baseline") * ratio).select("window_start", "window_end", "incidents", "baseline")


def stream_campaigns(incidents: DataFrame, n: int = 5, gap: str = "5 minutes", lateness: str = LATENESS) -> DataFrame:
    """Sessions of a source with at least ``n`` events."""
    sessions = event_time(incidents.where("source_ip is not null"), "timestamp", lateness).groupBy(
        F.session_window("timestamp", gap).alias("s"), "source_ip").agg(F.count(F.lit(1)).alias("events"))
    report = sessions.where(F.col("events") >= n).select("source_ip", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events")
    return wall_clock(report, "session_start", "session_end")


def stream_correlate(incidents: DataFrame, logins: DataFrame, minutes: int = 60, lateness: str = LATENESS) -> DataFrame:
    """Incidents with logins of the same source within the window, left outer.

    Unmatched incidents come out once the watermark has passed them.  The state
    is keyed by (source, time bucket), so one busy source is spread over many
    state partitions; a login is offered to its own bucket and both neighbours.
    """
    seconds = minutes * 60
    bucket = lambda ts: F.floor(F.unix_seconds(F.col(ts)) / seconds)
    left = event_time(incidents.select("event_id", "timestamp", "source_ip"), "timestamp", lateness).withColumn("bucket", bucket("timestamp"))
    right = event_time(logins.select("login_id", "login_time", "ip_address"), "login_time", lateness).withColumn("_own", bucket("login_time"))
    right = right.select("login_id", "login_time", "ip_address", F.explode(F.array(F.col("_own") - 1, F.col("_own"), F.col("_own") + 1)).alias("login_bucket"))
    window = F.expr(f"INTERVAL {minutes} MINUTES")
    near: Column = (
        (F.col("source_ip") == F.col("ip_address")) & (F.col("bucket") == F.col("login_bucket"))
        & (F.col("login_time") >= F.col("timestamp") - window) & (F.col("login_time") <= F.col("timestamp") + window)
    )
    joined = left.join(right, near, "left").select("event_id", "timestamp", "source_ip", "login_id", "login_time")
    return wall_clock(joined, "timestamp", "login_time")


def stream_dedupe(events: DataFrame, key: str = "event_id", ts: str = "timestamp", lateness: str = LATENESS) -> DataFrame:
    """Repeated events within the watermark are dropped."""
    return wall_clock(event_time(events, ts, lateness).dropDuplicatesWithinWatermark([key]), ts)


def stream_clean_incidents(incidents: DataFrame) -> DataFrame:
    return clean_incidents(incidents)


def stream_clean_logins(logins: DataFrame) -> DataFrame:
    return clean_logins(logins)


def stream_ip_profile(incidents: DataFrame) -> DataFrame:
    """Running count and mean severity per source, for update mode."""
    return incidents.where("source_ip is not null").groupBy("source_ip").agg(
        F.count(F.lit(1)).alias("incidents"), F.sum(severity_score(F.col("severity"))).alias("severity_sum"), F.max("timestamp").alias("last_seen"))


#: Event time of the row that ends a finite input; state functions hold times as nanoseconds, which end in 2262.
END_OF_INPUT = datetime(2200, 1, 1)


def with_end(stream: DataFrame, ts: str) -> DataFrame:
    """A finite stream and one more row far in the future.

    It moves the watermark beyond all events, so that the last windows, sessions
    and unmatched rows come out; itself it never does.
    """
    spark = stream.sparkSession
    fill = {"string": f"end of {ts}", "timestamp_ntz": END_OF_INPUT, "timestamp": END_OF_INPUT}
    values = [END_OF_INPUT if f.name == ts else fill.get(f.dataType.simpleString(), -1 if isinstance(f.dataType, (LongType, IntegerType)) else None) for f in stream.schema]
    schema = StructType([StructField(f.name, f.dataType) for f in stream.schema])
    path = new_path(spark, "end-of-input")
    spark.createDataFrame([tuple(values)], schema).coalesce(1).write.parquet(path)
    return stream.unionByName(spark.readStream.schema(schema).parquet(path))


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Append-mode run over everything available now; returns the written table."""
    spark = stream.sparkSession
    out, state = new_path(spark, label), new_path(spark, label + "-state")
    query = stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def drain_updates(stream: DataFrame, key: str, label: str) -> DataFrame:
    """Update-mode run: each micro-batch writes its changed keys, the newest version of a key wins.

    A batch writes to its own folder in overwrite mode, so a retried batch replaces itself.
    """
    spark = stream.sparkSession
    out, state = new_path(spark, label), new_path(spark, label + "-state")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    query = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    versions = spark.read.option("basePath", out).parquet(out)
    columns = [c for c in stream.columns if c != key]
    newest = versions.groupBy(key).agg(F.max_by(F.struct(*columns), "epoch").alias("v"))
    return newest.select(key, *[F.col(f"v.{c}").alias(c) for c in columns])
