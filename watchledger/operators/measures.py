"""Dashboard measures, alerts, slicers and predictions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.functions.cleaning import band_ge
from watchledger.functions.statistics import standard_scale
from watchledger.operators.ordering import exact_quantiles
from watchledger.workspace import materialize

# Inclusive lower cuts of the dashboard categories.
CATEGORY_CUTS = [80, 55, 30]
CATEGORY_LABELS = ["Critical", "High", "Medium"]
#: Parts over which pairs of event types are dealt.
_PAIR_PARTS = 64


def _n() -> Column:
    return F.count(F.lit(1))


def risk_category(column: Column) -> Column:
    return band_ge(column, CATEGORY_CUTS, CATEGORY_LABELS, "Low")


def success_rate_measure(df: DataFrame) -> DataFrame:
    return df.agg(F.try_divide(F.count_if(F.col("status") == "Successful").cast("double"), _n().cast("double")).alias("success_rate"))


def kpi_cards(df: DataFrame, scored: DataFrame) -> DataFrame:
    """Total, critical, mean risk, success rate, sources and peak hour in one row."""
    hours = df.where("timestamp is not null").groupBy(F.hour("timestamp").alias("hour")).agg(_n().alias("n"))
    return df.agg(
        _n().alias("total_incidents"), F.count_if(F.col("severity") == "Critical").alias("critical_incidents"),
        F.try_divide(F.count_if(F.col("status") == "Successful").cast("double"), _n().cast("double")).alias("success_rate"),
        F.count_distinct("source_ip").alias("unique_ips"),
    ).withColumns({
        "avg_risk_score": scored.agg(F.avg("ensemble_risk_score").alias("a")).scalar(),
        "peak_hour": hours.agg(F.max_by("hour", F.struct(F.col("n"), -F.col("hour"))).alias("h")).scalar(),
    })


def alert_critical_ips(profile: DataFrame, limit: float = 80) -> DataFrame:
    return profile.where(F.col("ensemble_risk_score") > limit)


def alert_severity_clusters(df: DataFrame, window: str = "1 hour", slide: str = "15 minutes", n: int = 5) -> DataFrame:
    """Sliding windows with at least ``n`` High or Critical incidents."""
    severe = df.where(F.col("severity").isin("High", "Critical"))
    return severe.groupBy(F.window("timestamp", window, slide).alias("w")).agg(_n().alias("severe_incidents")).where(
        F.col("severe_incidents") >= n).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "severe_incidents")


def brute_force_ips(logins: DataFrame, n: int = 2, window: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    """Addresses with bursts of failed logins: the fullest window and the number of windows."""
    failed = logins.where((F.col("success") == "No") & F.col("ip_address").isNotNull())
    windows = failed.groupBy("ip_address", F.window("login_time", window, slide).alias("w")).agg(_n().alias("failed")).where(F.col("failed") >= n)
    return windows.groupBy("ip_address").agg(
        F.max("failed").alias("max_failed"), _n().alias("windows"), F.min("w.start").alias("first_window"))


def risk_velocity(df: DataFrame) -> DataFrame:
    """Weekly mean severity times incidents, and its change; takes prepared incidents."""
    weekly = df.where("timestamp is not null").groupBy(F.date_trunc("week", "timestamp").cast("date").alias("week_start")).agg(
        F.sum("severity_score").cast("double").alias("risk"))
    return weekly.withColumn("velocity", F.col("risk") - F.lag("risk").over(Window.orderBy("week_start")))


def threat_persistence(df: DataFrame) -> DataFrame:
    """Days since the first and last incident of each source, from the newest incident overall."""
    latest = df.agg(F.max("timestamp").alias("t")).scalar()
    spans = df.where("source_ip is not null").groupBy("source_ip").agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    return spans.withColumn("_latest", latest).select(
        "source_ip", F.timestamp_diff("DAY", F.col("first"), F.col("_latest")).alias("days_since_first"),
        F.timestamp_diff("DAY", F.col("last"), F.col("_latest")).alias("days_since_last"))


def attack_diversity(df: DataFrame) -> DataFrame:
    return df.where("source_ip is not null").groupBy("source_ip").agg(F.count_distinct("event_type").alias("attack_diversity"))


def user_login_anomalies(logins: DataFrame, limit: float = 2.0) -> DataFrame:
    """Users whose failure rate lies more than ``limit`` population deviations from the mean."""
    users = logins.groupBy("user_id").agg(
        _n().alias("attempts"), F.avg(F.when(F.col("success") == "No", 1.0).otherwise(0.0)).alias("fail_rate"))
    users = materialize(users, "users")
    return standard_scale(users, ["fail_rate"]).withColumnRenamed("fail_rate_z", "z_score").where(F.abs("z_score") > limit)


def ip_relationships(df: DataFrame) -> DataFrame:
    """Sources related by attacking the same device on the same day.

    Kept as the bipartite graph itself - one row per (source, device, day) with
    the number of peers - which is linear in the data; writing out every pair
    of peers would square the busiest device.
    """
    links = df.where("source_ip is not null").groupBy("destination_device", F.to_date("timestamp").alias("date"), "source_ip").agg(_n().alias("incidents"))
    peers = links.groupBy("destination_device", "date").agg((_n() - 1).alias("peers")).where("peers > 0")
    return links.join(peers, ["destination_device", "date"]).select("source_ip", "destination_device", "date", "incidents", "peers")


def related_ip_summary(df: DataFrame) -> DataFrame:
    """Per source: shared (device, day) links and peers met over them."""
    return ip_relationships(df).groupBy("source_ip").agg(
        _n().alias("shared_links"), F.count_distinct("destination_device").alias("shared_devices"), F.sum("peers").alias("peer_meetings"))


RISK_FEATURES = ["incidents", "avg_severity", "success_rate", "event_types"]


def weekly_risk(df: DataFrame) -> DataFrame:
    """Features and risk per source and week, written; takes prepared incidents."""
    weekly = df.where("source_ip is not null and timestamp is not null").groupBy(
        "source_ip", F.date_trunc("week", "timestamp").cast("date").alias("week_start")).agg(
        _n().cast("double").alias("incidents"), F.coalesce(F.avg("severity_score"), F.lit(0.0)).alias("avg_severity"),
        F.avg(F.when(F.col("status") == "Successful", 1.0).otherwise(0.0)).alias("success_rate"),
        F.count_distinct("event_type").cast("double").alias("event_types"), F.coalesce(F.sum("severity_score"), F.lit(0)).cast("double").alias("risk"))
    return materialize(weekly, "weekly")


def with_next_week(weekly: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The weeks that have a successor, with its risk as ``y``, and the newest week."""
    following = weekly.select("source_ip", F.date_sub("week_start", 7).alias("week_start"), F.col("risk").alias("y"))
    last = weekly.agg(F.max("week_start").alias("w")).first()["w"]
    training = weekly.where(F.col("week_start") != F.lit(last)).join(following, ["source_ip", "week_start"], "left").withColumn("y", F.coalesce("y", F.lit(0.0)))
    return training, weekly.where(F.col("week_start") == F.lit(last))


def risk_prediction(df: DataFrame, ridge: float = 0.01) -> DataFrame:
    """Next week's risk per source from this week's features; takes prepared incidents.

    Least squares on standardised features with a small ridge, from one row of
    moments over every week that has a successor, applied to the newest week.
    """
    features = RISK_FEATURES
    training, newest = with_next_week(weekly_risk(df))
    columns = [F.col(c) for c in (*features, "y")]
    row = training.agg(_n(), *[F.avg(x) for x in columns], *[F.avg(x * y) for x in columns for y in columns]).first()
    k = len(columns)
    means, products = np.asarray(row[1 : k + 1], float), np.asarray(row[k + 1 :], float).reshape(k, k)
    weights, centre = np.zeros(k - 1), 0.0
    if row[0]:
        spread = products - np.outer(means, means)
        scale = np.sqrt(np.maximum(np.diag(spread)[:-1], 0))
        scale[scale == 0] = 1
        weights = np.linalg.solve(spread[:-1, :-1] / np.outer(scale, scale) + ridge * np.eye(k - 1), spread[:-1, -1] / scale) / scale
        centre = means[-1] - weights @ means[:-1]
    predicted = sum((F.col(c) * float(w) for c, w in zip(features, weights)), F.lit(float(centre)))
    return newest.select("source_ip", "week_start", "risk", F.greatest(predicted, F.lit(0.0)).alias("predicted_risk"))


def attack_type_correlation(df: DataFrame) -> DataFrame:
    """Pearson r between event types over their counts per source, in long form.

    r comes from the sums, square sums and product sums of the (source, type)
    cells and the number of sources; any number of types will do.  Types that no
    source has in common have the product sum 0.
    """
    known = df.where("source_ip is not null")
    cells = materialize(known.groupBy("source_ip", F.col("event_type").alias("type")).agg(_n().cast("double").alias("n")), "type-cells")
    sources = cells.agg(F.count_distinct("source_ip").cast("double").alias("sources")).scalar()
    cells = cells.where("type is not null")
    sums = materialize(cells.groupBy("type").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q")), "type-sums")
    side = lambda x: cells.select("source_ip", F.col("type").alias(f"type_{x}"), F.col("n").alias(f"n_{x}"))
    products = side("a").join(side("b"), "source_ip").groupBy("type_a", "type_b").agg(F.sum(F.col("n_a") * F.col("n_b")).alias("p"))
    of = lambda x: sums.select(F.col("type").alias(f"type_{x}"), F.col("s").alias(f"s_{x}"), F.col("q").alias(f"q_{x}"))
    # Types x types is the result's own size; the part deals the pairs over the tasks.
    parts = F.explode(F.sequence(F.lit(0), F.lit(_PAIR_PARTS - 1)))
    pairs = of("a").withColumn("part", F.pmod(F.xxhash64("type_a"), F.lit(_PAIR_PARTS)).cast("int")).join(of("b").withColumn("part", parts), "part").drop("part")
    whole = pairs.join(products, ["type_a", "type_b"], "left").withColumn("p", F.coalesce("p", F.lit(0.0))).withColumn("_m", sources)
    spread = lambda x: F.col("_m") * F.col(f"q_{x}") - F.col(f"s_{x}") * F.col(f"s_{x}")
    r = (F.col("_m") * F.col("p") - F.col("s_a") * F.col("s_b")) / F.sqrt(F.nullif(spread("a") * spread("b"), F.lit(0.0)))
    return whole.select("type_a", "type_b", r.alias("r"))


def alert_anomalies(anomalies: DataFrame) -> DataFrame:
    """Sources whose anomaly level is not Normal."""
    return anomalies.where(F.col("anomaly_level") != "Normal")


def treat_outliers(df: DataFrame, cols: Sequence[str], lower: float = 0.05, upper: float = 0.95) -> DataFrame:
    """Clip each column to its exact quantile fences."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    fences = exact_quantiles(df.select(F.inline(F.array(*pairs))), "value", {"lo": lower, "hi": upper}, by=["column"])
    # One row per column, turned into one struct of fences.
    of = lambda c, f: F.max(F.when(F.col("column") == c, F.col(f)))
    row = fences.agg(F.struct(*[of(c, f).alias(f"{f}_{c}") for c in cols for f in ("lo", "hi")]).alias("f")).scalar()
    clip = lambda c: F.greatest(F.least(F.col(c).cast("double"), F.col(f"_f.hi_{c}")), F.col(f"_f.lo_{c}"))
    return df.withColumn("_f", row).withColumns({c + "_treated": F.when(F.col(c).isNotNull(), clip(c)) for c in cols}).drop("_f")


def risk_vs_frequency(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Ensemble score beside the incident count of each source."""
    counts = df.where("source_ip is not null").groupBy("source_ip").agg(_n().alias("incident_count"))
    return counts.join(profile.select("source_ip", "ensemble_risk_score", "final_risk_level"), "source_ip", "left")


def slice_events(df: DataFrame, start: date | None = None, end: date | None = None,
                 locations: Sequence[str] = (), types: Sequence[str] = ()) -> DataFrame:
    """Date, location and type slicers; the date bounds stay plain comparisons so that they reach the scan."""
    out = df
    if start:
        out = out.where(F.col("timestamp") >= F.lit(f"{start} 00:00:00").cast("timestamp_ntz"))
    if end:
        out = out.where(F.col("timestamp") < F.lit(f"{end} 00:00:00").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    if locations:
        out = out.where(F.col("location").isin(list(locations)))
    if types:
        out = out.where(F.col("event_type").isin(list(types)))
    return out


def ip_detail(df: DataFrame, scores: DataFrame, ip: Column | str) -> DataFrame:
    """Drill-through: the incidents of one address beside its scores."""
    wanted = F.lit(ip) if isinstance(ip, str) else ip
    events = df.where(F.col("source_ip") == wanted)
    return events.join(scores, "source_ip", "left")
