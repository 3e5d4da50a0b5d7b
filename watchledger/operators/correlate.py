"""Joining incidents with logins and with score tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchledger.functions.cleaning import is_business_hours
from watchledger.workspace import materialize, new_path

HOT_ROWS = 1_000_000


def _prefixed(df: DataFrame, prefix: str, keep: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(keep.get(c, prefix + c)) for c in df.columns])


def _reach(logins: DataFrame, width: int) -> DataFrame:
    """Per (address, bucket): which logins of this and the neighbouring buckets an incident may reach.

    Bucket and window are equally long, so a login in the incident's own bucket
    always matches; from the bucket before only the last login matters, from the
    bucket after only the first.  Three numbers decide about any incident.
    """
    spans = logins.where("source_ip is not null and login_time is not null").groupBy("source_ip", _bucket("login_time", width).alias("own")).agg(
        F.min("login_time").alias("first"), F.max("login_time").alias("last"), F.count(F.lit(1)).alias("n"))
    offers = F.array(*[F.struct((F.col("own") + step).alias("_bucket"), F.lit(step).alias("step")) for step in (-1, 0, 1)])
    at = lambda step, value: F.when(F.col("step") == step, value)
    return spans.select("source_ip", "first", "last", "n", F.inline(offers)).groupBy("source_ip", "_bucket").agg(
        F.max(at(0, F.col("last"))).alias("_same"), F.max(at(1, F.col("last"))).alias("_before"),
        F.min(at(-1, F.col("first"))).alias("_after"), F.sum("n").alias("_logins"))


def _bucket(ts: str, width: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / width)


def correlate(incidents: DataFrame, logins: DataFrame, minutes: int = 60, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every incident with all logins of the same address within the window, both ends included.

    Incidents without a login stay once.  Time is cut into buckets as long as the
    window, so the range join becomes an equi-join on (address, bucket): an
    incident has one bucket, a login is offered to its own and both neighbours.

    * Whether an incident matches at all is read from ``_reach`` (one row per
      address and bucket), so both sides of a crowded bucket can be cut without
      losing or repeating incidents that have no login.
    * A bucket with more than ``hot_rows`` incidents or logins is cut into slices
      on both sides; each pair still meets in exactly one slice.
    """
    width = minutes * 60 * 1_000_000
    keys = ["source_ip", "_bucket"]
    # Duplicate pairs can only come from duplicate inputs.
    incidents, logins = materialize(incidents.dropDuplicates(), "incidents"), materialize(logins.dropDuplicates(), "logins")
    left = _prefixed(incidents, "incident_", {"source_ip": "source_ip"})
    right = _prefixed(logins, "login_", {"ip_address": "source_ip", "login_time": "login_time"})
    left_columns, right_columns = left.columns, [c for c in right.columns if c != "source_ip"]

    # Incidents without an address or a time match nothing and stay out of the joins.
    nowhere = left.where("source_ip is null or incident_timestamp is null")
    left = left.where("source_ip is not null and incident_timestamp is not null")
    reach = materialize(_reach(logins.select(F.col("ip_address").alias("source_ip"), "login_time"), width), "reach")
    window = F.expr(f"INTERVAL {minutes} MINUTES")
    t = F.col("incident_timestamp")
    reached = F.col("_same").isNotNull() | (F.col("_before") >= t - window) | (F.col("_after") <= t + window)
    flagged = left.withColumn("_bucket", _bucket("incident_timestamp", width)).join(reach.drop("_logins"), keys, "left").select(
        *left_columns, "_bucket", F.coalesce(reached, F.lit(False)).alias("_reached"))

    # At most (rows / hot_rows) buckets are hot, so this table stays small.
    crowd = incidents.groupBy("source_ip", _bucket("timestamp", width).alias("_bucket")).agg(F.count(F.lit(1)).alias("_incidents"))
    hot = crowd.join(reach.select(*keys, "_logins"), keys).select(
        *keys, F.ceil(F.col("_incidents") / hot_rows).cast("int").alias("_rows"), F.ceil(F.col("_logins") / hot_rows).cast("int").alias("_cols"),
    ).where("_rows > 1 or _cols > 1")
    hot = materialize(hot, "hot-buckets")

    def sliced(df: DataFrame, own: str, own_id: Column, other: str, repeat: Column) -> DataFrame:
        """A row gets one slice of its own side and is repeated over the slices of the other side."""
        place = F.pmod(own_id, F.coalesce(own, F.lit(1))).cast("int").alias("_own")
        copies = F.when(repeat, F.coalesce(other, F.lit(1))).otherwise(1)
        placed = df.join(hot, keys, "left").select(*df.columns, place, F.explode(F.sequence(F.lit(0), copies - 1)).alias("_other"))
        return placed.withColumnsRenamed({"_own": own + "_slice", "_other": other + "_slice"})

    own = _bucket("login_time", width)
    offered = right.where("source_ip is not null and login_time is not null").withColumn("_bucket", F.explode(F.array(own - 1, own, own + 1)))
    inc = sliced(flagged, "_rows", F.xxhash64("incident_event_id", "incident_timestamp"), "_cols", F.col("_reached")).alias("i")
    log = sliced(offered, "_cols", F.xxhash64("login_login_id", "login_time"), "_rows", F.lit(True)).withColumn("_hit", F.lit(True)).alias("l")
    same = [F.col(f"i.{k}") == F.col(f"l.{k}") for k in (*keys, "_rows_slice", "_cols_slice")]
    near = (F.col("l.login_time") >= t - window) & (F.col("l.login_time") <= t + window)
    joined = inc.join(log, reduce(lambda a, b: a & b, same) & near & F.col("_reached"), "left")
    # A reached incident has its logins in some slices; its empty slices are no result.
    met = joined.where(F.col("_hit") | ~F.col("_reached")).select(*[F.col(f"i.{c}") for c in left_columns], *[F.col(f"l.{c}") for c in right_columns])
    return met.unionByName(nowhere.select(*left_columns), allowMissingColumns=True)


def publish_pairs(incidents: DataFrame, logins: DataFrame, name: str, minutes: int = 60, buckets: int = 64) -> None:
    """Writes both sides as tables ``{name}_incidents`` and ``{name}_logins``, bucketed and sorted by (address, time bucket).

    They are shuffled once, here; every later ``correlate_published`` reads them
    without an exchange.  A login is stored for its own time bucket and both
    neighbours.  Incidents that match nothing (no address or time) go to
    ``{name}_nowhere``, so that no bucket file gathers them.  An address's time bucket
    is the smallest unit that one task joins; for crowded ones use ``correlate``.
    """
    width, keys = minutes * 60 * 1_000_000, ["source_ip", "_bucket"]
    left = _prefixed(incidents.dropDuplicates(), "incident_", {"source_ip": "source_ip"})
    right = _prefixed(logins.dropDuplicates(), "login_", {"ip_address": "source_ip", "login_time": "login_time"})
    own = _bucket("login_time", width)
    known = F.col("source_ip").isNotNull() & F.col("incident_timestamp").isNotNull()
    tables = {
        "incidents": left.where(known).withColumn("_bucket", _bucket("incident_timestamp", width)),
        "logins": right.where("source_ip is not null and login_time is not null").withColumn("_bucket", F.explode(F.array(own - 1, own, own + 1)))}
    for part, df in tables.items():
        dealt = df.repartition(buckets, *keys)  # one file a bucket
        dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", new_path(df.sparkSession, f"pairs-{part}")).saveAsTable(f"{name}_{part}")
    left.where(~known).write.mode("overwrite").option("path", new_path(left.sparkSession, "pairs-nowhere")).saveAsTable(f"{name}_nowhere")


def correlate_published(spark: SparkSession, name: str, minutes: int = 60) -> DataFrame:
    """``correlate`` from the tables that ``publish_pairs`` wrote with the same ``minutes``: a merge join of bucket files."""
    left, right = spark.table(f"{name}_incidents"), spark.table(f"{name}_logins")
    window = F.expr(f"INTERVAL {minutes} MINUTES")
    t, at = F.col("i.incident_timestamp"), F.col("l.login_time")
    near = (F.col("i.source_ip") == F.col("l.source_ip")) & (F.col("i._bucket") == F.col("l._bucket")) & (at >= t - window) & (at <= t + window)
    columns = [c for c in left.columns if c != "_bucket"]
    joined = left.alias("i").join(right.hint("merge").alias("l"), near, "left").select(
        *[F.col(f"i.{c}") for c in columns], *[F.col(f"l.{c}") for c in right.columns if c not in ("source_ip", "_bucket")])
    return joined.unionByName(spark.table(f"{name}_nowhere").select(*columns), allowMissingColumns=True)


def correlate_features(merged: DataFrame) -> DataFrame:
    """Combined risk, hours and business-hour flags; takes cleaned, correlated rows."""
    failed = F.when(F.col("login_success"), 0).when(~F.col("login_success"), 1).otherwise(0)
    return merged.withColumns({
        "combined_risk_score": (F.coalesce("incident_severity_score", F.lit(0)) + failed * 2).cast("double"),
        "incident_hour": F.hour("incident_timestamp"),
        "incident_is_business_hours": is_business_hours(F.col("incident_timestamp")),
        "login_hour": F.hour("login_time"),
        "login_is_business_hours": F.coalesce(is_business_hours(F.col("login_time")), F.lit(False)),
    })


def join_scores(basic: DataFrame, *others: DataFrame, key: str = "source_ip") -> DataFrame:
    """Left joins of score tables on one key."""
    return reduce(lambda left, right: left.join(right, key, "left"), others, basic)


def map_lookup(df: DataFrame, lookup: DataFrame, key: str, spread_by: str = "event_id") -> DataFrame:
    """Attach per-key values to every row.

    The lookup is written first: the planner then broadcasts it if its files are
    small and sort-merge joins it (with adaptive skew splitting) if they are not.
    Null keys match nothing; a salt deals them over all tasks.
    """
    known = lookup.where(F.col(key).isNotNull()).withColumn("_salt", F.lit(0).cast("long"))
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(1 << 16)) + 1).otherwise(0).cast("long")
    return df.withColumn("_salt", salt).join(materialize(known, "lookup"), [key, "_salt"], "left").drop("_salt")


def incidents_with_profile(incidents: DataFrame, profile: DataFrame) -> DataFrame:
    return map_lookup(incidents, profile, "source_ip")


def incidents_logins_by_ip(incidents: DataFrame, logins: DataFrame, how: str = "semi") -> DataFrame:
    """Incidents of addresses that also log in (``semi``) or never do (``anti``)."""
    addresses = logins.where("ip_address is not null").select(F.col("ip_address").alias("source_ip")).distinct()
    return incidents.join(addresses, "source_ip", {"semi": "left_semi", "anti": "left_anti"}[how])


def ip_overlap(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    """Per address: rows on both sides of the relationship and which sides exist."""
    left = incidents.where("source_ip is not null").groupBy("source_ip").agg(F.count(F.lit(1)).alias("incidents"))
    right = logins.where("ip_address is not null").groupBy(F.col("ip_address").alias("source_ip")).agg(F.count(F.lit(1)).alias("logins"))
    side = F.when(F.col("incidents").isNull(), "logins only").when(F.col("logins").isNull(), "incidents only").otherwise("both")
    return left.join(right, "source_ip", "full_outer").select(
        "source_ip", F.coalesce("incidents", F.lit(0)).alias("incidents"), F.coalesce("logins", F.lit(0)).alias("logins"), side.alias("seen_on"))
