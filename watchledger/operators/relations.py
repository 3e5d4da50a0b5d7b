"""Groups of sources that act together.

Two sources are related if they attack the same device in the same period; a
group is everything that relations reach.  Groups come from minimum-label
contraction: every node moves to the neighbour (or itself) with the least hashed
label, the links between the moved nodes are the next round's graph.  A round
leaves three quarters of the nodes at most in expectation, on a star as on a chain,
so a few dozen written rounds do for any graph.  Each round is a map-side minimum per
node and two joins; neighbours are never gathered.  On the way back every node
takes the label of the node it moved to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.functions.cleaning import severity_score
from watchledger.workspace import materialize


def device_links(df: DataFrame, grain: str = "day") -> DataFrame:
    """(a, b): every source of a device and period beside the least source of it; as many rows as memberships, never pairs."""
    known = df.where("source_ip is not null and destination_device is not null and timestamp is not null")
    met = known.select("source_ip", "destination_device", F.date_trunc(grain, "timestamp").alias("period")).distinct()
    met = materialize(met, "met")
    hubs = met.groupBy("destination_device", "period").agg(F.min("source_ip").alias("hub"), F.count(F.lit(1)).alias("sources")).where("sources > 1")
    joined = met.join(hubs, ["destination_device", "period"]).where("source_ip != hub")
    return joined.select(F.col("source_ip").alias("a"), F.col("hub").alias("b")).distinct()


def connected_groups(links: DataFrame) -> DataFrame:
    """node and group (the least node it is connected with) for every node of the links (a, b)."""
    edges = materialize(links.where("a != b").select("a", "b").distinct(), "links")
    moves = []
    while not edges.isEmpty():
        label = lambda c: F.struct(F.xxhash64(F.lit(len(moves)), c).alias("h"), F.col(c).alias("at"))  # another order each round
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min(label("b")).alias("seen"))
        moved = materialize(least.select("node", F.least(F.col("seen"), label("node"))["at"].alias("to")), "moves")
        moves.append(moved)
        end = lambda c: moved.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        next_edges = edges.join(end("a"), "a").join(end("b"), "b").where("a_to != b_to")
        edges = materialize(next_edges.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("group"))
    ends = moves[-1].select("node", F.col("to").alias("root"))
    for moved in reversed(moves[:-1]):
        onward = ends.select(F.col("node").alias("to"), "root")
        ends = materialize(moved.join(onward, "to", "left").select("node", F.coalesce("root", "to").alias("root")), "roots")
    names = ends.groupBy("root").agg(F.min("node").alias("group"))
    return ends.join(names, "root").select("node", "group")


def source_groups(df: DataFrame, grain: str = "day") -> DataFrame:
    """source_ip, group_id (the least source of the group) and group_size of every source; a source without relations is a group of one."""
    groups = materialize(connected_groups(device_links(df, grain)), "groups")
    sources = df.where("source_ip is not null").select("source_ip").distinct()
    placed = sources.join(groups.withColumnRenamed("node", "source_ip"), "source_ip", "left").withColumn("group_id", F.coalesce("group", "source_ip"))
    sizes = groups.groupBy(F.col("group").alias("group_id")).agg(F.count(F.lit(1)).alias("group_size"))
    return placed.join(sizes, "group_id", "left").select("source_ip", "group_id", F.coalesce("group_size", F.lit(1)).alias("group_size"))


def source_group_summary(df: DataFrame, grain: str = "day") -> DataFrame:
    """Groups of two sources or more: members, incidents, devices, first and last incident, mean severity."""
    groups = materialize(source_groups(df, grain).where("group_size > 1"), "members")
    cells = df.where("source_ip is not null").groupBy("source_ip", "destination_device").agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
        F.sum(severity_score(F.col("severity"))).alias("severity"), F.count(severity_score(F.col("severity"))).alias("scored"))
    devices = cells.join(groups, "source_ip").groupBy("group_id", "group_size", "destination_device").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("severity").alias("severity"), F.sum("scored").alias("scored"))
    return devices.groupBy("group_id", "group_size").agg(
        F.sum("n").alias("incidents"), F.count("destination_device").alias("devices"), F.min("first").alias("first_seen"), F.max("last").alias("last_seen"),
        F.try_divide(F.sum("severity").cast("double"), F.sum("scored").cast("double")).alias("avg_severity"))
