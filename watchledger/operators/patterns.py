"""Attack sequences, behaviour clusters, rapid campaigns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.functions.cleaning import is_business_hours_weekday
from watchledger.functions.statistics import round_even, standard_scale
from watchledger.operators.ordering import exact_quantiles, running_total, top_k
from watchledger.workspace import materialize

ARROW = " → "
SEGMENT = 4096
CLUSTER_FEATURES = ["total_events", "unique_event_types", "activity_span_hours", "location_diversity"]


def _seconds(first: Column, last: Column) -> Column:
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    return (micros(last) - micros(first)) / 1e6


def modal_severity(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Most frequent severity per key, the smallest on ties; counts shrink first."""
    counts = df.where("severity is not null").groupBy(*key, "severity").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*key).agg(F.min_by("severity", F.struct(-F.col("n"), F.col("severity"))).alias("severity"))


def sequence_segments(df: DataFrame, key: Sequence[str] = ("source_ip",), segment_size: int = SEGMENT) -> DataFrame:
    """The time-ordered event types of each key, as text segments of ``segment_size`` events.

    A sequence of any length is kept whole: positions come from a range-sliced
    running total, so no task ever holds all events of a hot key.
    """
    key = list(key)
    rows = df.where(F.col(key[0]).isNotNull()).select(*key, "timestamp", "event_id", "event_type")
    placed = running_total(rows, ["timestamp", "event_id"], F.lit(1), by=key, out="position")
    in_order = F.array_sort(F.collect_list(F.struct("position", "event_type")))
    segment = F.floor((F.col("position") - 1) / segment_size).cast("int").alias("segment")
    return placed.groupBy(*key, segment).agg(F.array_join(F.transform(in_order, lambda s: s["event_type"]), ARROW).alias("sequence"))


def _spans(df: DataFrame, key: Sequence[str], min_events: int, counted: str = "events") -> DataFrame:
    """Counts, span, first event and modal severity per key, all from (key, severity) cells of one scan."""
    cells = df.where(F.col(key[0]).isNotNull()).groupBy(*key, "severity").agg(
        F.count(F.lit(1)).alias("n"), F.count("timestamp").alias("timed"), F.max("timestamp").alias("last_at"),
        F.min(F.when(F.col("timestamp").isNotNull(), F.struct("timestamp", "event_id"))).alias("first_event"))
    known = F.when(F.col("severity").isNotNull(), F.struct(-F.col("n"), F.col("severity")))
    spans = cells.groupBy(*key).agg(
        F.sum("n").alias("events"), F.sum("timed").alias("timed"), F.min("first_event").alias("first_event"), F.max("last_at").alias("last_at"),
        F.min_by("severity", known).alias("severity")).where(F.col(counted) >= min_events)
    return spans.withColumn("span_hours", _seconds(F.col("first_event.timestamp"), F.col("last_at")) / 3600)


def ip_sequences(df: DataFrame, min_events: int = 3, key: Sequence[str] = ("source_ip",), segment_size: int = SEGMENT) -> DataFrame:
    key = list(key)
    spans = _spans(df, key, min_events).select(*key, "events", "severity", "span_hours")
    return sequence_segments(df, key, segment_size).join(spans, key).select(*key, "segment", "sequence", "events", "severity", "span_hours")


def common_sequences(df: DataFrame, n: int = 10, min_events: int = 3, key: Sequence[str] = ("source_ip",), segment_size: int = SEGMENT) -> DataFrame:
    """Identical whole sequences grouped, most frequent first.

    Sequences are compared by the sum of SHA-256 limbs of their numbered
    segments, which adds up map-side for any length; the text is attached only
    to the reported ones.  ``first_span_hours`` is the span of the first key
    seen, ``avg_span_hours`` the true mean.
    """
    key = list(key)
    segments = materialize(sequence_segments(df, key, segment_size), "segments")
    digest = F.sha2(F.concat_ws("|", F.col("segment").cast("string"), F.col("sequence")), 256)
    limb = lambda start: F.sum(F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)"))
    prints = segments.groupBy(*key).agg(limb(1).alias("p1"), limb(16).alias("p2"), limb(31).alias("p3"))
    keyed = prints.join(_spans(df, key, min_events), key)
    order = F.col("first_event")
    groups = keyed.groupBy("p1", "p2", "p3", "events").agg(
        F.count(F.lit(1)).alias("occurrences"), F.min("first_event").alias("first_event"),
        F.min_by(F.struct(*key), order).alias("first_key"), F.min_by("span_hours", order).alias("first_span_hours"),
        F.avg("span_hours").alias("avg_span_hours"),
    )
    best = top_k(groups, n, F.desc("occurrences"), F.col("first_event")).select(
        *[F.col(f"first_key.{k}").alias(k) for k in key], "occurrences", "events", "first_span_hours", "avg_span_hours")
    return segments.join(F.broadcast(best), key)  # n rows


def frequent_sequences(df: DataFrame, min_share: float = 0.1, max_length: int | None = None, max_gap_hours: float | None = None, key: str = "source_ip") -> DataFrame:
    """Runs of consecutive event types that at least ``min_share`` of the sources share, mined level by level.

    An occurrence is (pattern, source, position of its last event).  A level joins
    the occurrences of the frequent patterns with the event at the next position and
    counts (pattern, next type, source) map-side; what falls below the limit cannot
    become frequent again and is dropped.  Positions come from range slices and the
    join key is (source, position), so a hot source is spread over all tasks; every
    level is a written table.  Levels end when no pattern is left (or at
    ``max_length``).  With ``max_gap_hours`` consecutive events of a pattern lie at
    most so far apart.

    Rows: sequence, length, sources, occurrences, and whether the sequence is closed:
    no listed sequence that is one event longer and contains it has as many sources.
    """
    columns = [key, "timestamp", "event_id", "event_type"]
    rows = df.where(F.col(key).isNotNull() & F.col("event_type").isNotNull()).select(*columns)
    placed = running_total(rows, ["timestamp", "event_id"], F.lit(1), by=[key], out="position")
    placed = materialize(placed.select(F.col(key).alias("source"), "position", "timestamp", F.col("event_type").alias("type")), "placed")
    least = placed.agg(F.ceil(F.count_distinct("source") * F.lit(min_share)).cast("long")).first()[0]

    def frequent(found: DataFrame, by: list[str]) -> DataFrame:
        per_source = found.groupBy(*by, "source").agg(F.count(F.lit(1)).alias("n"))
        counted = per_source.groupBy(*by).agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("occurrences"))
        return counted.where(F.col("sources") >= F.greatest(F.lit(least), F.lit(1)))

    follower = placed.select("source", F.col("position").alias("at"), F.col("timestamp").alias("next_time"), "type")
    near = F.lit(True) if max_gap_hours is None else _seconds(F.col("timestamp"), F.col("next_time")) <= max_gap_hours * 3600
    known: DataFrame | None = None
    found, length = placed.withColumn("pattern", F.lit(0).cast("long")), 1
    levels = []
    while True:
        numbered = frequent(found, ["pattern", "type"]).withColumn("next", F.monotonically_increasing_id())
        numbered = materialize(numbered, "patterns")
        if numbered.isEmpty():
            break
        items = F.array("type") if known is None else F.concat("items", F.array("type"))
        listed = numbered if known is None else numbered.join(known.select(F.col("next").alias("pattern"), "items"), "pattern")
        known = materialize(listed.select("next", items.alias("items"), "sources", "occurrences"), "listed")
        levels.append(known.select("items", F.lit(length).alias("length"), "sources", "occurrences"))
        if length == max_length:
            break
        kept = found.join(numbered.select("pattern", "type", "next"), ["pattern", "type"])
        kept = kept.select(F.col("next").alias("pattern"), "source", (F.col("position") + 1).alias("at"), "timestamp")
        longer = kept.join(follower, ["source", "at"]).where(near)
        found = materialize(longer.select("pattern", "source", F.col("at").alias("position"), F.col("next_time").alias("timestamp"), "type"), "occurrences")
        length += 1
    if not levels:
        return placed.limit(0).select(F.lit("").alias("sequence"), F.lit(0).alias("length"), F.lit(0).cast("long").alias("sources"), F.lit(0).cast("long").alias("occurrences"), F.lit(True).alias("closed"))
    listed = reduce(DataFrame.unionAll, levels)
    inner = lambda start: listed.where("length > 1").select(F.slice("items", start, F.col("length") - 1).alias("items"), "sources")
    contained = inner(F.lit(1)).unionAll(inner(F.lit(2))).groupBy("items").agg(F.max("sources").alias("longer"))
    return listed.join(contained, "items", "left").select(
        F.array_join("items", ARROW).alias("sequence"), "length", "sources", "occurrences", (F.coalesce("longer", F.lit(0)) < F.col("sources")).alias("closed"))


def ip_behavior(df: DataFrame) -> DataFrame:
    """Per-source behaviour from (type, location, hour) cells; takes prepared incidents."""
    key = ["source_ip"]
    cells = df.where("source_ip is not null").groupBy("source_ip", "event_type", "location", "hour").agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    n, h = F.sum(F.when(F.col("hour").isNotNull(), F.col("rows"))), F.col("hour")
    squares, total = F.sum(F.col("rows") * h * h).cast("double"), F.sum(F.col("rows") * h).cast("double")
    spread = F.sqrt(F.try_divide(F.greatest(squares - F.try_divide(total * total, n.cast("double")), F.lit(0.0)), (n - 1).cast("double")))
    profile = cells.groupBy("source_ip").agg(
        F.sum("rows").alias("total_events"), F.count_distinct("event_type").alias("unique_event_types"),
        spread.alias("timing_variability"), (_seconds(F.min("first"), F.max("last")) / 3600).alias("activity_span_hours"),
        F.count_distinct("location").alias("location_diversity"),
    )
    return profile.join(modal_severity(df, key).withColumnRenamed("severity", "primary_severity"), key, "left")


#: Scaled features are whole numbers of this unit, so that sums do not depend on their order.
POINT_UNIT = 1e-6


def _start_points(points: DataFrame, key: str, dims: Sequence[str], k: int, restarts: int) -> list[tuple]:
    """Per restart the ``k`` points with the least md5 of restart and key; every task keeps its own ``k`` first."""
    dealt = points.withColumn("restart", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))))
    order = Window.partitionBy("restart").orderBy(F.md5(F.concat_ws(":", F.col("restart").cast("string"), key)), key)
    rows = dealt.withColumn("centre", F.row_number().over(order)).where(F.col("centre") <= k).select("restart", (F.col("centre") - 1).alias("centre"), *dims).collect()
    return sorted(tuple(r) for r in rows)  # restarts x k rows


def _nearest(centres: Sequence[tuple], dims: Sequence[str]) -> Column:
    """(squared distance in units, centre) of the nearest centre; ties go to the lower number."""
    distance = lambda c: reduce(lambda a, b: a + b, [(F.col(d) - F.lit(float(x))) * (F.col(d) - F.lit(float(x))) for d, x in zip(dims, c[2:])]) * POINT_UNIT
    return F.array_min(F.array(*[F.struct(distance(c).alias("d"), F.lit(c[1]).alias("centre")) for c in centres]))


def _centre_moments(points: DataFrame, dims: Sequence[str], centres: list[tuple]) -> dict[tuple[int, int], tuple]:
    """(restart, centre) -> points, sum of distances, sums of the features: every task adds up its points for all restarts, then the tasks' sums are added."""
    groups = [(r, np.array([c[2:] for c in centres if c[0] == r], float)) for r in sorted({c[0] for c in centres})]
    names = ["restart", "centre", "n", "cost", *dims]

    def add_up(batches):
        sums = [np.zeros((len(at), len(names) - 2), np.int64) for _, at in groups]
        for batch in batches:
            x = np.stack([batch.column(d).to_numpy() for d in dims], axis=1)
            for (_, at), total in zip(groups, sums):
                distance = np.zeros((len(x), len(at)))
                for i in range(len(dims)):
                    distance += (x[:, i, None] - at[None, :, i]) ** 2
                distance *= POINT_UNIT
                near = distance.argmin(axis=1)  # ties go to the lower number
                np.add.at(total[:, 0], near, 1)
                np.add.at(total[:, 1], near, np.floor(distance[np.arange(len(x)), near]).astype(np.int64))
                np.add.at(total[:, 2:], near, x)
        rows = [(r, c, *total[c].tolist()) for (r, at), total in zip(groups, sums) for c in range(len(at)) if total[c, 0]]
        yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], pa.int64()) for i in range(len(names))], names)

    parts = points.select(*dims).mapInArrow(add_up, ", ".join(f"{n} long" for n in names))
    rows = parts.groupBy("restart", "centre").agg(*[F.sum(n).alias(n) for n in names[2:]]).collect()
    return {(r["restart"], r["centre"]): tuple(r)[2:] for r in rows}  # restarts x k rows


def lloyd_centres(points: DataFrame, key: str, dims: Sequence[str], k: int, restarts: int, rounds: int) -> list[tuple]:
    """Centres (restart, number, coordinates) of the restart with the least summed distance, ties to the first.

    Every round is one aggregate of moments over the points for all restarts, added up
    task by task; the centres (``restarts`` x ``k``) travel with the function.  Rounds end when no
    centre moves, or after ``rounds``.  A centre without points stays where it is.
    """
    centres = _start_points(points, key, dims, k, restarts)
    for _ in range(rounds):
        found = _centre_moments(points, dims, centres)
        moved = [(r, c, *([x / found[r, c][0] for x in found[r, c][2:]] if (r, c) in found else at)) for r, c, *at in centres]
        if moved == centres:
            break
        centres = moved
    found = _centre_moments(points, dims, centres)
    cost = {r: sum(v[1] for (x, _), v in found.items() if x == r) for r in {c[0] for c in centres}}
    best = min(cost, key=lambda r: (cost[r], r))
    return [c for c in centres if c[0] == best]


def behavior_clusters(df: DataFrame, k: int = 4, min_events: int = 3, restarts: int = 10, rounds: int = 40) -> DataFrame:
    """k-means on four scaled features of the active sources; no cluster with fewer than five sources.

    Start points come from md5 of the source and sums are of whole units, so any
    engine and partitioning gives the same clusters.
    """
    active = materialize(ip_behavior(df).where(F.col("total_events") >= min_events), "behavior")
    sources = active.count()
    if sources < 5:
        return active.withColumn("behavior_cluster", F.lit(None).cast("int"))
    scaled = standard_scale(active.na.fill(0, CLUSTER_FEATURES), CLUSTER_FEATURES)
    dims = [f"x{i}" for i in range(len(CLUSTER_FEATURES))]
    units = {d: F.round(F.col(c + "_z") / POINT_UNIT).cast("long") for d, c in zip(dims, CLUSTER_FEATURES)}
    points = materialize(scaled.withColumns(units).select("source_ip", *dims), "points")
    centres = lloyd_centres(points, "source_ip", dims, min(k, sources), restarts, rounds)
    placed = points.select("source_ip", _nearest(centres, dims)["centre"].alias("behavior_cluster"))
    return active.join(placed, "source_ip")


def cluster_summary(clustered: DataFrame) -> DataFrame:
    severity = modal_severity(clustered.withColumnRenamed("primary_severity", "severity"), ["behavior_cluster"])
    return clustered.groupBy("behavior_cluster").agg(
        F.count(F.lit(1)).alias("sources"), round_even(F.avg("total_events"), 2).alias("avg_events"),
        round_even(F.avg("unique_event_types"), 2).alias("avg_event_types"),
        round_even(F.avg("activity_span_hours"), 2).alias("avg_span_hours"),
    ).join(severity.withColumnRenamed("severity", "primary_severity"), "behavior_cluster", "left")


def hourly_profile(df: DataFrame) -> DataFrame:
    """Counts, mean severity and sources per hour, with the (first) peak hour marked; takes prepared incidents."""
    hours = df.where("hour is not null").groupBy("hour").agg(
        F.count("event_id").alias("incidents"), F.avg("severity_score").alias("avg_severity"), F.count_distinct("source_ip").alias("unique_ips"))
    rank = F.struct(F.col("incidents"), -F.col("hour"))
    return hours.withColumn("is_peak", rank == F.max(rank).over(Window.partitionBy()))  # 24 rows


def business_hours_split(df: DataFrame) -> DataFrame:
    inside = F.when(is_business_hours_weekday(F.col("timestamp")), 100.0).otherwise(0.0)
    return df.agg(F.avg(inside).alias("business_hours_percent"), (100.0 - F.avg(inside)).alias("off_hours_percent"))


def rapid_campaigns(df: DataFrame, min_events: int = 5, max_gap_s: float = 300) -> DataFrame:
    """Sources whose mean gap between events is below the limit.

    The mean of consecutive gaps is (last - first) / (n - 1): no ordering needed.
    """
    spans = _spans(df, ["source_ip"], min_events, counted="timed")
    seconds = _seconds(F.col("first_event.timestamp"), F.col("last_at"))
    return spans.select(
        "source_ip", F.col("timed").alias("total_events"), F.try_divide(seconds, (F.col("timed") - 1).cast("double")).alias("avg_gap_seconds"),
        (seconds / 60).alias("span_minutes"), "severity").where(F.col("avg_gap_seconds") < max_gap_s)


def gap_quantiles(df: DataFrame, min_events: int = 5, probs: dict[str, float] | None = None) -> DataFrame:
    """Exact quantiles of the seconds between a source's consecutive events.

    Events are numbered by range slices and meet their predecessor by number, so
    a busy source is spread over many tasks.
    """
    timed = df.where("source_ip is not null and timestamp is not null").select("source_ip", "timestamp", "event_id")
    ranked = materialize(running_total(timed, ["timestamp", "event_id"], F.lit(1), ["source_ip"], "_rank"), "ranked")
    before = ranked.select("source_ip", (F.col("_rank") + 1).alias("_rank"), F.col("timestamp").alias("_before"))
    gaps = ranked.join(before, ["source_ip", "_rank"]).select("source_ip", _seconds(F.col("_before"), F.col("timestamp")).alias("gap"))
    enough = gaps.groupBy("source_ip").agg(F.count(F.lit(1)).alias("gaps")).where(F.col("gaps") >= min_events - 1)
    quantiles = exact_quantiles(materialize(gaps, "gaps"), "gap", probs or {"q50": 0.5, "q90": 0.9}, by=["source_ip"])
    return enough.join(quantiles, "source_ip")


def top_campaigns(df: DataFrame, n: int = 5, min_events: int = 5, max_gap_s: float = 300) -> DataFrame:
    return top_k(rapid_campaigns(df, min_events, max_gap_s), n, F.desc("total_events"), F.col("source_ip"))
