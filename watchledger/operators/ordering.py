"""Order-dependent building blocks that never put one group into one task.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends a hot key to one task and
a window without keys sends everything there.  Here rows are range-partitioned
on the whole order (a hot key is spread over many slices), summed per slice,
and each slice is offset by the slices before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.workspace import materialize


def running_total(df: DataFrame, order: Sequence[str], weight: Column, by: Sequence[str] = (), out: str = "running") -> DataFrame:
    """Exact running sum of ``weight`` along ``order``, separately for each ``by`` key.

    ``order`` must identify rows within a key.  One task sees one range slice;
    the un-sliced window runs over one row per slice.
    """
    by, order = list(by), list(order)
    ranged = df.withColumn("_weight", weight).repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id())
    # The slice number is only stable once written.
    ranged = materialize(ranged, "slices")
    slices = ranged.groupBy(*by, "_slice").agg(F.sum("_weight").alias("_slice_sum"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(*by, "_slice", F.coalesce(F.sum("_slice_sum").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.withColumn("_within", F.sum("_weight").over(within))
        .join(offsets, [*by, "_slice"])
        .withColumn(out, F.col("_before") + F.col("_within"))
        .drop("_weight", "_slice", "_within", "_before")
    )


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles, one output column per entry of ``probs``.

    Works on value counts, so repeated values shrink before any ordering.
    """
    by = list(by)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(n.alias("_n"))
    ranked = running_total(counts, [value], F.col("_n"), by, "_upto")
    totals = ranked.groupBy(*by).agg(F.max("_upto").alias("_total"))
    if by:
        ranked = ranked.join(totals, by)
    else:
        ranked = ranked.withColumn("_total", totals.scalar())
    last = F.col("_total") - 1

    def at(rank: Column) -> Column:
        holds = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
        return F.max(F.when(holds, F.col(value).cast("double")))

    aggregates = []
    for name, p in probs.items():
        aggregates += [at(F.floor(last * p)).alias(f"_lo_{name}"), at(F.ceil(last * p)).alias(f"_hi_{name}"),
                       F.max(last * p - F.floor(last * p)).alias(f"_part_{name}")]
    picked = ranked.groupBy(*by).agg(*aggregates)
    mix = lambda name: F.col(f"_lo_{name}") + F.col(f"_part_{name}") * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))
    return picked.select(*by, *[mix(name).alias(name) for name in probs])


def trailing_count(df: DataFrame, ts: str, hours: int = 24, out: str = "events") -> DataFrame:
    """Per distinct instant ``t``: events in ``(t - hours, t]`` over the whole table.

    The count is the running total at ``t`` minus the running total at ``t - hours``.
    """
    instants = df.where(F.col(ts).isNotNull()).groupBy(F.col(ts).alias("_instant")).agg(F.count(F.lit(1)).alias("_n"))
    # Marks carry the counts and sort before probes of the same instant.
    marks = F.struct(F.col("_instant").alias("at"), F.lit(0).alias("kind"), F.col("_n").alias("n"))
    probes = F.struct((F.col("_instant") - F.expr(f"INTERVAL {hours} HOURS")).alias("at"), F.lit(1).alias("kind"),
                      F.lit(0).cast("long").alias("n"))
    points = instants.select("_instant", F.explode(F.array(marks, probes)).alias("p")).select("_instant", "p.*")
    totals = running_total(points, ["at", "kind"], F.col("n"))
    signed = F.when(F.col("kind") == 0, F.col("running")).otherwise(-F.col("running"))
    return totals.groupBy(F.col("_instant").alias(ts)).agg(F.sum(signed).alias(out))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Ordered report of ``k`` rows; each task keeps its own best ``k``."""
    return df.orderBy(*order).limit(k)


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """0-based code by sorted distinct value, attached to every row; null values have none and are dealt over all tasks by a salt."""
    values = df.where(F.col(col).isNotNull()).select(col).distinct()
    codes = running_total(values, [col], F.lit(1), out="_code").select(col, (F.col("_code") - 1).cast("int").alias(out))
    codes = materialize(codes.withColumn("_salt", F.lit(0).cast("long")), "codes")
    salt = F.when(F.col(col).isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16)) + 1).otherwise(F.lit(0)).cast("long")
    return df.withColumn("_salt", salt).join(codes, [col, "_salt"], "left").drop("_salt")
