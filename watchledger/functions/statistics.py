"""Statistical expressions and small table transforms shared by the operators.

Global statistics enter a row-level plan as one-row scalar subqueries, so no
join and no cross product is planned for them.
"""

from __future__ import annotations

import math
from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F


def safe_corr(x: Column, y: Column, window: WindowSpec | None = None) -> Column:
    """Pearson correlation, null instead of an error when one side is constant."""
    over = (lambda c: c.over(window)) if window is not None else (lambda c: c)
    return F.try_divide(over(F.covar_pop(x, y)), over(F.stddev_pop(x)) * over(F.stddev_pop(y)))


def round_even(value: Column, places: int) -> Column:
    """Scale, round half to even, scale back: the floating-point rounding of the scores.

    ``bround`` rounds the decimal text of the double instead and differs on ties such as 55 * 2.473.
    """
    scale = F.lit(float(10 ** places))
    return F.rint(value * scale) / scale


def stats_of(df: DataFrame, **aggregates: Column) -> Column:
    """All aggregates of ``df`` as one struct-valued scalar subquery."""
    return df.agg(F.struct(*[c.alias(name) for name, c in aggregates.items()]).alias("stats")).scalar()


def _ranges(df: DataFrame, cols: Sequence[str]) -> Column:
    wanted = {f"{fn}_{c}": getattr(F, fn)(c) for c in cols for fn in ("min", "max")}
    return stats_of(df, **wanted)


def minmax(df: DataFrame, cols: Sequence[str], suffix: str = "_norm", bounds_from: DataFrame | None = None) -> DataFrame:
    """``(x - min) / (max - min)``; a constant column gives 0, nulls stay null.

    ``bounds_from`` may name a cheaper table with the same minima and maxima.
    """
    bounds = F.col("_bounds")

    def scaled(c: str) -> Column:
        lo, hi = bounds[f"min_{c}"].cast("double"), bounds[f"max_{c}"].cast("double")
        width = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
        return (F.col(c) - lo) / width

    with_bounds = df.withColumn("_bounds", _ranges(df if bounds_from is None else bounds_from, cols))
    return with_bounds.withColumns({c + suffix: scaled(c) for c in cols}).drop("_bounds")


def standard_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """``(x - mean) / population std``; zero std divides by 1."""
    wanted = {f"{name}_{c}": fn(c) for c in cols for name, fn in (("avg", F.avg), ("std", F.stddev_pop))}
    moments = F.col("_moments")

    def scaled(c: str) -> Column:
        std = moments[f"std_{c}"]
        return (F.col(c) - moments[f"avg_{c}"]) / F.when(std == 0, F.lit(1.0)).otherwise(std)

    with_moments = df.withColumn("_moments", stats_of(df, **wanted))
    return with_moments.withColumns({c + suffix: scaled(c) for c in cols}).drop("_moments")


def abs_zscore(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Largest and mean absolute z-score over the columns."""
    scaled = standard_scale(df, cols, "_z_tmp")
    z = [F.abs(F.col(c + "_z_tmp")) for c in cols]
    top = F.greatest(*z) if len(z) > 1 else z[0]
    return scaled.withColumns({
        "z_score_max": top, "z_score_avg": reduce(lambda a, b: a + b, z) / len(z),
    }).drop(*[c + "_z_tmp" for c in cols])


def any_z_gt(df: DataFrame, cols: Sequence[str], limit: float = 3.0, flag: str = "zscore_anomaly") -> DataFrame:
    """1 when any absolute z-score exceeds the limit."""
    scaled = standard_scale(df, cols, "_z_tmp")
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.abs(F.col(c + "_z_tmp")) > limit, F.lit(False)) for c in cols])
    return scaled.withColumn(flag, hit.cast("int")).drop(*[c + "_z_tmp" for c in cols])


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins between minimum and maximum, last bin closed; empty bins kept."""
    value, bounds = F.col(col).cast("double"), F.col("_bounds")
    lo, hi = bounds[f"min_{col}"].cast("double"), bounds[f"max_{col}"].cast("double")
    width = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
    bucket = F.least(F.floor((value - lo) / width * bins), F.lit(bins - 1)).cast("int")
    counts = (
        df.where(value.isNotNull()).withColumn("_bounds", _ranges(df, [col]))
        .groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("_bounds", _ranges(df, [col]))
    return (
        frame.join(F.broadcast(counts), "bin", "left")  # at most `bins` rows
        .select("bin", (lo + F.col("bin") * width / bins).alias("lower"), (lo + (F.col("bin") + 1) * width / bins).alias("upper"),
                F.coalesce("count", F.lit(0)).alias("count"))
    )


def t_test_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation, from the finite series of Student's t.

    The series has about n/2 terms with n the number of *days*; it is evaluated
    once, on the result row.
    """
    nu = (n - 2).cast("double")
    t = F.abs(r) * F.sqrt(F.try_divide(nu, (1 - r) * (1 + r)))
    theta = F.atan(t / F.sqrt(nu))
    sin, cos2 = F.sin(theta), F.pow(F.cos(theta), 2)
    odd = (n % 2) == 1
    # term_k = term_{k-1} * ratio_k * cos^2; ratio (2k-1)/(2k) for even, (2k)/(2k+1) for odd degrees.
    start = F.when(odd, F.cos(theta)).otherwise(F.lit(1.0))
    last = F.greatest(F.floor((n - 2) / 2) - 1, F.lit(0)).cast("int")

    def step(acc: Column, k: Column) -> Column:
        shift = F.when(odd, 2 * k / (2 * k + 1)).otherwise((2 * k - 1) / (2 * k))
        term = acc["term"] * shift * cos2
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    series = F.aggregate(steps, F.struct(start.alias("term"), start.alias("total")), step, lambda acc: acc["total"])
    inside = F.when(n == 3, 2 * theta / math.pi).when(odd, 2 / math.pi * (theta + sin * series)).otherwise(sin * series)
    return F.when((n > 2) & (F.abs(r) < 1), F.greatest(1 - inside, F.lit(0.0))).when((n > 2) & (F.abs(r) >= 1), F.lit(0.0))
