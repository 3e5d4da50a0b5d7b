"""Correlations of the daily series.  All windows run over one row per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.functions.statistics import safe_corr, t_test_p
from watchledger.operators.timeseries import DAILY_METRICS, trailing_week
from watchledger.workspace import materialize

X, Y = "incident_count", "failed_logins"

# The named pairs of the insight report.
KEY_PAIRS = {
    "incident_login_corr": ("incident_count", "total_logins"),
    "incident_failed_corr": ("incident_count", "failed_logins"),
    "severity_success_corr": ("avg_severity", "login_success_rate"),
    "ip_incident_corr": ("unique_ips", "incident_count"),
}


def _corr(a: str, b: str) -> Column:
    return safe_corr(F.col(a), F.col(b))


def correlation_matrix(daily: DataFrame) -> DataFrame:
    """Pearson r for each pair of the seven metrics, one aggregate."""
    pairs = [(a, b) for a in DAILY_METRICS for b in DAILY_METRICS]
    row = daily.agg(*[_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = [F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs]
    return row.select(F.inline(F.array(*entries)))


def key_correlations(daily: DataFrame) -> DataFrame:
    return daily.agg(*[_corr(a, b).alias(name) for name, (a, b) in KEY_PAIRS.items()])


def _test(daily: DataFrame, x: str, y: str) -> DataFrame:
    row = daily.agg(_corr(x, y).alias("r"), F.count(F.lit(1)).alias("n"))
    return row.withColumn("p_value", t_test_p(F.col("r"), F.col("n"))).withColumn("significant", F.col("p_value") < 0.05)


def pearson_test(daily: DataFrame, x: str = X, y: str = Y) -> DataFrame:
    return _test(daily, x, y)


def spearman_test(daily: DataFrame, x: str = X, y: str = Y) -> DataFrame:
    """Pearson of average ranks."""

    def average_rank(c: str) -> Column:
        peers = F.count(F.lit(1)).over(Window.partitionBy(c))
        return F.rank().over(Window.orderBy(c)) + (peers - 1) / 2

    return _test(daily.select(average_rank(x).alias("_rx"), average_rank(y).alias("_ry")), "_rx", "_ry")


def trend_points(daily: DataFrame, points: int = 100) -> DataFrame:
    """Least-squares incidents on failed logins at evenly spaced positions."""
    fit = daily.agg(
        F.count(F.lit(1)).alias("n"), F.min(Y).cast("double").alias("lo"), F.max(Y).cast("double").alias("hi"),
        F.try_divide(F.covar_pop(Y, X), F.var_pop(Y)).alias("slope"), F.avg(X).alias("mx"), F.avg(Y).alias("my"),
    ).where("n > 1")
    at = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / (points - 1)
    return fit.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).select(
        "point", at.alias("x"), (F.col("mx") + F.col("slope") * (at - F.col("my"))).alias("y"))


def severity_vs_success_corr(daily: DataFrame) -> DataFrame:
    valid = daily.dropna(subset=["avg_severity", "login_success_rate"])
    return valid.agg(_corr("avg_severity", "login_success_rate").alias("r"), F.count(F.lit(1)).alias("days"))


def _rolling(daily: DataFrame) -> Column:
    full = F.count(F.lit(1)).over(trailing_week()) == 7
    return F.when(full, safe_corr(F.col(X), F.col(Y), trailing_week()))


def rolling_correlation(daily: DataFrame) -> DataFrame:
    return daily.select("date", _rolling(daily).alias("rolling_corr"))


def cross_correlation(daily: DataFrame, max_lag: int = 10) -> DataFrame:
    """r of incidents against failed logins shifted by each lag."""
    lags = range(-max_lag, max_lag + 1)
    shifted = lambda k: F.lag(Y, k).over(Window.orderBy("date")) if k >= 0 else F.lead(Y, -k).over(Window.orderBy("date"))
    wide = daily.select(X, *[shifted(k).alias(f"y{k}") for k in lags])
    # Only complete pairs count, on both sides of the formula.
    paired = lambda k: safe_corr(F.when(F.col(f"`y{k}`").isNotNull(), F.col(X)), F.col(f"`y{k}`"))
    row = wide.agg(F.count(F.lit(1)).alias("n"), *[paired(k).alias(f"c{k}") for k in lags])
    entries = [F.struct(F.lit(k).alias("lag"), F.col(f"`c{k}`").alias("r"), F.col("n").alias("n")) for k in lags]
    return row.select(F.inline(F.array(*entries))).where(F.abs("lag") <= F.col("n") - 1).select("lag", "r")


def correlation_insights(daily: DataFrame) -> DataFrame:
    """Key pairs, mean rolling r, largest cross-correlation and its smallest lag."""
    daily = materialize(daily, "daily")  # one row per day, read by three aggregates
    cross = cross_correlation(daily).where("r is not null")
    best = F.max_by(F.struct("r", "lag"), F.struct(F.col("r").alias("r"), (-F.col("lag")).alias("lag")))
    row = key_correlations(daily).withColumns({
        "rolling_corr_mean": rolling_correlation(daily).agg(F.avg("rolling_corr").alias("m")).scalar(),
        "_best": cross.agg(best.alias("b")).scalar(),
    })
    return row.select("*", F.col("_best.r").alias("cross_corr_max"), F.col("_best.lag").alias("cross_corr_lag")).drop("_best")
