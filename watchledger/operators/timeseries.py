"""Daily series, calendar patterns and forecasts.

Every ordered window here runs over per-day or per-hour aggregates, whose size
is bounded by the calendar and not by the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from watchledger.functions.cleaning import day_name
from watchledger.functions.statistics import safe_corr
from watchledger.operators.explore import weekday_counts
from watchledger.schemas import MONTHS, SEVERITIES, WEEKDAYS


def trailing_week() -> WindowSpec:
    """The last seven dates present."""
    return Window.orderBy("date").rowsBetween(-6, 0)


def _n() -> Column:
    return F.count(F.lit(1))


def daily_incidents(df: DataFrame) -> DataFrame:
    return df.where("timestamp is not null").groupBy(F.to_date("timestamp").alias("date")).agg(_n().alias("incidents"))


def daily_logins(logins: DataFrame) -> DataFrame:
    return logins.where("login_time is not null").groupBy(F.to_date("login_time").alias("date")).agg(_n().alias("login_attempts"))


def moving_average_7(df: DataFrame) -> DataFrame:
    """Mean of the last seven dates present, null before the seventh."""
    full = F.count("incidents").over(trailing_week()) == 7
    return daily_incidents(df).withColumn("ma_7", F.when(full, F.avg("incidents").over(trailing_week())))


def moving_average_calendar(df: DataFrame, days: int = 7) -> DataFrame:
    """Mean over the dates present among the last ``days`` calendar days."""
    day = F.unix_date("date")
    return daily_incidents(df).withColumn("ma", F.avg("incidents").over(Window.orderBy(day).rangeBetween(1 - days, 0)))


def daily_activity(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    """Outer merge of both daily series, gaps filled with 0."""
    return daily_incidents(incidents).join(daily_logins(logins), "date", "full_outer").na.fill(0, ["incidents", "login_attempts"])


def daily_trend_line(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    """Least-squares incidents on logins with fitted values; empty with one day only."""
    daily = daily_activity(incidents, logins)
    fit = daily.agg(F.struct(
        _n().alias("days"),
        F.try_divide(F.covar_pop("login_attempts", "incidents"), F.var_pop("login_attempts")).alias("slope"),
        F.avg("incidents").alias("my"), F.avg("login_attempts").alias("mx"),
    ).alias("f")).scalar()
    line = daily.withColumn("_f", fit).where("_f.days > 1")
    slope, intercept = F.col("_f.slope"), F.col("_f.my") - F.col("_f.slope") * F.col("_f.mx")
    return line.select("date", "incidents", "login_attempts", slope.alias("slope"), intercept.alias("intercept"),
                       (slope * F.col("login_attempts") + intercept).alias("fitted"))


def temporal_stats(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    both = daily_incidents(incidents).join(daily_logins(logins), "date", "full_outer")
    filled = lambda c: F.coalesce(F.col(c), F.lit(0))
    had_incidents = F.when(F.col("incidents").isNotNull(), F.col("date"))
    return both.agg(
        F.min(had_incidents).alias("first_date"), F.max(had_incidents).alias("last_date"),
        F.avg("incidents").alias("avg_daily_incidents"), F.max("incidents").alias("peak_daily_incidents"),
        F.avg("login_attempts").alias("avg_daily_logins"),
        safe_corr(filled("incidents"), filled("login_attempts")).alias("daily_correlation"),
    )


def hour_by_severity(df: DataFrame) -> DataFrame:
    cells = df.where("timestamp is not null").groupBy(F.hour("timestamp").alias("hour"))
    return cells.pivot("severity", SEVERITIES).agg(_n()).na.fill(0, SEVERITIES).orderBy("hour")


def weekday_pattern(df: DataFrame) -> DataFrame:
    return weekday_counts(df)


def weekday_by_hour(df: DataFrame) -> DataFrame:
    """Weekday rows in calendar order, one column per hour."""
    cells = df.where("timestamp is not null").withColumns({"day_of_week": day_name(F.col("timestamp")), "_h": F.hour("timestamp")})
    counts = cells.groupBy("day_of_week").pivot("_h", list(range(24))).agg(_n()).na.fill(0)
    order = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("day_of_week"))
    return counts.select("day_of_week", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in range(24)]).orderBy(order)


def peaks(df: DataFrame) -> DataFrame:
    """First arg-max hour, weekday and month."""
    ts = F.col("timestamp")
    # One scan: at most 24 * 7 * 12 cells feed the three rankings.
    cells = df.where("timestamp is not null").groupBy(F.hour(ts).alias("hour"), F.weekday(ts).alias("weekday"), F.month(ts).alias("month")).agg(_n().alias("n"))

    def peak(key: str, names: list[str] | None = None, base: int = 0) -> Column:
        value = F.element_at(F.array(*[F.lit(n) for n in names]), F.col(key) - base + 1) if names else F.col(key)
        counts = cells.groupBy(key).agg(F.sum("n").alias("n"))
        return counts.agg(F.max_by(value, F.struct(F.col("n"), -F.col(key))).alias("v")).scalar()

    return df.sparkSession.range(1).select(
        peak("hour").alias("peak_hour"), peak("weekday", WEEKDAYS).alias("peak_day"), peak("month", MONTHS, 1).alias("peak_month"))


def incidents_ytd(df: DataFrame) -> DataFrame:
    """Running count within the calendar year."""
    in_year = Window.partitionBy(F.year("date")).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily_incidents(df).withColumn("incidents_ytd", F.sum("incidents").over(in_year))


def incident_forecast(df: DataFrame, days: int = 7) -> DataFrame:
    """Linear trend plus the mean residual of the weekday, for the days after the last one."""
    epoch = F.lit("1970-01-01").cast("date")
    daily = daily_incidents(df).withColumn("x", F.datediff("date", epoch).cast("double"))
    fit = daily.agg(F.struct(
        F.coalesce(F.try_divide(F.covar_pop("x", "incidents"), F.var_pop("x")), F.lit(0.0)).alias("slope"),
        F.avg("x").alias("mx"), F.avg("incidents").alias("my"), F.max("date").alias("last"),
    ).alias("f")).scalar()
    line = F.col("_f.my") + F.col("_f.slope") * (F.col("x") - F.col("_f.mx"))
    season = daily.withColumn("_f", fit).groupBy(F.weekday("date").alias("weekday")).agg(F.avg(F.col("incidents") - line).alias("seasonal"))
    future = df.sparkSession.range(1, days + 1).withColumn("_f", fit).select(
        F.date_add("_f.last", F.col("id").cast("int")).alias("date"), "_f").withColumns(
        {"x": F.datediff("date", epoch).cast("double"), "weekday": F.weekday("date")})
    return future.join(F.broadcast(season), "weekday", "left").select(  # seven rows
        "date", line.alias("trend"), F.coalesce("seasonal", F.lit(0.0)).alias("seasonal"),
        F.greatest(line + F.coalesce("seasonal", F.lit(0.0)), F.lit(0.0)).alias("forecast"))


def period_over_period(df: DataFrame) -> DataFrame:
    """Incidents per Monday-first week against the previous week present."""
    weekly = df.groupBy(F.date_trunc("week", "timestamp").cast("date").alias("week_start")).agg(_n().alias("incidents"))
    previous = F.lag("incidents").over(Window.orderBy("week_start"))
    return weekly.select("week_start", "incidents", previous.alias("previous"), (F.col("incidents") - previous).alias("change"),
                         F.try_divide((F.col("incidents") - previous) * 100.0, previous).alias("change_percent"))


def alert_spikes(df: DataFrame, ratio: float = 2.0) -> DataFrame:
    """Days above ``ratio`` times the daily average."""
    daily = daily_incidents(df)
    average = daily.agg(F.avg("incidents").alias("a")).scalar()
    return daily.withColumn("daily_average", average).where(F.col("incidents") > F.col("daily_average") * ratio)


def auth_trend(logins: DataFrame) -> DataFrame:
    return daily_login_metrics(logins)


def daily_incident_metrics(df: DataFrame) -> DataFrame:
    """Takes prepared incidents (severity_score)."""
    return df.where("timestamp is not null").groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count("event_id").alias("incident_count"), F.avg("severity_score").alias("avg_severity"),
        F.count_distinct("source_ip").alias("unique_ips"))


def daily_login_metrics(logins: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("success") == "Yes")
    return logins.where("login_time is not null").groupBy(F.to_date("login_time").alias("date")).agg(
        F.count("login_id").alias("total_logins"), ok.alias("successful_logins"),
        (F.count("login_id") - ok).alias("failed_logins"),
        F.try_divide(ok.cast("double"), F.count("login_id").cast("double")).alias("login_success_rate"))


DAILY_METRICS = ["incident_count", "avg_severity", "unique_ips", "total_logins", "successful_logins", "failed_logins", "login_success_rate"]


def daily_security_metrics(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    """Seven daily metrics, outer merged, gaps filled with 0."""
    return daily_incident_metrics(incidents).join(daily_login_metrics(logins), "date", "full_outer").na.fill(0, DAILY_METRICS)
