"""Recommendations and the health score: rules evaluated on one-row aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.functions.cleaning import is_business_hours_weekday
from watchledger.functions.statistics import safe_corr
from watchledger.operators.explore import value_counts
from watchledger.operators.ordering import top_k
from watchledger.operators.patterns import rapid_campaigns
from watchledger.operators.timeseries import daily_security_metrics

#: What to do about each finding.  The facts are columns: ``rule``, ``subject`` and ``value``.
ADVICE = {
    "critical_share": "Over a tenth of the incidents score Critical: open an incident bridge.",
    "high_share": "Over a fifth of the incidents score High: triage them today.",
    "hotspot": "Busiest location: tighten the controls that guard it.",
    "peak_hour": "Busiest hour of the day: put more eyes on it.",
    "off_hours": "Working hours see the smaller part: go over night and weekend access.",
    "rise together": "Days of failed logins are days of incidents: lock accounts out and ask for a second factor.",
    "move apart": "Failed logins drop when incidents climb: find out who gets in.",
    "campaigns": "Sources fire in quick succession: throttle them.",
    "login_success": "Too few logins succeed: walk users through the sign-in rules.",
    "top_source": "Busiest source: block it or fence it in.",
    "top_type": "Frequent kind of event: keep a playbook for it.",
}
#: Standing rows of every report, by subject.
STANDING = {
    "alerts": "Page somebody when a source turns Critical.",
    "baseline": "Refresh the usual volumes before judging a peak.",
    "locations": "Compare locations week by week.",
    "logins": "Watch the daily share of logins that succeed.",
    "logs": "Keep the logs of all systems in one place.",
    "sequences": "Answer known event sequences by machine.",
}


def _rule(row: DataFrame, when: Column, priority: str | Column, rule: str, value: Column | str, subject: Column | None = None, message: Column | None = None) -> DataFrame:
    """priority, rule, subject, value, message of the rows of ``row`` that meet ``when``."""
    level = F.lit(priority) if isinstance(priority, str) else priority
    number = F.col(value) if isinstance(value, str) else value
    about = F.lit(None).cast("string") if subject is None else subject.cast("string")
    return row.where(when).select(
        level.alias("priority"), F.lit(rule).alias("rule"), about.alias("subject"), number.cast("double").alias("value"), (F.lit(ADVICE[rule]) if message is None else message).alias("message"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionAll(b), parts)


def risk_recommendations(scored: DataFrame) -> DataFrame:
    level = lambda name: F.count_if(F.col("final_risk_level") == name)
    row = scored.agg(level("Critical").alias("critical"), level("High").alias("high"), F.count(F.lit(1)).alias("n"))
    return _union([
        _rule(row, F.col("critical") > F.col("n") * 0.1, "critical", "critical_share", "critical"),
        _rule(row, F.col("high") > F.col("n") * 0.2, "high", "high_share", "high"),
    ])


def _most_frequent(df: DataFrame, column: str, n: int = 1) -> DataFrame:
    return top_k(value_counts(df, column), n, F.desc("count"), F.col(column))


def hotspot_recommendation(df: DataFrame) -> DataFrame:
    return _rule(_most_frequent(df, "location"), F.lit(True), "high", "hotspot", "count", F.col("location"))


def _business_split(df: DataFrame) -> DataFrame:
    inside = F.coalesce(is_business_hours_weekday(F.col("timestamp")), F.lit(False))
    return df.agg(F.count_if(inside).alias("business"), F.count_if(~inside).alias("off"))


def temporal_recommendations(df: DataFrame) -> DataFrame:
    hours = df.where("timestamp is not null").groupBy(F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("count"))
    peak = _rule(top_k(hours, 1, F.desc("count"), F.col("hour")), F.lit(True), "medium", "peak_hour", "count", F.col("hour"))
    off = _rule(_business_split(df), F.col("off") > F.col("business"), "high", "off_hours", "off")
    return peak.unionAll(off)


def failed_login_corr(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    """Daily incidents against failed logins; takes prepared incidents."""
    return daily_security_metrics(incidents, logins).agg(safe_corr(F.col("incident_count"), F.col("failed_logins")).alias("r"))


def correlation_recommendation(incidents: DataFrame, logins: DataFrame, limit: float = 0.5) -> DataFrame:
    r = F.col("r")
    of = lambda together, apart: F.when(r > 0, together).otherwise(apart)
    return _rule(failed_login_corr(incidents, logins), F.abs(r) > limit, of("high", "medium"), "failed_logins", r, of("rise together", "move apart"),
                 of(ADVICE["rise together"], ADVICE["move apart"]))


def campaign_recommendation(df: DataFrame, min_events: int = 5, max_gap_s: float = 300) -> DataFrame:
    found = rapid_campaigns(df, min_events, max_gap_s).agg(F.count(F.lit(1)).alias("n"))
    return _rule(found, F.col("n") > 0, "critical", "campaigns", "n")


def _success_rate(logins: DataFrame) -> DataFrame:
    return logins.agg(F.try_divide(F.count_if(F.col("success") == "Yes").cast("double"), F.count(F.lit(1)).cast("double")).alias("rate"))


def login_recommendation(logins: DataFrame) -> DataFrame:
    return _rule(_success_rate(logins), F.col("rate") < 0.9, "high", "login_success", F.col("rate") * 100)


def top_ip_recommendation(df: DataFrame) -> DataFrame:
    return _rule(_most_frequent(df, "source_ip"), F.lit(True), "high", "top_source", "count", F.col("source_ip"))


def top_type_recommendations(df: DataFrame, n: int = 3) -> DataFrame:
    return _rule(_most_frequent(df, "event_type", n), F.lit(True), "medium", "top_type", "count", F.col("event_type"))


def recommendation_report(incidents: DataFrame, logins: DataFrame, scored: DataFrame) -> DataFrame:
    """All rules by priority, with the standing advice last."""
    pairs = F.array(*[F.struct(F.lit(k).alias("subject"), F.lit(m).alias("message")) for k, m in STANDING.items()])
    advice = incidents.sparkSession.range(1).select(F.inline(pairs)).select(
        F.lit("monitoring").alias("priority"), F.lit("standing").alias("rule"), "subject", F.lit(None).cast("double").alias("value"), "message")
    found = _union([
        risk_recommendations(scored), hotspot_recommendation(incidents), temporal_recommendations(incidents),
        correlation_recommendation(incidents, logins), campaign_recommendation(incidents), login_recommendation(logins),
        top_ip_recommendation(incidents), top_type_recommendations(incidents), advice,
    ])
    order = F.array_position(F.array(*[F.lit(p) for p in ("critical", "high", "medium", "monitoring")]), F.col("priority"))
    return found.orderBy(order, "rule", "subject")


def health_score(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    """100 less the deductions, clamped to 0..100, with its label; takes prepared incidents."""
    critical = incidents.agg(F.try_divide(F.count_if(F.col("severity") == "Critical").cast("double"), F.count(F.lit(1)).cast("double")).alias("critical_rate"))
    row = critical.withColumns({
        "login_success_rate": _success_rate(logins).scalar(),
        "incident_failed_corr": failed_login_corr(incidents, logins).scalar(),
        "_split": _business_split(incidents).select(F.struct("business", "off").alias("s")).scalar(),
    })
    off_hours = F.col("_split.off") > F.col("_split.business")
    charge = lambda when, points: F.when(when, points).otherwise(0)
    score = (
        100 - charge(F.col("login_success_rate") < 0.95, 10) - charge(F.col("login_success_rate") < 0.90, 10)
        - F.col("critical_rate") * 50 - charge(F.col("incident_failed_corr") > 0.3, 15) - charge(off_hours, 10)
    )
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))
    label = F.when(clamped >= 80, "GOOD").when(clamped >= 60, "MODERATE").when(clamped >= 40, "POOR").otherwise("CRITICAL")
    return row.select("critical_rate", "login_success_rate", "incident_failed_corr", off_hours.alias("more_off_hours"),
                      clamped.alias("health_score"), label.alias("assessment"))
