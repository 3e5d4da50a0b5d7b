"""Queries: source and event risk, anomalies, statistics, patterns, posture."""

from __future__ import annotations

from pyspark.sql import functions as F

from watchledger.functions import statistics
from watchledger.operators import anomalies, correlate, correlation, event_risk, forest, ordering, patterns, posture, source_risk, timeseries
from watchledger.plans.forest_sql import forest_sql
from watchledger.plans.registry import Query, r6
from watchledger.plans.reports import SECURITY
from watchledger.schemas import RISK_LEVELS
from watchledger.sources import sinks
from watchledger.workspace import new_path

_c = F.col


def band_sql(x: str, cuts: list[float], labels=RISK_LEVELS) -> str:
    bounds = [*cuts, None]
    cases = [f"WHEN {x} > {lo}" + (f" AND {x} <= {hi}" if hi is not None else "") + f" THEN '{label}'" for lo, hi, label in zip(bounds, bounds[1:], labels)]
    return f"CASE {' '.join(cases)} END"


def norm_sql(x: str) -> str:
    span = f"max({x}) OVER () - min({x}) OVER ()"
    return f"((CAST({x} AS DOUBLE) - min({x}) OVER ()) / CASE WHEN max({x}) OVER () = min({x}) OVER () THEN 1 ELSE {span} END)"


def weighted_sql(weights: dict[str, float]) -> str:
    return " + ".join(f"{norm_sql(c)} * {w}e0 * 100" for c, w in weights.items())


def z_sql(x: str) -> str:
    return f"(({x} - avg({x}) OVER ()) / CASE WHEN stddev_pop({x}) OVER () = 0 THEN 1 ELSE stddev_pop({x}) OVER () END)"


# --- source risk -------------------------------------------------------------------------------
# The SQL states weights, features and lists by itself, so that a wrong constant in an operator shows.
_RISKY = "('Unknown', 'Russia', 'China', 'North Korea')"
_ADVANCED = {"frequency": 0.30, "avg_severity": 0.25, "success_rate": 0.20, "event_diversity": 0.10, "persistence_days": 0.15}
_PROFILE = {"basic_risk_score": 0.2, "advanced_risk_score": 0.3, "temporal_risk_score": 0.25, "anomaly_score": 0.15, "geo_risk_score": 0.1}
_SOURCE_FEATURES = ["frequency", "avg_severity", "success_rate", "event_diversity", "avg_hour", "location_count"]
SOURCES_SQL = f"""
aged AS (SELECT *, date_sub('day', timestamp, (SELECT max(timestamp) FROM scored)) AS age FROM scored),
sm AS (SELECT source_ip, count(event_id) AS frequency, round_even(avg(severity_score), 3) AS avg_severity,
  round_even(avg(CASE WHEN status = 'Successful' THEN 1 ELSE 0 END), 3) AS success_rate, min(timestamp) AS first_seen, max(timestamp) AS last_seen,
  count(DISTINCT timestamp) AS active_days, count(DISTINCT date) AS active_dates, count(DISTINCT event_type) AS event_diversity,
  count(DISTINCT location) AS location_diversity, count(DISTINCT coalesce(location, '~')) AS location_count, count(DISTINCT destination_device) AS target_diversity,
  date_sub('day', min(timestamp), max(timestamp)) AS persistence_days, round_even(avg(hour), 3) AS avg_hour,
  round_even(avg(CASE WHEN location IN {_RISKY} THEN 3 ELSE 1 END), 3) AS avg_country_risk,
  round_even(sum(severity_score * exp(-age / 7e0)), 3) AS weighted_severity_sum, round_even(sum(exp(-age / 7e0)), 3) AS total_weight, min(age) AS most_recent_days
  FROM aged WHERE source_ip IS NOT NULL GROUP BY 1),
basic AS (SELECT *, round_even(frequency * avg_severity, 2) AS basic_risk_score FROM sm),
adv AS (SELECT *, round_even({weighted_sql(_ADVANCED)}, 2) AS advanced_risk_score FROM basic),
tmp AS (SELECT *, exp(-most_recent_days / 30e0) AS recency_bonus,
  round_even(weighted_severity_sum / CASE WHEN total_weight = 0 THEN 1 ELSE total_weight END * 10, 2) * (1 + exp(-most_recent_days / 30e0)) AS temporal_risk_score FROM adv),
src AS (SELECT *, round_even(frequency * avg_severity * avg_country_risk * ln(1 + location_count), 2) AS geo_risk_score FROM tmp)
"""
_CORE = {c: w for c, w in _PROFILE.items() if c != "anomaly_score"}
BASIC_LEVEL, ADVANCED_LEVEL = band_sql("basic_risk_score", [0, 5, 15, 30]), band_sql("advanced_risk_score", [0, 25, 50, 75])
TEMPORAL_LEVEL, GEO_LEVEL = band_sql("temporal_risk_score", [0, 10, 25, 50]), band_sql("geo_risk_score", [0, 10, 30, 70])
ANOMALY_LEVEL = "CASE WHEN a <= 0.5 THEN 'Normal' WHEN a <= 1 THEN 'Suspicious' WHEN a <= 1.5 THEN 'Anomalous' ELSE 'Critical_Anomaly' END"
_ZS = [f"abs({z_sql(c)})" for c in (*_SOURCE_FEATURES, "isolation_score")]
COMPOSITE = f"""composite AS (SELECT *, a AS anomaly_score, {ANOMALY_LEVEL} AS anomaly_level FROM (SELECT *, round_even(isolation_score * 0.6e0 + zm * 0.4e0, 3) AS a FROM
   (SELECT *, greatest({', '.join(_ZS)}) AS zm, ({' + '.join(_ZS)}) / 7 AS za FROM labelled)))"""
ANOMALY_SQL = f"""{SOURCES_SQL.strip()},
{forest_sql("sm", "source_ip", _SOURCE_FEATURES, 0.1)},
labelled AS (SELECT src.*, CASE WHEN iso_anomaly = 1 THEN 1 ELSE -1 END AS isolation_score FROM src JOIN iso ON source_ip = k),
{COMPOSITE}
"""
_LEVELS_SQL = f"""basic_risk_score, {BASIC_LEVEL} AS risk_level, advanced_risk_score, {ADVANCED_LEVEL} AS advanced_risk_level,
  {r6('temporal_risk_score')} AS temporal_risk_score, {TEMPORAL_LEVEL} AS temporal_risk_level"""
PROFILE_SQL = f"""{ANOMALY_SQL.strip()},
profile AS (SELECT source_ip, {_LEVELS_SQL}, anomaly_score, anomaly_level, geo_risk_score, {GEO_LEVEL} AS geo_risk_level,
  round_even({weighted_sql(_PROFILE)}, 2) AS ensemble_risk_score FROM composite)
"""
CORE_PROFILE_SQL = f"""{SOURCES_SQL.strip()},
profile AS (SELECT source_ip, {_LEVELS_SQL}, geo_risk_score, {GEO_LEVEL} AS geo_risk_level, round_even({weighted_sql(_CORE)}, 2) AS ensemble_risk_score FROM src)
"""
FINAL_LEVEL = band_sql("ensemble_risk_score", [0, 30, 55, 80])


def full_profile(t):
    """The profile of every address with all five scores."""
    return source_risk.ip_risk_profile(t.incidents)


def core_profile(t):
    """The profile from the four scores SQL can express."""
    return source_risk.ip_risk_profile(t.incidents, use_anomaly=False)


def _composite(t):
    """The composite with a label SQL can express: the busiest tenth of the sources."""
    metrics = source_risk.source_metrics(t.incidents)
    limit = ordering.exact_quantiles(metrics, "frequency", {"q": 0.9}).scalar()
    labelled = metrics.withColumn("isolation_score", F.when(_c("frequency") > limit, 1).otherwise(-1))
    return source_risk.composite_anomaly(labelled).select("source_ip", "isolation_score", "z_score_max", "z_score_avg", "anomaly_score", "anomaly_level")


def _export_top(t):
    path = sinks.export_top_risk(full_profile(t), new_path(t.spark, "export"))
    return t.spark.read.option("header", True).schema(
        "source_ip string, basic_risk_score double, risk_level string, advanced_risk_score double, advanced_risk_level string, temporal_risk_score double,"
        " temporal_risk_level string, anomaly_score double, anomaly_level string, geo_risk_score double, geo_risk_level string, ensemble_risk_score double, final_risk_level string, risk_trend string").csv(path)


def _events_flags(t, limit: float):
    return statistics.any_z_gt(t.base("events").select("event_id", "value", "user_id"), ["value", "user_id"], limit)


SOURCE_RISK = [
    Query("ip_basic_risk", lambda t: source_risk.ip_basic_risk(t.incidents), f"""
        SELECT source_ip, frequency AS incident_count, avg_severity, success_rate, first_seen, last_seen, active_days, active_dates, basic_risk_score,
          {BASIC_LEVEL} AS risk_level FROM src""", SOURCES_SQL),
    Query("ip_advanced_risk", lambda t: source_risk.ip_advanced_risk(t.incidents), f"""
        SELECT source_ip, frequency, avg_severity, success_rate, event_diversity, persistence_days, location_diversity, target_diversity, advanced_risk_score,
          {ADVANCED_LEVEL} AS advanced_risk_level FROM src""", SOURCES_SQL),
    Query("ip_temporal_risk", lambda t: source_risk.ip_temporal_risk(t.incidents), f"""
        SELECT source_ip, frequency AS total_incidents, weighted_severity_sum, total_weight, most_recent_days, event_diversity, {r6('recency_bonus')} AS recency_bonus,
          {r6('temporal_risk_score')} AS temporal_risk_score, {TEMPORAL_LEVEL} AS temporal_risk_level FROM src""", SOURCES_SQL),
    Query("ip_anomaly_scores", lambda t: source_risk.ip_anomaly_scores(t.incidents), f"""
        SELECT source_ip, {', '.join(_SOURCE_FEATURES)}, CAST(isolation_score AS BIGINT) AS isolation_score, {r6('zm')} AS z_score_max, {r6('za')} AS z_score_avg, anomaly_score, anomaly_level
        FROM composite""", ANOMALY_SQL),
    Query("ip_anomaly_composite", _composite, f"""
        SELECT source_ip, CAST(isolation_score AS BIGINT) AS isolation_score, {r6('zm')} AS z_score_max, {r6('za')} AS z_score_avg, anomaly_score, anomaly_level FROM composite""",
          SOURCES_SQL.strip() + f""",
        labelled AS (SELECT *, CASE WHEN frequency > (SELECT quantile_cont(frequency, 0.9) FROM sm) THEN 1 ELSE -1 END AS isolation_score FROM sm),
        {COMPOSITE}"""),
    Query("ip_geo_risk", lambda t: source_risk.ip_geo_risk(t.incidents), f"""
        SELECT source_ip, frequency, avg_country_risk, location_count AS location_diversity, avg_severity, geo_risk_score, {GEO_LEVEL} AS geo_risk_level FROM src""", SOURCES_SQL),
    Query("ip_risk_profile", full_profile, f"SELECT *, {FINAL_LEVEL} AS final_risk_level, 'Stable' AS risk_trend FROM profile", PROFILE_SQL),
    Query("ip_risk_profile_core", core_profile, f"SELECT *, {FINAL_LEVEL} AS final_risk_level, 'Stable' AS risk_trend FROM profile", CORE_PROFILE_SQL),
    Query("join_scores", lambda t: correlate.join_scores(source_risk.ip_basic_risk(t.incidents).select("source_ip", "basic_risk_score"),
                                                         source_risk.ip_temporal_risk(t.incidents).select("source_ip", "temporal_risk_score"),
                                                         source_risk.ip_geo_risk(t.incidents).select("source_ip", "geo_risk_score")),
          f"SELECT source_ip, basic_risk_score, {r6('temporal_risk_score')} AS temporal_risk_score, geo_risk_score FROM src", SOURCES_SQL),
    Query("risk_summary", lambda t: source_risk.risk_summary(full_profile(t)), """
        SELECT count(*) AS total_ips_analyzed, count(*) FILTER (WHERE f = 'High') AS high_risk_ips, count(*) FILTER (WHERE f = 'Critical') AS critical_risk_ips,
          round_even(avg(ensemble_risk_score), 2) AS avg_ensemble_score, max(ensemble_risk_score) AS max_risk_score, """
          + ", ".join(f"count(*) FILTER (WHERE f = '{level}') AS level_{level.lower()}" for level in RISK_LEVELS)
          + f", count(*) FILTER (WHERE f IS NULL) AS level_none FROM (SELECT *, {FINAL_LEVEL} AS f FROM profile)", PROFILE_SQL),
    Query("export_top_risk", _export_top, f"""SELECT *, {FINAL_LEVEL} AS final_risk_level, 'Stable' AS risk_trend FROM profile
        ORDER BY ensemble_risk_score DESC, source_ip LIMIT 20""", PROFILE_SQL),
    Query("incidents_with_profile", lambda t: correlate.incidents_with_profile(t.incidents, full_profile(t).select("source_ip", "ensemble_risk_score", "final_risk_level")),
          f"SELECT i.*, ensemble_risk_score, {FINAL_LEVEL} AS final_risk_level FROM incidents i LEFT JOIN profile p ON i.source_ip = p.source_ip", PROFILE_SQL),
    Query("minmax", lambda t: statistics.minmax(t.base("events").select("event_id", "value"), ["value"]),
          f"SELECT event_id, {r6('value')} AS value, {r6(norm_sql('value'))} AS value_norm FROM events"),
    Query("standard_scale", lambda t: statistics.standard_scale(t.base("events").select("event_id", "value"), ["value"]),
          f"SELECT event_id, {r6('value')} AS value, {r6(z_sql('value'))} AS value_z FROM events"),
    Query("abs_zscore", lambda t: statistics.abs_zscore(t.base("events").select("event_id", "value", "user_id"), ["value", "user_id"]), f"""
        SELECT event_id, {r6('value')} AS value, user_id, {r6(f"greatest(abs({z_sql('value')}), abs({z_sql('user_id')}))")} AS z_score_max,
          {r6(f"(abs({z_sql('value')}) + abs({z_sql('user_id')})) / 2")} AS z_score_avg FROM events"""),
    Query("any_z_gt", lambda t: _events_flags(t, 3.0), f"""
        SELECT event_id, {r6('value')} AS value, user_id, CAST(abs({z_sql('value')}) > 3 OR abs({z_sql('user_id')}) > 3 AS BIGINT) AS zscore_anomaly FROM events"""),
    Query("isolation_forest", lambda t: forest.isolation_forest(t.base("events").select("event_id", "value", "user_id"), ["value", "user_id"], ["event_id"], 0.1),
          f"SELECT event_id, {r6('value')} AS value, user_id, iso_anomaly, {r6('iso_score')} AS iso_score FROM events JOIN iso ON event_id = k",
          forest_sql("events", "event_id", ["value", "user_id"], 0.1)),
]

# --- event risk --------------------------------------------------------------------------------
EVENT_SQL = f"""
rarity AS (SELECT event_type, 1e0 / (count(*) / (SELECT count(*) FROM scored)) AS event_rarity FROM scored GROUP BY 1),
ld AS (SELECT location, avg(severity_score) AS s, count(event_id) AS n, count(DISTINCT source_ip) AS u FROM scored WHERE location IS NOT NULL GROUP BY 1),
lr AS (SELECT location, ({norm_sql('s')} * 0.5e0 + {norm_sql('n')} * 0.3e0 + {norm_sql('u')} * 0.2e0) * 100 AS geo_risk_score FROM ld),
er AS (SELECT s.*, severity_score * 100e0 AS basic_risk_score, event_rarity, hour BETWEEN 9 AND 17 AS business_hours,
  severity_score * 100e0 * (1 + event_rarity / 10) * CASE WHEN hour BETWEEN 9 AND 17 THEN 1 ELSE 1.3e0 END AS advanced_risk_score,
  count(event_id) OVER (ORDER BY timestamp RANGE BETWEEN INTERVAL '86399999999 microseconds' PRECEDING AND CURRENT ROW) AS rolling_incidents_24h, geo_risk_score
  FROM scored s LEFT JOIN rarity USING (event_type) LEFT JOIN lr USING (location)),
et AS (SELECT *, severity_score * 100e0 * (1 + rolling_incidents_24h / 10) AS temporal_risk_score FROM er)
"""
_EVENT_WEIGHTS = {"basic_risk_score": 0.25, "advanced_risk_score": 0.25, "temporal_risk_score": 0.2, "anomaly_score": 0.15, "geo_risk_score": 0.15}
_EVENT_CORE = {c: w for c, w in _EVENT_WEIGHTS.items() if c != "anomaly_score"}
CODES = """
coded AS (SELECT *, dense_rank() OVER (ORDER BY event_type) - 1 AS event_type_encoded, dense_rank() OVER (ORDER BY coalesce(location, 'Unknown')) - 1 AS location_encoded FROM scored)
"""
EVENT_FOREST = f"""{CODES.strip()},
{forest_sql("coded", "event_id", ["hour", "severity_score", "event_type_encoded"], 0.1)}"""
ENSEMBLE_SQL = f"""{EVENT_SQL.strip()},
{EVENT_FOREST},
ea AS (SELECT et.*, iso_anomaly * 100e0 AS anomaly_score FROM et JOIN iso ON event_id = k),
ens AS (SELECT *, {weighted_sql(_EVENT_WEIGHTS)} AS ensemble_risk_score FROM ea),
es AS (SELECT *, {FINAL_LEVEL} AS final_risk_level FROM ens)
"""
CORE_ENSEMBLE_SQL = f"""{EVENT_SQL.strip()},
ens AS (SELECT *, {weighted_sql(_EVENT_CORE)} AS ensemble_risk_score FROM et),
es AS (SELECT *, {FINAL_LEVEL} AS final_risk_level FROM ens)
"""


def full_events(t):
    """Event scores with all five terms."""
    return event_risk.event_ensemble(t.prepared)


def core_events(t):
    """Event scores without the forest term."""
    return event_risk.event_ensemble(t.prepared, use_anomaly=False)


def _mean_sql(key: str) -> str:
    return f"SELECT {key}, {r6('avg(ensemble_risk_score)')} AS avg_risk_score FROM es"


_BIN = "least(CAST(floor((ensemble_risk_score - lo) / (hi - lo) * 30) AS BIGINT), 29)"
EVENT_RISK = [
    Query("event_basic_risk", lambda t: event_risk.event_basic_risk(t.prepared).select("event_id", "basic_risk_score"), f"SELECT event_id, {r6('basic_risk_score')} AS basic_risk_score FROM et", EVENT_SQL),
    Query("event_advanced_risk", lambda t: event_risk.event_advanced_risk(t.prepared).select("event_id", "event_rarity", "business_hours", "advanced_risk_score"),
          f"SELECT event_id, {r6('event_rarity')} AS event_rarity, business_hours, {r6('advanced_risk_score')} AS advanced_risk_score FROM et", EVENT_SQL),
    Query("event_temporal_risk", lambda t: event_risk.event_temporal_risk(t.prepared).select("event_id", "rolling_incidents_24h", "temporal_risk_score"),
          f"SELECT event_id, rolling_incidents_24h, {r6('temporal_risk_score')} AS temporal_risk_score FROM et", EVENT_SQL),
    Query("event_anomaly", lambda t: event_risk.event_anomaly(t.prepared), "SELECT scored.* REPLACE (CAST(severity_score AS BIGINT) AS severity_score), iso_anomaly * 100e0 AS anomaly_score FROM scored JOIN iso ON event_id = k", EVENT_FOREST),
    Query("event_geo_risk", lambda t: event_risk.event_geo_risk(t.prepared).select("event_id", "location", "geo_risk_score"),
          f"SELECT event_id, location, {r6('geo_risk_score')} AS geo_risk_score FROM et", EVENT_SQL),
    Query("event_ensemble", lambda t: full_events(t).select("event_id", *_EVENT_WEIGHTS, "ensemble_risk_score", "final_risk_level"),
          f"SELECT event_id, {', '.join(f'{r6(c)} AS {c}' for c in (*_EVENT_WEIGHTS, 'ensemble_risk_score'))}, final_risk_level FROM es", ENSEMBLE_SQL),
    Query("event_ensemble_core", lambda t: core_events(t).select("event_id", "ensemble_risk_score", "final_risk_level"),
          f"SELECT event_id, {r6('ensemble_risk_score')} AS ensemble_risk_score, final_risk_level FROM es", CORE_ENSEMBLE_SQL),
    Query("risk_level_distribution", lambda t: event_risk.risk_level_distribution(full_events(t)),
          "SELECT final_risk_level, count(*) AS incidents FROM es WHERE final_risk_level IS NOT NULL GROUP BY 1", ENSEMBLE_SQL),
    Query("risk_by_event_type", lambda t: event_risk.risk_by_event_type(full_events(t)), _mean_sql("event_type") + " GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", ENSEMBLE_SQL),
    Query("risk_by_location", lambda t: event_risk.risk_by_location(full_events(t)), _mean_sql("location") + " WHERE location IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", ENSEMBLE_SQL),
    Query("risk_by_severity", lambda t: event_risk.risk_by_severity(full_events(t)), _mean_sql("severity") + " GROUP BY 1", ENSEMBLE_SQL),
    Query("risk_by_day", lambda t: event_risk.risk_by_day(full_events(t)), _mean_sql("date") + " GROUP BY 1", ENSEMBLE_SQL),
    Query("risk_by_hour", lambda t: event_risk.risk_by_hour(full_events(t)), _mean_sql("hour") + " GROUP BY 1", ENSEMBLE_SQL),
    Query("risk_histogram", lambda t: event_risk.risk_histogram(full_events(t)), f"""
        SELECT CAST(i AS BIGINT) AS bin, {r6('lo + i * (hi - lo) / 30')} AS lower, {r6('lo + (i + 1) * (hi - lo) / 30')} AS upper, coalesce(n, 0) AS count, {r6('m')} AS mean_score
        FROM range(30) g(i) CROSS JOIN (SELECT min(ensemble_risk_score) AS lo, max(ensemble_risk_score) AS hi, avg(ensemble_risk_score) AS m FROM es)
        LEFT JOIN (SELECT {_BIN} AS b, count(*) AS n FROM es, (SELECT min(ensemble_risk_score) AS lo, max(ensemble_risk_score) AS hi FROM es)
                   WHERE ensemble_risk_score IS NOT NULL GROUP BY 1) ON b = i""", ENSEMBLE_SQL),
    Query("histogram", lambda t: statistics.histogram(t.base("events"), "value"), f"""
        SELECT CAST(i AS BIGINT) AS bin, {r6('lo + i * (hi - lo) / 30')} AS lower, {r6('lo + (i + 1) * (hi - lo) / 30')} AS upper, coalesce(n, 0) AS count
        FROM range(30) g(i) CROSS JOIN (SELECT min(value) AS lo, max(value) AS hi FROM events)
        LEFT JOIN (SELECT least(CAST(floor((value - lo) / (hi - lo) * 30) AS BIGINT), 29) AS b, count(*) AS n
                   FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events) WHERE value IS NOT NULL GROUP BY 1) ON b = i"""),
]

# --- anomalies ---------------------------------------------------------------------------------
_EVENT_FEATURES = ["hour", "severity_score", "event_type_encoded", "location_encoded"]
ISOLATED = f"""{CODES.strip()},
{forest_sql("coded", "event_id", _EVENT_FEATURES, 0.05)}"""


def any_z_sql(cols, limit: float) -> str:
    return " OR ".join(f"abs({z_sql(c)}) > {limit}" for c in cols)


ANOMALIES = [
    Query("label_encode", lambda t: ordering.label_encode(t.incidents, "event_type", "code").select("event_id", "event_type", "code"),
          "SELECT event_id, event_type, event_type_encoded AS code FROM coded", CODES),
    Query("zscore_flags", lambda t: anomalies.zscore_flags(t.prepared).select("event_id", *anomalies.FEATURES, "zscore_anomaly"), f"""
        SELECT event_id, hour, CAST(severity_score AS BIGINT) AS severity_score, event_type_encoded, location_encoded,
          CAST({any_z_sql(anomalies.FEATURES, 3)} AS BIGINT) AS zscore_anomaly FROM coded""", CODES),
    Query("event_isolation", lambda t: anomalies.event_isolation(t.prepared).select("event_id", *_EVENT_FEATURES, "iso_anomaly", "iso_score"), f"""
        SELECT event_id, hour, CAST(severity_score AS BIGINT) AS severity_score, event_type_encoded, location_encoded, iso_anomaly, {r6('iso_score')} AS iso_score
        FROM coded JOIN iso ON event_id = k""", ISOLATED),
    Query("top_event_anomalies", lambda t: anomalies.top_event_anomalies(t.prepared), f"""
        SELECT event_id, timestamp, event_type, severity, source_ip, location, {r6('e')} AS ensemble_anomaly_score FROM (SELECT *, iso_score * 0.7e0 + z * 20 AS e FROM combined)
        ORDER BY round(e, 9) DESC, event_id LIMIT 20""", ISOLATED + f""",
        combined AS (SELECT coded.*, iso_score, iso_anomaly, CAST({any_z_sql(_EVENT_FEATURES, 3)} AS BIGINT) AS z FROM coded JOIN iso ON event_id = k)"""),
    Query("alert_anomaly_events", lambda t: anomalies.alert_anomaly_events(t.prepared), f"""
        SELECT event_id, timestamp, event_type, severity, source_ip, location, iso_anomaly, z AS zscore_anomaly, {r6('iso_score * 0.7e0 + z * 20')} AS ensemble_anomaly_score
        FROM combined WHERE iso_anomaly = 1 OR z = 1""", ISOLATED + f""",
        combined AS (SELECT coded.*, iso_score, iso_anomaly, CAST({any_z_sql(_EVENT_FEATURES, 3)} AS BIGINT) AS z FROM coded JOIN iso ON event_id = k)"""),
    Query("top_zscore_events", lambda t: anomalies.top_zscore_events(t.prepared, limit=1.6), f"""
        SELECT event_id, timestamp, event_type, severity, source_ip, location, CAST(z * 20 AS BIGINT) AS zscore_term
        FROM (SELECT *, CAST({any_z_sql(anomalies.FEATURES, 1.6)} AS BIGINT) AS z FROM coded) ORDER BY zscore_term DESC, event_id LIMIT 20""", CODES),
]

# --- statistics --------------------------------------------------------------------------------
METRICS = timeseries.DAILY_METRICS


def security(t):
    return timeseries.daily_security_metrics(t.prepared, t.prepared_logins)


def p_sql(r: str, n: str) -> str:
    """Two-sided p of a correlation from the closed series of Student's t, coefficients by the gamma function."""
    nu = f"({n} - 2)"
    theta = f"atan(abs({r}) * sqrt({nu} / ((1 - {r}) * (1 + {r}))) / sqrt({nu}))"
    even = f"list_sum(list_transform(range(CAST({nu} / 2 AS BIGINT)), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1)) / sqrt(pi()) * pow(cos({theta}), 2 * k)))"
    odd = f"list_sum(list_transform(range(CAST(({nu} - 1) / 2 AS BIGINT)), lambda k: sqrt(pi()) / 2 * exp(lgamma(k + 1) - lgamma(k + 1.5)) * pow(cos({theta}), 2 * k + 1)))"
    return f"(1 - CASE WHEN {nu} % 2 = 0 THEN sin({theta}) * {even} ELSE 2 / pi() * ({theta} + sin({theta}) * {odd}) END)"


ROLL = SECURITY.strip() + """,
rolling AS (SELECT date, CASE WHEN count(*) OVER w = 7 THEN covar_pop(incident_count, failed_logins) OVER w
   / nullif(stddev_pop(incident_count) OVER w * stddev_pop(failed_logins) OVER w, 0) END AS rolling_corr FROM daily WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
numbered AS (SELECT *, row_number() OVER (ORDER BY date) AS i FROM daily),
crossed AS (SELECT CAST(k AS BIGINT) AS lag, (SELECT covar_pop(a.incident_count, b.failed_logins) / nullif(stddev_pop(a.incident_count) * stddev_pop(b.failed_logins), 0)
   FROM numbered a JOIN numbered b ON b.i = a.i - k) AS r FROM range(-10, 11) g(k) WHERE abs(k) <= (SELECT count(*) FROM daily) - 1)
"""
_PAIRS = ", ".join(f"{r6(f'corr({a}, {b})')} AS {name}" for name, (a, b) in correlation.KEY_PAIRS.items())
_MEASURED = "date, incident_count, {}, unique_ips, total_logins, successful_logins, failed_logins, {}".format(*[f"{r6(c)} AS {c}" for c in ("avg_severity", "login_success_rate")])

STATISTICS = [
    Query("daily_incident_metrics", lambda t: timeseries.daily_incident_metrics(t.prepared), f"SELECT date, incident_count, {r6('avg_severity')} AS avg_severity, unique_ips FROM im", SECURITY),
    Query("daily_login_metrics", lambda t: timeseries.daily_login_metrics(t.logins),
          f"SELECT date, total_logins, successful_logins, failed_logins, {r6('login_success_rate')} AS login_success_rate FROM lm", SECURITY),
    Query("daily_security_metrics", security, f"SELECT {_MEASURED} FROM daily", SECURITY),
    Query("daily_metrics_outer", security, f"SELECT {_MEASURED} FROM daily", SECURITY),
    Query("correlation_matrix", lambda t: correlation.correlation_matrix(security(t)), "\nUNION ALL ".join(
        f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, {r6(f'corr({a}, {b})')} AS r FROM daily" for a in METRICS for b in METRICS), SECURITY),
    Query("key_correlations", lambda t: correlation.key_correlations(security(t)), f"SELECT {_PAIRS} FROM daily", SECURITY),
    Query("pearson_test", lambda t: correlation.pearson_test(security(t)), f"""
        SELECT {r6('r')} AS r, n, {r6(p_sql('r', 'n'))} AS p_value, {p_sql('r', 'n')} < 0.05 AS significant
        FROM (SELECT corr(incident_count, failed_logins) AS r, count(*) AS n FROM daily)""", SECURITY),
    Query("spearman_test", lambda t: correlation.spearman_test(security(t)), f"""
        SELECT {r6('r')} AS r, n, {r6(p_sql('r', 'n'))} AS p_value, {p_sql('r', 'n')} < 0.05 AS significant FROM (SELECT corr(x, y) AS r, count(*) AS n FROM
          (SELECT rank() OVER (ORDER BY incident_count) + (count(*) OVER (PARTITION BY incident_count) - 1) / 2 AS x,
                  rank() OVER (ORDER BY failed_logins) + (count(*) OVER (PARTITION BY failed_logins) - 1) / 2 AS y FROM daily))""", SECURITY),
    Query("trend_points", lambda t: correlation.trend_points(security(t)), f"""
        SELECT CAST(k AS BIGINT) AS point, {r6('lo + k * (hi - lo) / 99')} AS x, {r6('s * (lo + k * (hi - lo) / 99) + i')} AS y FROM range(100) g(k),
         (SELECT min(failed_logins) AS lo, max(failed_logins) AS hi, regr_slope(incident_count, failed_logins) AS s, regr_intercept(incident_count, failed_logins) AS i FROM daily)""", SECURITY),
    Query("severity_vs_success_corr", lambda t: correlation.severity_vs_success_corr(security(t)), f"SELECT {r6('corr(avg_severity, login_success_rate)')} AS r, count(*) AS days FROM daily", SECURITY),
    Query("rolling_correlation", lambda t: correlation.rolling_correlation(security(t)), f"SELECT date, {r6('rolling_corr')} AS rolling_corr FROM rolling", ROLL),
    Query("cross_correlation", lambda t: correlation.cross_correlation(security(t)), f"SELECT lag, {r6('r')} AS r FROM crossed", ROLL),
    Query("correlation_insights", lambda t: correlation.correlation_insights(security(t)), f"""
        SELECT {_PAIRS}, {r6('(SELECT avg(rolling_corr) FROM rolling)')} AS rolling_corr_mean, {r6('(SELECT max(r) FROM crossed)')} AS cross_corr_max,
          (SELECT lag FROM crossed WHERE r IS NOT NULL ORDER BY r DESC, lag LIMIT 1) AS cross_corr_lag FROM daily""", ROLL),
]

# --- patterns ----------------------------------------------------------------------------------


def mode_sql(key: str) -> str:
    return f"(SELECT {key}, arg_min(severity, (-n, severity)) AS severity FROM (SELECT {key}, severity, count(*) AS n FROM scored WHERE severity IS NOT NULL GROUP BY ALL) GROUP BY {key})"


def sequence_sql(key: str) -> str:
    return f"""
whole AS (SELECT {key}, string_agg(event_type, ' → ' ORDER BY timestamp, event_id) AS text, count(*) AS events, min(timestamp) AS first_at,
  (epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6 / 3600 AS span_hours FROM scored WHERE source_ip IS NOT NULL GROUP BY ALL HAVING count(*) >= 3),
grouped AS (SELECT text, count(*) AS occurrences, min(first_at) AS first_at, arg_min(({key}), first_at) AS k, arg_min(span_hours, first_at) AS f, avg(span_hours) AS a, any_value(events) AS events
  FROM whole GROUP BY text ORDER BY occurrences DESC, first_at LIMIT 10)
"""


def mined_sql(share: float, most: int, near: str = "TRUE") -> str:
    """Every stretch of up to ``most`` events of every source, counted; stretches lie within events that are ``near`` their predecessor."""
    return f"""
SELECT sequence, length, sources, occurrences, NOT EXISTS (SELECT 1 FROM listed b WHERE b.length = a.length + 1 AND b.sources = a.sources AND
  (b.items[:a.length] = a.items OR b.items[2:] = a.items)) AS closed
FROM (SELECT *, array_to_string(items, ' → ') AS sequence FROM listed) a""".replace("listed b", f"({_listed(share, most, near)}) b").replace("FROM listed)", f"FROM ({_listed(share, most, near)}))")


def _listed(share: float, most: int, near: str) -> str:
    return f"""
SELECT items, CAST(len(items) AS BIGINT) AS length, count(DISTINCT source_ip) AS sources, count(*) AS occurrences
FROM (SELECT source_ip, run, unnest(flatten(list_transform(range(1, len(types) + 1), lambda i: list_transform(range(i, least(i + {most}, len(types) + 1)), lambda j: types[i:j])))) AS items
  FROM (SELECT source_ip, run, list(event_type ORDER BY timestamp, event_id) AS types FROM (SELECT *, sum(CASE WHEN {near} THEN 0 ELSE 1 END) OVER (PARTITION BY source_ip ORDER BY timestamp, event_id) AS run
    FROM (SELECT *, lag(timestamp) OVER (PARTITION BY source_ip ORDER BY timestamp, event_id) AS before FROM scored WHERE source_ip IS NOT NULL AND event_type IS NOT NULL)) GROUP BY ALL))
GROUP BY items HAVING count(DISTINCT source_ip) >= (SELECT ceil(count(DISTINCT source_ip) * {share}e0) FROM scored)"""


def _dated(t):
    return t.prepared.withColumn("day", F.to_date("timestamp"))


def _clusters_by_band(t):
    """Fixed clusters that SQL can express, for the summary."""
    behavior = patterns.ip_behavior(t.prepared)
    return behavior.withColumn("behavior_cluster", (_c("total_events") % 4).cast("int"))


SPAN = "(epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 1e6"
BEHAVIOR = f"""
behavior AS (SELECT b.*, m.severity AS primary_severity FROM (SELECT source_ip, count(event_id) AS total_events, count(DISTINCT event_type) AS unique_event_types,
  stddev_samp(hour) AS timing_variability, {SPAN} / 3600 AS activity_span_hours, count(DISTINCT location) AS location_diversity FROM scored WHERE source_ip IS NOT NULL GROUP BY 1) b
  LEFT JOIN {mode_sql('source_ip')} m USING (source_ip)),
rapid AS (SELECT c.*, m.severity FROM (SELECT source_ip, count(timestamp) AS total_events, {SPAN} / (count(timestamp) - 1) AS avg_gap_seconds, {SPAN} / 60 AS span_minutes
  FROM scored WHERE source_ip IS NOT NULL GROUP BY 1) c LEFT JOIN {mode_sql('source_ip')} m USING (source_ip) WHERE total_events >= 5)
"""
_FEATURES = ["total_events", "unique_event_types", "activity_span_hours", "location_diversity"]


def lloyd_sql(k: int = 4, restarts: int = 10, rounds: int = 40) -> str:
    """k-means by rounds written out one after another; start points by md5, as in the operator."""
    dims = range(len(_FEATURES))
    xs = ", ".join(f"x{i}" for i in dims)
    distance = "(" + " + ".join(f"(p.x{i} - o.x{i}) * (p.x{i} - o.x{i})" for i in dims) + ") * 1e-6"
    near = lambda o: f"SELECT p.source_ip, r, arg_min(c, ({distance}, c)) AS c, min({distance}) AS d, {', '.join(f'any_value(p.x{i}) AS x{i}' for i in dims)} FROM points p CROSS JOIN {o} o GROUP BY p.source_ip, r"
    points = ", ".join(f"CAST(round(({z_sql(f'coalesce({f}, 0)')}) / 1e-6) AS BIGINT) AS x{i}" for i, f in enumerate(_FEATURES))
    first = f"""
points AS MATERIALIZED (SELECT source_ip, {points} FROM behavior WHERE total_events >= 3),
c0 AS MATERIALIZED (SELECT r, row_number() OVER w - 1 AS c, {', '.join(f'CAST(x{i} AS DOUBLE) AS x{i}' for i in dims)} FROM points CROSS JOIN range({restarts}) g(r)
  WINDOW w AS (PARTITION BY r ORDER BY md5(r || ':' || source_ip), source_ip) QUALIFY row_number() OVER w <= {k})"""
    steps = [f"""
c{n} AS MATERIALIZED (SELECT o.r, o.c, {', '.join(f'coalesce(m.x{i}, o.x{i}) AS x{i}' for i in dims)} FROM c{n - 1} o LEFT JOIN
  (SELECT r, c, {', '.join(f'CAST(sum(x{i}) AS DOUBLE) / count(*) AS x{i}' for i in dims)} FROM ({near(f'c{n - 1}')}) GROUP BY r, c) m USING (r, c))""" for n in range(1, rounds + 1)]
    last = f"""
ended AS MATERIALIZED ({near(f'c{rounds}')}),
placed AS (SELECT source_ip, c FROM ended WHERE r = (SELECT arg_min(r, (cost, r)) FROM (SELECT r, sum(CAST(floor(d) AS BIGINT)) AS cost FROM ended GROUP BY r)))"""
    return ",".join([first, *steps, last])


_RAPID = f"source_ip, total_events, {r6('avg_gap_seconds')} AS avg_gap_seconds, {r6('span_minutes')} AS span_minutes, severity FROM rapid"

PATTERNS = [
    Query("ip_sequences", lambda t: patterns.ip_sequences(t.prepared), f"""
        SELECT source_ip, CAST(0 AS BIGINT) AS segment, text AS sequence, events, m.severity, {r6('span_hours')} AS span_hours
        FROM whole LEFT JOIN {mode_sql('source_ip')} m USING (source_ip)""", sequence_sql("source_ip")),
    Query("common_sequences", lambda t: patterns.common_sequences(t.prepared), f"""
        SELECT k AS source_ip, CAST(0 AS BIGINT) AS segment, text AS sequence, occurrences, events, {r6('f')} AS first_span_hours, {r6('a')} AS avg_span_hours FROM grouped""", sequence_sql("source_ip")),
    Query("common_daily_sequences", lambda t: patterns.common_sequences(_dated(t), key=["source_ip", "day"]), f"""
        SELECT k[1] AS source_ip, k[2] AS day, CAST(0 AS BIGINT) AS segment, text AS sequence, occurrences, events, {r6('f')} AS first_span_hours, {r6('a')} AS avg_span_hours
        FROM grouped""", sequence_sql("source_ip, date")),
    Query("frequent_sequences", lambda t: patterns.frequent_sequences(t.prepared, 0.1, 5), mined_sql(0.1, 5)),
    Query("frequent_daily_steps", lambda t: patterns.frequent_sequences(t.prepared, 0.05, max_gap_hours=24), mined_sql(0.05, 6, "timestamp - before <= INTERVAL 24 HOUR")),
    Query("ip_behavior", lambda t: patterns.ip_behavior(t.prepared), f"""
        SELECT source_ip, total_events, unique_event_types, {r6('timing_variability')} AS timing_variability, {r6('activity_span_hours')} AS activity_span_hours,
          location_diversity, primary_severity FROM behavior""", BEHAVIOR),
    Query("behavior_clusters", lambda t: patterns.behavior_clusters(t.prepared), f"""
        SELECT b.source_ip, total_events, unique_event_types, {r6('timing_variability')} AS timing_variability, {r6('activity_span_hours')} AS activity_span_hours,
          location_diversity, primary_severity, CAST(c AS BIGINT) AS behavior_cluster FROM behavior b JOIN placed USING (source_ip)""", BEHAVIOR.strip() + "," + lloyd_sql()),
    Query("cluster_summary", lambda t: patterns.cluster_summary(_clusters_by_band(t)), """
        SELECT behavior_cluster, sources, avg_events, avg_event_types, avg_span_hours, arg_min(p, (-n, p)) AS primary_severity FROM
         (SELECT total_events % 4 AS behavior_cluster, count(*) AS sources, round_even(avg(total_events), 2) AS avg_events, round_even(avg(unique_event_types), 2) AS avg_event_types,
            round_even(avg(activity_span_hours), 2) AS avg_span_hours FROM behavior GROUP BY 1)
         JOIN (SELECT total_events % 4 AS behavior_cluster, primary_severity AS p, count(*) AS n FROM behavior GROUP BY 1, 2) USING (behavior_cluster) GROUP BY ALL""", BEHAVIOR),
    Query("hourly_profile", lambda t: patterns.hourly_profile(t.prepared), f"""
        SELECT hour, count(event_id) AS incidents, {r6('avg(severity_score)')} AS avg_severity, count(DISTINCT source_ip) AS unique_ips,
          hour = (SELECT hour FROM scored GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS is_peak FROM scored GROUP BY 1"""),
    Query("business_hours_split", lambda t: patterns.business_hours_split(t.incidents), f"""
        SELECT {r6('avg(b) * 100')} AS business_hours_percent, {r6('100 - avg(b) * 100')} AS off_hours_percent
        FROM (SELECT CAST(hour BETWEEN 9 AND 17 AND day_of_week NOT IN ('Saturday', 'Sunday') AS INT) AS b FROM scored)"""),
    Query("rapid_campaigns", lambda t: patterns.rapid_campaigns(t.incidents), f"SELECT {_RAPID} WHERE avg_gap_seconds < 300", BEHAVIOR),
    Query("slow_campaigns", lambda t: patterns.rapid_campaigns(t.incidents, max_gap_s=60_000), f"SELECT {_RAPID} WHERE avg_gap_seconds < 60000", BEHAVIOR),
    Query("gap_quantiles", lambda t: patterns.gap_quantiles(t.incidents).select("source_ip", "gaps", *[F.round(q, 3).alias(q) for q in ("q50", "q90")]), """
        SELECT source_ip, count(*) AS gaps, round(quantile_cont(gap, 0.5), 3) AS q50, round(quantile_cont(gap, 0.9), 3) AS q90 FROM
          (SELECT source_ip, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY source_ip ORDER BY timestamp, event_id))) / 1e6 AS gap FROM incidents)
        WHERE gap IS NOT NULL GROUP BY 1 HAVING count(*) >= 4"""),
    Query("top_campaigns", lambda t: patterns.top_campaigns(t.incidents, max_gap_s=60_000),
          f"SELECT {_RAPID} WHERE avg_gap_seconds < 60000 ORDER BY total_events DESC, source_ip LIMIT 5", BEHAVIOR),
]

# --- posture -----------------------------------------------------------------------------------
_TOP = "SELECT {0} AS v, count(*) AS n FROM scored WHERE {0} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {1}"
_BUSINESS = "count(*) FILTER (WHERE hour BETWEEN 9 AND 17 AND day_of_week NOT IN ('Saturday', 'Sunday'))"
_RATE = "(SELECT count(*) FILTER (WHERE success = 'Yes') / count(*) FROM logins)"
_R = "(SELECT corr(incident_count, failed_logins) FROM daily)"


def _rule_sql(priority: str, rule: str, subject: str, value: str, message: str, source: str) -> str:
    return f"SELECT {priority} AS priority, {rule} AS rule, {subject} AS subject, {r6(value)} AS value, {message} AS message FROM {source}"


_SHARES = "(SELECT count(*) FILTER (WHERE final_risk_level = 'Critical') AS c, count(*) FILTER (WHERE final_risk_level = 'High') AS h, count(*) AS n FROM es)"
RULES = {
    "risk": _rule_sql("'critical'", "'critical_share'", "NULL::VARCHAR", "c", "'Over a tenth of the incidents score Critical: open an incident bridge.'", f"{_SHARES} WHERE c > n * 0.1")
    + " UNION ALL " + _rule_sql("'high'", "'high_share'", "NULL::VARCHAR", "h", "'Over a fifth of the incidents score High: triage them today.'", f"{_SHARES} WHERE h > n * 0.2"),
    "hotspot": _rule_sql("'high'", "'hotspot'", "v", "n", "'Busiest location: tighten the controls that guard it.'", f"({_TOP.format('location', 1)})"),
    "temporal": _rule_sql("'medium'", "'peak_hour'", "v::VARCHAR", "n", "'Busiest hour of the day: put more eyes on it.'", f"({_TOP.format('hour', 1)})")
    + " UNION ALL " + _rule_sql("'high'", "'off_hours'", "NULL::VARCHAR", "n - b", "'Working hours see the smaller part: go over night and weekend access.'",
                                f"(SELECT {_BUSINESS} AS b, count(*) AS n FROM scored) WHERE n - b > b"),
    "correlation": _rule_sql("CASE WHEN r > 0 THEN 'high' ELSE 'medium' END", "'failed_logins'", "CASE WHEN r > 0 THEN 'rise together' ELSE 'move apart' END", "r",
                             "CASE WHEN r > 0 THEN 'Days of failed logins are days of incidents: lock accounts out and ask for a second factor.' ELSE 'Failed logins drop when incidents climb: find out who gets in.' END",
                             "(SELECT corr(incident_count, failed_logins) AS r FROM daily) WHERE abs(r) > {limit}"),
    "campaign": _rule_sql("'critical'", "'campaigns'", "NULL::VARCHAR", "n", "'Sources fire in quick succession: throttle them.'", "(SELECT count(*) AS n FROM rapid WHERE avg_gap_seconds < {gap}) WHERE n > 0"),
    "login": _rule_sql("'high'", "'login_success'", "NULL::VARCHAR", f"{_RATE} * 100", "'Too few logins succeed: walk users through the sign-in rules.'", f"(SELECT 1) WHERE {_RATE} < 0.9"),
    "top_ip": _rule_sql("'high'", "'top_source'", "v", "n", "'Busiest source: block it or fence it in.'", f"({_TOP.format('source_ip', 1)})"),
    "top_types": _rule_sql("'medium'", "'top_type'", "v", "n", "'Frequent kind of event: keep a playbook for it.'", f"({_TOP.format('event_type', 3)})"),
    "advice": """SELECT 'monitoring' AS priority, 'standing' AS rule, s AS subject, NULL::DOUBLE AS value, m AS message FROM (VALUES
        ('alerts', 'Page somebody when a source turns Critical.'), ('baseline', 'Refresh the usual volumes before judging a peak.'), ('locations', 'Compare locations week by week.'),
        ('logins', 'Watch the daily share of logins that succeed.'), ('logs', 'Keep the logs of all systems in one place.'), ('sequences', 'Answer known event sequences by machine.')) a(s, m)""",
}
_ALL_VIEWS = f"{ENSEMBLE_SQL.strip()}, {SECURITY.strip()}, {BEHAVIOR.strip()}"
_SCORE = f"""100 - CASE WHEN {_RATE} < 0.95 THEN 10 ELSE 0 END - CASE WHEN {_RATE} < 0.9 THEN 10 ELSE 0 END - cr * 50e0 - CASE WHEN {_R} > 0.3 THEN 15 ELSE 0 END - CASE WHEN n - b > b THEN 10 ELSE 0 END"""

POSTURE = [
    Query("risk_recommendations", lambda t: posture.risk_recommendations(full_events(t)), RULES["risk"], ENSEMBLE_SQL),
    Query("hotspot_recommendation", lambda t: posture.hotspot_recommendation(t.incidents), RULES["hotspot"]),
    Query("temporal_recommendations", lambda t: posture.temporal_recommendations(t.incidents), RULES["temporal"]),
    Query("correlation_recommendation", lambda t: posture.correlation_recommendation(t.prepared, t.logins), RULES["correlation"].format(limit=0.5), SECURITY),
    Query("weak_correlation_recommendation", lambda t: posture.correlation_recommendation(t.prepared, t.logins, limit=0.0), RULES["correlation"].format(limit=0), SECURITY),
    Query("campaign_recommendation", lambda t: posture.campaign_recommendation(t.incidents), RULES["campaign"].format(gap=300), BEHAVIOR),
    Query("slow_campaign_recommendation", lambda t: posture.campaign_recommendation(t.incidents, max_gap_s=60_000), RULES["campaign"].format(gap=60000), BEHAVIOR),
    Query("login_recommendation", lambda t: posture.login_recommendation(t.logins), RULES["login"]),
    Query("top_ip_recommendation", lambda t: posture.top_ip_recommendation(t.incidents), RULES["top_ip"]),
    Query("top_type_recommendations", lambda t: posture.top_type_recommendations(t.incidents), RULES["top_types"]),
    Query("recommendation_report", lambda t: posture.recommendation_report(t.prepared, t.logins, full_events(t)),
          "\nUNION ALL ".join(f"SELECT * FROM ({sql.format(limit=0.5, gap=300) if key in ('correlation', 'campaign') else sql})" for key, sql in RULES.items()), _ALL_VIEWS),
    Query("health_score", lambda t: posture.health_score(t.prepared, t.logins), f"""
        SELECT {r6('cr')} AS critical_rate, {r6(_RATE)} AS login_success_rate, {r6(_R)} AS incident_failed_corr, n - b > b AS more_off_hours, {r6('greatest(0, least(100, s))')} AS health_score,
          CASE WHEN s >= 80 THEN 'GOOD' WHEN s >= 60 THEN 'MODERATE' WHEN s >= 40 THEN 'POOR' ELSE 'CRITICAL' END AS assessment
        FROM (SELECT *, {_SCORE} AS s FROM (SELECT count(*) FILTER (WHERE severity = 'Critical') / count(*) AS cr, {_BUSINESS} AS b, count(*) AS n FROM scored))""", SECURITY),
]

QUERIES = [*SOURCE_RISK, *EVENT_RISK, *ANOMALIES, *STATISTICS, *PATTERNS, *POSTURE]
