"""Queries: sources, cleaning, joins, quality, the report suite, exploration, time series, geography."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from watchledger.functions import cleaning
from watchledger.operators import correlate, explore, geo, incident_sql, quality, timeseries
from watchledger.plans.registry import Query, r6
from watchledger.schemas import CONSTRAINTS, DICTIONARY, INCIDENTS, MONTHS, SEVERITIES, STATUSES, WEEKDAYS
from watchledger.sources import readers, sinks
from watchledger.workspace import new_path

ZERO = "CASE severity WHEN 'Critical' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 1 ELSE 0 END"
OK = "count(*) FILTER (WHERE status = 'Successful')"

# --- cleaning expressions in SQL ---------------------------------------------------------------
_O = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
V4 = rf"^{_O}(\.{_O}){{3}}$"
V6 = r"^([0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4})*)?::([0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4})*)?$"


def title_sql(c: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all(lower({c}), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '')"


def ip_sql(c: str) -> str:
    digits = f"regexp_replace({c}, '[^0-9.]', '', 'g')"
    return (f"CASE WHEN regexp_matches(trim({c}), '{V4}') OR regexp_matches(trim({c}), '{V6}') THEN trim({c})"
            f" WHEN regexp_matches({digits}, '{V4}') THEN {digits} END")


SCORE = "CASE severity WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 WHEN 'Critical' THEN 4 ELSE CAST(NULL AS BIGINT) END"
CANON = "CASE lower(severity) WHEN 'low' THEN 'Low' WHEN 'medium' THEN 'Medium' WHEN 'high' THEN 'High' WHEN 'critical' THEN 'Critical' ELSE severity END"


def etl_time_sql(ts: str) -> str:
    return f"hour({ts}) AS hour, dayname({ts}) AS day_of_week, month({ts}) AS month, isodow({ts}) >= 6 AS is_weekend"


CLEAN_RAW = f"""
parsed AS (SELECT * REPLACE (try_cast(timestamp AS TIMESTAMP) AS timestamp) FROM raw_incidents),
cleaned AS (
 SELECT event_id, timestamp, event_type, {CANON} AS severity, {ip_sql('source_ip')} AS source_ip, destination_device, status,
  {title_sql('trim(location)')} AS location, {etl_time_sql('timestamp')} FROM parsed),
incidents_cleaned AS (SELECT *, {SCORE} AS severity_score FROM cleaned)
"""
CLEAN_LOGINS = f"""
logins_cleaned AS (
 SELECT login_id, user_id, login_time, CASE WHEN success IN ('Yes','yes') THEN true WHEN success IN ('No','no') THEN false END AS success,
  {ip_sql('ip_address')} AS ip_address, {etl_time_sql('login_time')} FROM logins)
"""
CLEAN_FIXTURE = CLEAN_RAW.replace("FROM raw_incidents", "FROM incidents")
MERGED = f"""{CLEAN_FIXTURE.strip()}, {CLEAN_LOGINS.strip()},
merged AS (
 SELECT i.event_id AS incident_event_id, i.timestamp AS incident_timestamp, i.event_type AS incident_event_type,
  i.severity AS incident_severity, i.source_ip, i.destination_device AS incident_destination_device, i.status AS incident_status,
  i.location AS incident_location, i.hour AS incident_hour, i.day_of_week AS incident_day_of_week, i.month AS incident_month,
  i.is_weekend AS incident_is_weekend, i.severity_score AS incident_severity_score,
  l.login_id AS login_login_id, l.user_id AS login_user_id, l.login_time, l.success AS login_success, l.hour AS login_hour,
  l.day_of_week AS login_day_of_week, l.month AS login_month, l.is_weekend AS login_is_weekend
 FROM incidents_cleaned i LEFT JOIN logins_cleaned l
 ON i.source_ip = l.ip_address AND l.login_time >= i.timestamp - INTERVAL 60 MINUTE AND l.login_time <= i.timestamp + INTERVAL 60 MINUTE)
"""


def raw_clean(t):
    return cleaning.clean_incidents(t.raw_incidents.withColumn("timestamp", cleaning.coerce_timestamp(F.col("timestamp"))))


def merged(t):
    return correlate.correlate(cleaning.clean_incidents(t.incidents), cleaning.clean_logins(t.logins))


def published(t):
    name = f"pairs_{uuid.uuid4().hex}"
    correlate.publish_pairs(cleaning.clean_incidents(t.incidents), cleaning.clean_logins(t.logins), name, buckets=8)
    return correlate.correlate_published(t.spark, name)


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# --- A: sources, sinks, inspection -----------------------------------------------------------


def _csv_round_trip(t, table: str):
    """The table written as CSV and read back with the explicit schema."""
    path = sinks.export_cleaned(getattr(t, table), new_path(t.spark, "csv"), table)
    return {"incidents": readers.read_incidents, "logins": readers.read_logins}[table](t.spark, path)


def _raw_pair(t):
    base = new_path(t.spark, "csv")
    paths = [sinks.export_cleaned(getattr(t, name), base, name) for name in ("incidents", "logins")]
    return readers.shapes(*readers.read_raw_pair(t.spark, *paths))


def _export_cleaned(t):
    path = sinks.export_cleaned(merged(t), new_path(t.spark, "export"), "security_events_merged", fmt="parquet", date_column="incident_timestamp")
    return t.spark.read.parquet(path).drop("day")


SOURCES = [
    Query("read_incidents", lambda t: _csv_round_trip(t, "incidents"), "SELECT * FROM incidents_cleaned", CLEAN_FIXTURE),
    Query("read_logins", lambda t: _csv_round_trip(t, "logins"), "SELECT * FROM logins_cleaned", CLEAN_LOGINS),
    Query("read_raw_pair", _raw_pair, """
        SELECT 'incidents' AS "table", count(*) AS rows, CAST(8 AS BIGINT) AS columns FROM incidents
        UNION ALL SELECT 'logins', count(*), 5 FROM logins
        UNION ALL SELECT 'total', (SELECT count(*) FROM incidents) + (SELECT count(*) FROM logins), 8"""),
    Query("security_events", lambda t: incident_sql.security_events(t.incidents, t.logins), """
        SELECT 'incident' AS event_category, event_id, timestamp, event_type, severity, source_ip, destination_device, status, location,
          CAST(NULL AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS login_success FROM incidents
        UNION ALL SELECT 'login', login_id, login_time, CASE WHEN success = 'No' THEN 'Failed Login' ELSE 'Successful Login' END,
          CASE WHEN success = 'No' THEN 'Medium' ELSE 'Low' END, ip_address, NULL, success, NULL, user_id, success FROM logins"""),
    Query("export_cleaned", _export_cleaned, "SELECT * FROM merged", MERGED),
    Query("sample_rows", lambda t: quality.sample_rows(t.incidents, "event_id"), "SELECT * FROM incidents ORDER BY event_id LIMIT 5"),
    Query("describe_table", lambda t: quality.describe_table(t.prepared), "\nUNION ALL ".join(f"""
        SELECT '{c}' AS "column", count({c}) AS count, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std, {r6(f'min({c})')} AS min,
          {r6(f'quantile_cont({c}, 0.25)')} AS p25, {r6(f'quantile_cont({c}, 0.5)')} AS p50, {r6(f'quantile_cont({c}, 0.75)')} AS p75,
          {r6(f'max({c})')} AS max FROM scored""" for c in ("event_id", "hour", "year", "severity_score"))),
    Query("table_info", lambda t: quality.table_info(t.raw_incidents), "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{"bigint" if c == "event_id" else "string"}' AS dtype, count({c}) AS non_null FROM raw_incidents"""
        for c in INCIDENTS.names)),
]

# --- B: cleaning and scalar functions ----------------------------------------------------------
_c = F.col


def _project(source, **columns):
    """One scalar function beside the key, over the whole table."""
    return lambda t: getattr(t, source).select("event_id", *[c().alias(k) for k, c in columns.items()])


CLEANING = [
    Query("canon_severity", _project("raw_incidents", severity=lambda: cleaning.canon_severity(_c("severity"))),
          f"SELECT event_id, {CANON} AS severity FROM raw_incidents"),
    Query("title_severity", _project("raw_incidents", severity=lambda: cleaning.title_severity(_c("severity"))),
          f"SELECT event_id, {title_sql('severity')} AS severity FROM raw_incidents"),
    Query("clean_ip", _project("raw_incidents", source_ip=lambda: cleaning.clean_ip(_c("source_ip"))),
          f"SELECT event_id, {ip_sql('source_ip')} AS source_ip FROM raw_incidents"),
    Query("clean_location", _project("raw_incidents", location=lambda: cleaning.clean_location(_c("location"))),
          f"SELECT event_id, {title_sql('trim(location)')} AS location FROM raw_incidents"),
    Query("strip_location", _project("raw_incidents", location=lambda: cleaning.strip_location(_c("location"))),
          "SELECT event_id, trim(location) AS location FROM raw_incidents"),
    Query("time_features_etl", lambda t: cleaning.time_features_etl(t.incidents.select("event_id", "timestamp"), "timestamp"),
          f"SELECT event_id, timestamp, {etl_time_sql('timestamp')} FROM incidents"),
    Query("time_features_eda", lambda t: cleaning.time_features_eda(t.incidents.select("event_id", "timestamp"), "timestamp"),
          "SELECT event_id, timestamp, date, hour, day_of_week, month_name, year FROM scored"),
    Query("severity_score", _project("raw_incidents", score=lambda: cleaning.severity_score(_c("severity"))),
          f"SELECT event_id, CAST({SCORE} AS BIGINT) AS score FROM raw_incidents"),
    Query("severity_score_sql", _project("raw_incidents", score=lambda: cleaning.severity_score_sql(_c("severity"))),
          f"SELECT event_id, CAST({ZERO} AS BIGINT) AS score FROM raw_incidents"),
    Query("login_success_bool", lambda t: t.logins.select("login_id", cleaning.login_success_bool(_c("success")).alias("success")),
          "SELECT login_id, success FROM logins_cleaned", CLEAN_LOGINS),
    Query("coerce_timestamp", lambda t: quality.coerce_report(t.raw_incidents, "timestamp"), """
        SELECT count(*) FILTER (WHERE timestamp IS NOT NULL AND try_cast(timestamp AS TIMESTAMP) IS NULL) AS conversion_errors,
          count(try_cast(timestamp AS TIMESTAMP)) AS parsed, count(*) AS rows FROM raw_incidents"""),
    Query("dedupe", lambda t: cleaning.dedupe(t.raw_incidents), "SELECT DISTINCT * FROM raw_incidents"),
    Query("is_business_hours", _project("incidents", business=lambda: cleaning.is_business_hours(_c("timestamp"))),
          "SELECT event_id, hour BETWEEN 9 AND 17 AS business FROM scored"),
    Query("is_business_hours_weekday", _project("incidents", business=lambda: cleaning.is_business_hours_weekday(_c("timestamp"))),
          "SELECT event_id, hour BETWEEN 9 AND 17 AND day_of_week NOT IN ('Saturday','Sunday') AS business FROM scored"),
    Query("status_weight", _project("raw_incidents", weight=lambda: cleaning.status_weight(_c("status"))), """
        SELECT event_id, CAST(CASE status WHEN 'Successful' THEN 1.0 WHEN 'Failed' THEN 0.3 WHEN 'Blocked' THEN 0.1 WHEN 'Allowed' THEN 0.8 END
          AS DOUBLE) AS weight FROM raw_incidents"""),
    Query("clean_incidents", raw_clean, "SELECT * FROM incidents_cleaned", CLEAN_RAW),
    Query("clean_logins", lambda t: cleaning.clean_logins(t.logins), "SELECT * FROM logins_cleaned", CLEAN_LOGINS),
    Query("clean_eda", lambda t: cleaning.clean_eda(t.raw_incidents, t.logins)[0], f"""
        SELECT DISTINCT event_id, try_cast(timestamp AS TIMESTAMP) AS timestamp, event_type, {title_sql('severity')} AS severity, source_ip,
          destination_device, status, trim(location) AS location, CAST(try_cast(timestamp AS TIMESTAMP) AS DATE) AS date,
          hour(try_cast(timestamp AS TIMESTAMP)) AS hour, dayname(try_cast(timestamp AS TIMESTAMP)) AS day_of_week,
          monthname(try_cast(timestamp AS TIMESTAMP)) AS month_name, year(try_cast(timestamp AS TIMESTAMP)) AS year,
          CAST({SCORE.replace('CASE severity', f"CASE {title_sql('severity')}")} AS BIGINT) AS severity_score FROM raw_incidents"""),
    Query("clean_eda_logins", lambda t: cleaning.clean_eda(t.raw_incidents, t.logins)[1], """
        SELECT *, CAST(login_time AS DATE) AS date, hour(login_time) AS hour, dayname(login_time) AS day_of_week,
          monthname(login_time) AS month_name, year(login_time) AS year FROM (SELECT DISTINCT * FROM logins)"""),
    Query("band", lambda t: t.base("events").select("event_id", cleaning.band(_c("value"), [0, 5, 15, 30, float("inf")], SEVERITIES).alias("band")), """
        SELECT event_id, CASE WHEN value > 0 AND value <= 5 THEN 'Low' WHEN value > 5 AND value <= 15 THEN 'Medium'
          WHEN value > 15 AND value <= 30 THEN 'High' WHEN value > 30 THEN 'Critical' END AS band FROM events"""),
    Query("band_ge", lambda t: t.base("events").select("event_id", cleaning.band_ge(_c("value"), [50, 25, 10], ["Critical", "High", "Medium"], "Low").alias("band")), """
        SELECT event_id, CASE WHEN value >= 50 THEN 'Critical' WHEN value >= 25 THEN 'High' WHEN value >= 10 THEN 'Medium' ELSE 'Low' END AS band FROM events"""),
]

# --- D: joins ----------------------------------------------------------------------------------
JOINS = [
    Query("correlate", merged, "SELECT * FROM merged", MERGED),
    Query("correlate_published", published, "SELECT * FROM merged", MERGED),
    Query("correlate_features", lambda t: correlate.correlate_features(merged(t)).select(
        "incident_event_id", "login_login_id", "combined_risk_score", "incident_hour", "incident_is_business_hours", "login_hour", "login_is_business_hours"), f"""
        SELECT incident_event_id, login_login_id,
          {r6('coalesce(incident_severity_score, 0) + 2 * (CASE WHEN login_success THEN 0 WHEN NOT login_success THEN 1 ELSE 0 END)')} AS combined_risk_score,
          incident_hour, incident_hour BETWEEN 9 AND 17 AS incident_is_business_hours, hour(login_time) AS login_hour,
          coalesce(hour(login_time) BETWEEN 9 AND 17, false) AS login_is_business_hours FROM merged""", MERGED),
    Query("ip_incident_login_correlation", lambda t: incident_sql.ip_incident_login_correlation(t.incidents, t.logins), """
        SELECT coalesce(i.source_ip, l.ip_address) AS ip_address, count(DISTINCT CASE WHEN l.success = 'No' THEN l.login_id END) AS failed_logins,
          count(DISTINCT i.event_id) AS security_incidents,
          count(DISTINCT CASE WHEN l.success = 'No' THEN CAST(l.login_time AS DATE) END) AS failed_login_days,
          count(DISTINCT CAST(i.timestamp AS DATE)) AS incident_days
        FROM incidents i FULL OUTER JOIN logins l ON i.source_ip = l.ip_address GROUP BY 1
        HAVING failed_logins > 0 OR security_incidents > 0 ORDER BY failed_logins DESC, security_incidents DESC, ip_address LIMIT 20"""),
    Query("daily_outer", lambda t: timeseries.daily_activity(t.incidents, t.logins), """
        SELECT coalesce(a.date, b.date) AS date, coalesce(incidents, 0) AS incidents, coalesce(login_attempts, 0) AS login_attempts
        FROM (SELECT date, count(*) AS incidents FROM scored GROUP BY 1) a
        FULL JOIN (SELECT CAST(login_time AS DATE) AS date, count(*) AS login_attempts FROM logins GROUP BY 1) b ON a.date = b.date"""),
    Query("incidents_logins_semi", lambda t: correlate.incidents_logins_by_ip(t.incidents, t.logins, "semi"),
          "SELECT * FROM incidents WHERE source_ip IN (SELECT ip_address FROM logins)"),
    Query("incidents_logins_anti", lambda t: correlate.incidents_logins_by_ip(t.incidents, t.logins, "anti"),
          "SELECT * FROM incidents WHERE source_ip NOT IN (SELECT ip_address FROM logins)"),
    Query("incidents_logins_by_ip", lambda t: correlate.ip_overlap(t.incidents, t.logins), """
        SELECT coalesce(a.source_ip, b.ip_address) AS source_ip, coalesce(n, 0) AS incidents, coalesce(m, 0) AS logins,
          CASE WHEN n IS NULL THEN 'logins only' WHEN m IS NULL THEN 'incidents only' ELSE 'both' END AS seen_on
        FROM (SELECT source_ip, count(*) AS n FROM incidents GROUP BY 1) a
        FULL JOIN (SELECT ip_address, count(*) AS m FROM logins GROUP BY 1) b ON a.source_ip = b.ip_address"""),
    Query("map_lookup", lambda t: correlate.map_lookup(t.incidents, explore.value_counts(t.incidents, "location").withColumnRenamed("count", "location_count"), "location"),
          "SELECT i.*, n AS location_count FROM incidents i LEFT JOIN (SELECT location, count(*) AS n FROM incidents GROUP BY 1) c ON i.location = c.location"),
]

# --- C: quality --------------------------------------------------------------------------------
_TEXT = [c for c in INCIDENTS.names if c != "event_id"]


def violation_sql(rules, tables: dict[str, str]) -> str:
    tests = {
        "not_null": lambda r: f"{r.column} IS NULL",
        "in": lambda r: f"{r.column} IS NOT NULL AND {r.column} NOT IN {in_list(r.allowed)}",
        "between": lambda r: f"{r.column} IS NOT NULL AND {r.column} NOT BETWEEN {r.allowed[0]} AND {r.allowed[1]}",
        "positive": lambda r: f"{r.column} <= 0",
        "ip": lambda r: f"{r.column} IS NOT NULL AND NOT (regexp_matches({r.column}, '{V4}') OR regexp_matches({r.column}, '{V6}'))",
        "not_blank": lambda r: f"trim({r.column}) = ''",
    }
    parts = []
    for r in rules:
        if r.table not in tables:
            continue
        head = f"SELECT '{r.table}' AS \"table\", '{r.column}' AS \"column\", '{r.kind}' AS rule, "
        source = tables[r.table]
        if r.kind == "unique":
            parts.append(head + f"coalesce(CAST(sum(n) AS BIGINT), 0) AS violations FROM (SELECT count(*) AS n FROM {source} WHERE {r.column} IS NOT NULL GROUP BY {r.column} HAVING count(*) > 1)")
        elif r.kind == "references":
            parent, key = r.parent
            parts.append(head + f"count(*) AS violations FROM {source} WHERE {r.column} IS NOT NULL AND {r.column} NOT IN (SELECT {key} FROM {tables[parent]})")
        else:
            parts.append(head + f"count(*) FILTER (WHERE {tests[r.kind](r)}) AS violations FROM {source}")
    return "\nUNION ALL ".join(parts)


_REPORTED = {"incidents_cleaned": "incidents_cleaned", "logins_cleaned": "logins_cleaned", "security_events_merged": "merged"}


def _dictionary(t):
    tables = {"incidents_cleaned": cleaning.clean_incidents(t.incidents), "logins_cleaned": cleaning.clean_logins(t.logins)}
    tables["security_events_merged"] = merged(t)
    return quality.rule_violations(tables, DICTIONARY)


def _quality(t):
    return quality.quality_report(cleaning.clean_incidents(t.incidents), cleaning.clean_logins(t.logins), merged(t))


def _metric_sql(section: str, metric: str, expr: str, source: str) -> str:
    return f"SELECT '{section}' AS section, '{metric}' AS metric, CAST({expr} AS VARCHAR) AS value FROM {source}"


_INC_COLS = [*INCIDENTS.names, "hour", "day_of_week", "month", "is_weekend", "severity_score"]
_LOG_COLS = ["login_id", "user_id", "login_time", "success", "ip_address", "hour", "day_of_week", "month", "is_weekend"]
_TS = "rtrim(rtrim(strftime({0}, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')"

QUALITY = [
    Query("missing_profile", lambda t: quality.missing_profile(t.raw_incidents), "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing, {r6(f'(count(*) - count({c})) * 100 / count(*)')} AS missing_percent FROM raw_incidents"""
        for c in INCIDENTS.names)),
    Query("duplicate_count", lambda t: quality.duplicate_count(t.raw_incidents), f"""
        SELECT n AS rows, n - d AS duplicates, {r6('(n - d) * 100 / n')} AS duplicate_percent
        FROM (SELECT count(*) AS n FROM raw_incidents), (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM raw_incidents))"""),
    Query("cardinality_profile", lambda t: quality.cardinality_profile(t.raw_incidents), "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS unique_values,
          CASE WHEN count(DISTINCT {c}) <= 10 THEN string_agg(DISTINCT {c}, ',' ORDER BY {c}) END AS "values" FROM raw_incidents""" for c in _TEXT)),
    Query("invalid_domain_values", lambda t: quality.invalid_domain_values(t.raw_incidents), f"""
        SELECT 'severity' AS "column", severity AS value, count(*) AS rows FROM raw_incidents WHERE severity IS NULL OR severity NOT IN {in_list(SEVERITIES)} GROUP BY 2
        UNION ALL SELECT 'status', status, count(*) FROM raw_incidents WHERE status IS NULL OR status NOT IN {in_list(STATUSES)} GROUP BY 2"""),
    Query("timestamp_range_check", lambda t: quality.timestamp_range_check(t.incidents, datetime(2024, 1, 15)), """
        SELECT min(timestamp) AS first, max(timestamp) AS last, min(timestamp) > TIMESTAMP '2024-01-15' OR max(timestamp) < TIMESTAMP '2020-01-01' AS unusual FROM incidents"""),
    Query("login_rate_check", lambda t: quality.login_rate_check(cleaning.clean_logins(t.logins)), f"""
        SELECT {r6('avg(CAST(success AS INT))')} AS success_rate, avg(CAST(success AS INT)) > 0.95 OR avg(CAST(success AS INT)) < 0.05 AS unusual FROM logins_cleaned""", CLEAN_LOGINS),
    Query("quality_report", _quality, "\nUNION ALL ".join([
        _metric_sql("incidents", "total_records", "count(*)", "incidents_cleaned"),
        _metric_sql("incidents", "first", _TS.format("min(timestamp)"), "incidents_cleaned"),
        _metric_sql("incidents", "last", _TS.format("max(timestamp)"), "incidents_cleaned"),
        _metric_sql("incidents", "unique_ips", "count(DISTINCT source_ip)", "incidents_cleaned"),
        *[_metric_sql("incidents", f"missing_{c}", f"count(*) - count({c})", "incidents_cleaned") for c in _INC_COLS],
        "SELECT 'incidents', 'severity_' || severity, CAST(count(*) AS VARCHAR) FROM incidents_cleaned GROUP BY 2",
        _metric_sql("logins", "total_records", "count(*)", "logins_cleaned"),
        _metric_sql("logins", "first", _TS.format("min(login_time)"), "logins_cleaned"),
        _metric_sql("logins", "last", _TS.format("max(login_time)"), "logins_cleaned"),
        _metric_sql("logins", "unique_ips", "count(DISTINCT ip_address)", "logins_cleaned"),
        *[_metric_sql("logins", f"missing_{c}", f"count(*) - count({c})", "logins_cleaned") for c in _LOG_COLS],
        _metric_sql("logins", "success_rate", "printf('%.6f', avg(CAST(success AS INT)))", "logins_cleaned"),
        _metric_sql("merged", "total_records", "count(*)", "merged"),
        _metric_sql("merged", "correlated_events", "count(login_login_id)", "merged"),
    ]), MERGED),
    Query("constraint_violations", lambda t: quality.rule_violations({"incidents": t.raw_incidents, "logins": t.logins}, CONSTRAINTS),
          violation_sql(CONSTRAINTS, {"incidents": "raw_incidents", "logins": "logins"})),
    Query("dictionary_validation", _dictionary, violation_sql(DICTIONARY, _REPORTED), MERGED),
]

# --- E: the report suite -----------------------------------------------------------------------
REPORTS = [
    Query("daily_trend", lambda t: incident_sql.daily_trend(t.incidents), """
        SELECT CAST(timestamp AS DATE) AS incident_date, count(*) AS total_incidents, count(CASE WHEN severity = 'Critical' THEN 1 END) AS critical_count,
          count(CASE WHEN severity = 'High' THEN 1 END) AS high_count, count(CASE WHEN severity = 'Medium' THEN 1 END) AS medium_count,
          count(CASE WHEN severity = 'Low' THEN 1 END) AS low_count FROM incidents GROUP BY 1"""),
    Query("hourly_pattern", lambda t: incident_sql.hourly_pattern(t.incidents),
          f"SELECT strftime(timestamp, '%H') AS hour_of_day, count(*) AS incident_count, {r6(f'avg({ZERO})')} AS avg_severity_score FROM incidents GROUP BY 1"),
    Query("weekly_trend", lambda t: incident_sql.weekly_trend(t.incidents), f"""
        SELECT strftime(timestamp, '%Y-%W') AS week, count(*) AS weekly_incidents, count(DISTINCT source_ip) AS unique_attackers, {r6(f'avg({ZERO})')} AS avg_severity
        FROM incidents GROUP BY 1"""),
    Query("event_type_success", lambda t: incident_sql.event_type_success(t.incidents), f"""
        SELECT event_type, count(*) AS total_events, {OK} AS successful_attempts, round(CAST({OK} AS DOUBLE) / count(*), 3) AS success_rate,
          {r6(f'avg({ZERO})')} AS avg_severity FROM incidents GROUP BY 1"""),
    Query("event_type_daily", lambda t: incident_sql.event_type_daily(t.incidents),
          f"SELECT CAST(timestamp AS DATE) AS date, event_type, count(*) AS daily_count, {OK} AS successful_count FROM incidents GROUP BY 1, 2"),
    Query("severity_distribution", lambda t: incident_sql.severity_distribution(t.incidents), """
        SELECT severity, count(*) AS count, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM incidents), 3) AS percentage,
          count(DISTINCT source_ip) AS unique_ips, count(DISTINCT location) AS unique_locations FROM incidents GROUP BY 1"""),
    Query("severity_by_event_type", lambda t: incident_sql.severity_by_event_type(t.incidents), """
        SELECT event_type, severity, count(*) AS count, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY event_type), 3) AS severity_percentage
        FROM incidents GROUP BY 1, 2"""),
    Query("top_attackers", lambda t: incident_sql.top_attackers(t.incidents), f"""
        SELECT source_ip, count(*) AS total_incidents, count(DISTINCT event_type) AS unique_event_types, max(severity) AS max_severity,
          ['Unknown', 'Low', 'Medium', 'High', 'Critical'][max({ZERO}) + 1] AS max_severity_ranked, {OK} AS successful_attacks,
          round(CAST({OK} AS DOUBLE) / count(*), 3) AS success_rate, string_agg(DISTINCT location, ',' ORDER BY location) AS locations,
          min(timestamp) AS first_seen, max(timestamp) AS last_seen FROM incidents GROUP BY 1 ORDER BY total_incidents DESC, source_ip LIMIT 20"""),
    Query("persistent_attackers", lambda t: incident_sql.persistent_attackers(t.incidents), f"""
        SELECT source_ip, count(DISTINCT CAST(timestamp AS DATE)) AS active_days, count(*) AS total_incidents, {r6(f'avg({ZERO})')} AS avg_severity
        FROM incidents GROUP BY 1 HAVING active_days > 1 ORDER BY active_days DESC, total_incidents DESC, source_ip LIMIT 15"""),
    Query("sql_risk_score", lambda t: incident_sql.sql_risk_score(t.incidents), """
        SELECT source_ip, incident_frequency, round(w, 2) AS severity_weight, round(incident_frequency * w, 2) AS risk_score, event_type_diversity, persistence_days,
          CASE WHEN round(incident_frequency * w, 2) >= 50 THEN 'Critical' WHEN round(incident_frequency * w, 2) >= 25 THEN 'High'
               WHEN round(incident_frequency * w, 2) >= 10 THEN 'Medium' ELSE 'Low' END AS risk_level, last_incident
        FROM sw ORDER BY risk_score DESC, source_ip LIMIT 25""", f"""
        sw AS (SELECT source_ip, count(*) AS incident_frequency, avg({ZERO}) AS w, count(DISTINCT event_type) AS event_type_diversity,
          count(DISTINCT CAST(timestamp AS DATE)) AS persistence_days, max(timestamp) AS last_incident FROM incidents GROUP BY 1)"""),
    Query("geo_risk_summary", lambda t: incident_sql.geo_risk_summary(t.incidents), f"""
        SELECT location, count(*) AS total_incidents, count(DISTINCT source_ip) AS unique_attackers, {r6(f'avg({ZERO})')} AS avg_severity, {OK} AS successful_attacks,
          round(CAST({OK} AS DOUBLE) / count(*), 3) AS success_rate FROM incidents WHERE location IS NOT NULL AND location <> 'Unknown' GROUP BY 1"""),
    Query("device_targeting", lambda t: incident_sql.device_targeting(t.incidents), """
        SELECT destination_device, count(*) AS total_incidents, count(DISTINCT source_ip) AS unique_attackers, count(DISTINCT event_type) AS unique_event_types,
          string_agg(DISTINCT severity, ',' ORDER BY severity) AS severities_seen, min(timestamp) AS first_attack, max(timestamp) AS last_attack
        FROM incidents GROUP BY 1"""),
    Query("filter_critical", lambda t: incident_sql.filter_critical(t.incidents), "SELECT * FROM incidents WHERE severity = 'Critical'"),
]


# --- F: exploration ----------------------------------------------------------------------------
def _calendar_sql(names, key: str, value: str) -> str:
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return (f"SELECT CAST(position AS BIGINT) AS position, {key}, incidents FROM (VALUES {rows}) v(position, {key}) "
            f"LEFT JOIN (SELECT {value} AS k, count(*) AS incidents FROM scored GROUP BY 1) c ON c.k = v.{key}")


EXPLORE = [
    Query("severity_counts", lambda t: explore.severity_counts(t.incidents), "SELECT severity, count(*) AS count FROM incidents GROUP BY 1"),
    Query("top_event_types", lambda t: explore.top_event_types(t.incidents), "SELECT event_type, count(*) AS count FROM incidents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    Query("top_locations", lambda t: explore.top_locations(t.incidents),
          "SELECT location, count(*) AS count FROM incidents WHERE location IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    Query("login_success_counts", lambda t: explore.login_success_counts(t.logins),
          f"SELECT success, count(*) AS count, {r6('count(*) * 100 / (SELECT count(*) FROM logins)')} AS percent FROM logins GROUP BY 1"),
    Query("hourly_counts", lambda t: explore.hourly_counts(t.incidents), "SELECT hour, count(*) AS incidents FROM scored GROUP BY 1"),
    Query("weekday_counts", lambda t: explore.weekday_counts(t.incidents), _calendar_sql(WEEKDAYS, "day_of_week", "day_of_week")),
    Query("key_metrics", lambda t: explore.key_metrics(t.incidents, t.logins), f"""
        SELECT i.*, l.*, {r6('successful_logins * 100 / total_login_attempts')} AS login_success_rate, {r6('critical_incidents * 100 / total_incidents')} AS critical_incident_rate
        FROM (SELECT count(*) AS total_incidents, count(*) FILTER (WHERE severity = 'Critical') AS critical_incidents, count(*) FILTER (WHERE severity = 'High') AS high_incidents,
          count(DISTINCT event_type) AS unique_event_types, count(DISTINCT source_ip) AS unique_source_ips, count(DISTINCT location) AS unique_locations,
          {r6('avg(severity_score)')} AS avg_severity_score FROM scored) i,
         (SELECT count(*) AS total_login_attempts, count(*) FILTER (WHERE success = 'Yes') AS successful_logins, count(*) FILTER (WHERE success = 'No') AS failed_logins,
          count(DISTINCT user_id) AS unique_users, count(DISTINCT ip_address) AS unique_login_ips FROM logins) l"""),
]

# --- G: time series ----------------------------------------------------------------------------
DAILY = """
di AS (SELECT date, count(*) AS incidents FROM scored GROUP BY 1),
dl AS (SELECT CAST(login_time AS DATE) AS date, count(*) AS login_attempts FROM logins GROUP BY 1),
activity AS (SELECT coalesce(di.date, dl.date) AS date, coalesce(incidents, 0) AS incidents, coalesce(login_attempts, 0) AS login_attempts FROM di FULL JOIN dl ON di.date = dl.date)
"""
SECURITY = """
im AS (SELECT date, count(event_id) AS incident_count, avg(severity_score) AS avg_severity, count(DISTINCT source_ip) AS unique_ips FROM scored GROUP BY 1),
lm AS (SELECT CAST(login_time AS DATE) AS date, count(login_id) AS total_logins, count(*) FILTER (WHERE success = 'Yes') AS successful_logins,
  count(*) FILTER (WHERE success <> 'Yes') AS failed_logins, count(*) FILTER (WHERE success = 'Yes') / count(login_id) AS login_success_rate FROM logins GROUP BY 1),
daily AS (SELECT coalesce(im.date, lm.date) AS date, coalesce(incident_count, 0) AS incident_count, coalesce(avg_severity, 0) AS avg_severity, coalesce(unique_ips, 0) AS unique_ips,
  coalesce(total_logins, 0) AS total_logins, coalesce(successful_logins, 0) AS successful_logins, coalesce(failed_logins, 0) AS failed_logins,
  coalesce(login_success_rate, 0) AS login_success_rate FROM im FULL JOIN lm ON im.date = lm.date)
"""
_HOURS = ", ".join(f"count(*) FILTER (WHERE hour = {h}) AS h{h:02d}" for h in range(24))
_WEEKDAY_CASE = "CASE day_of_week " + " ".join(f"WHEN '{d}' THEN {i}" for i, d in enumerate(WEEKDAYS)) + " END"
_MONTH_CASE = "CASE month_name " + " ".join(f"WHEN '{d}' THEN {i}" for i, d in enumerate(MONTHS)) + " END"

TIMESERIES = [
    Query("daily_incidents", lambda t: timeseries.daily_incidents(t.incidents), "SELECT * FROM di", DAILY),
    Query("daily_logins", lambda t: timeseries.daily_logins(t.logins), "SELECT * FROM dl", DAILY),
    Query("moving_average_calendar", lambda t: timeseries.moving_average_calendar(t.incidents), f"""
        SELECT date, incidents, {r6('avg(incidents) OVER (ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)')} AS ma
        FROM (SELECT CAST(timestamp AS DATE) AS date, count(*) AS incidents FROM incidents GROUP BY 1)"""),
    Query("moving_average_7", lambda t: timeseries.moving_average_7(t.incidents), f"""
        SELECT date, incidents, CASE WHEN count(*) OVER w = 7 THEN {r6('avg(incidents) OVER w')} END AS ma_7 FROM di
        WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", DAILY),
    Query("daily_activity", lambda t: timeseries.daily_activity(t.incidents, t.logins), "SELECT * FROM activity", DAILY),
    Query("daily_trend_line", lambda t: timeseries.daily_trend_line(t.incidents, t.logins), f"""
        SELECT date, incidents, login_attempts, {r6('s')} AS slope, {r6('i')} AS intercept, {r6('s * login_attempts + i')} AS fitted FROM activity,
         (SELECT regr_slope(incidents, login_attempts) AS s, regr_intercept(incidents, login_attempts) AS i FROM activity)""", DAILY),
    Query("temporal_stats", lambda t: timeseries.temporal_stats(t.incidents, t.logins), f"""
        SELECT (SELECT min(date) FROM di) AS first_date, (SELECT max(date) FROM di) AS last_date, {r6('(SELECT avg(incidents) FROM di)')} AS avg_daily_incidents,
          (SELECT max(incidents) FROM di) AS peak_daily_incidents, {r6('(SELECT avg(login_attempts) FROM dl)')} AS avg_daily_logins,
          {r6('(SELECT corr(incidents, login_attempts) FROM activity)')} AS daily_correlation""", DAILY),
    Query("hour_by_severity", lambda t: timeseries.hour_by_severity(t.incidents),
          "SELECT hour, " + ", ".join(f"count(*) FILTER (WHERE severity = '{s}') AS \"{s}\"" for s in SEVERITIES) + " FROM scored GROUP BY 1"),
    Query("weekday_pattern", lambda t: timeseries.weekday_pattern(t.incidents), _calendar_sql(WEEKDAYS, "day_of_week", "day_of_week")),
    Query("month_pattern", lambda t: explore.month_pattern(t.incidents), _calendar_sql(MONTHS, "month_name", "month_name")),
    Query("weekday_by_hour", lambda t: timeseries.weekday_by_hour(t.incidents), f"SELECT day_of_week, {_HOURS} FROM scored GROUP BY 1"),
    Query("peaks", lambda t: timeseries.peaks(t.incidents), f"""
        SELECT (SELECT hour FROM scored GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_hour,
          (SELECT day_of_week FROM scored GROUP BY 1 ORDER BY count(*) DESC, {_WEEKDAY_CASE} LIMIT 1) AS peak_day,
          (SELECT month_name FROM scored GROUP BY 1 ORDER BY count(*) DESC, {_MONTH_CASE} LIMIT 1) AS peak_month"""),
]

# --- H: geography ------------------------------------------------------------------------------
LOC = """
ls AS (SELECT location, count(*) AS total_incidents, avg(severity_score) AS avg_severity, count(DISTINCT source_ip) AS unique_ips FROM scored WHERE location IS NOT NULL GROUP BY 1)
"""
GEO = [
    Query("location_stats", lambda t: geo.location_stats(t.prepared), f"SELECT location, total_incidents, {r6('avg_severity')} AS avg_severity, unique_ips FROM ls", LOC),
    Query("global_location_mean", lambda t: geo.global_location_mean(t.prepared), f"SELECT {r6('avg(avg_severity)')} AS global_avg_severity FROM ls", LOC),
    Query("severity_mix_by_location", lambda t: geo.severity_mix_by_location(t.prepared),
          "SELECT location, " + ", ".join(f"{r6(f'''count(*) FILTER (WHERE severity = '{s}') * 100 / count(*)''')} AS {s.lower()}" for s in SEVERITIES)
          + " FROM scored WHERE location IN (SELECT location FROM ls ORDER BY total_incidents DESC, location LIMIT 10) GROUP BY 1", LOC),
    Query("high_risk_locations", lambda t: geo.high_risk_locations(t.prepared), f"""
        SELECT location, total_incidents, {r6('avg_severity')} AS avg_severity, unique_ips, {r6('q')} AS severity_limit
        FROM ls, (SELECT quantile_cont(avg_severity, 0.75) AS q FROM ls) WHERE avg_severity > q""", LOC),
    Query("location_overview", lambda t: geo.location_overview(t.prepared), f"""
        SELECT (SELECT location FROM ls ORDER BY total_incidents DESC, location LIMIT 1) AS most_active_location, max(total_incidents) AS most_active_count,
          count(*) AS total_locations, {r6('avg(total_incidents)')} AS avg_incidents_per_location FROM ls""", LOC),
    Query("critical_hotspot", lambda t: geo.critical_hotspot(t.prepared), """
        SELECT location, count(*) AS critical_count FROM incidents WHERE severity = 'Critical' AND location IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""),
]

QUERIES = [*SOURCES, *CLEANING, *JOINS, *QUALITY, *REPORTS, *EXPLORE, *TIMESERIES, *GEO]
