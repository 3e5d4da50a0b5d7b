"""Queries: dashboard measures, alerts, predictions and the streaming forms."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from watchledger.operators import forecast, geo, incident_sql, measures, ordering, quality, relations, shifts, sketches, source_risk, timeseries, trees
from watchledger.plans.registry import Query, r6
from watchledger.plans.reports import CLEAN_FIXTURE, CLEAN_LOGINS, DAILY, LOC, SECURITY, violation_sql
from watchledger.plans.scoring import ANOMALY_SQL, ENSEMBLE_SQL, FINAL_LEVEL, PROFILE_SQL, full_events, full_profile, z_sql
from watchledger.schemas import DICTIONARY
from watchledger.streaming import baselines, jobs, periods
from watchledger.workspace import new_path

_c = F.col

SLIDING = """
SELECT {key}window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS {n}
FROM (SELECT {key}time_bucket(INTERVAL {slide} MINUTE, {ts}, TIMESTAMP '1970-01-01') - k * INTERVAL {slide} MINUTE AS window_start FROM {source}, range({copies}) g(k) WHERE {where})
GROUP BY ALL
"""
SEVERE = SLIDING.format(key="", n="severe_incidents", slide=15, copies=4, ts="timestamp", source="incidents", where="severity IN ('High', 'Critical')")
FAILED = SLIDING.format(key="ip_address, ", n="failed", slide=15, copies=4, ts="login_time", source="logins", where="success = 'No'")
CATEGORY = "CASE WHEN ensemble_risk_score >= 80 THEN 'Critical' WHEN ensemble_risk_score >= 55 THEN 'High' WHEN ensemble_risk_score >= 30 THEN 'Medium' ELSE 'Low' END"
WEEKLY = """
weekly AS (SELECT CAST(date_trunc('week', timestamp) AS DATE) AS week_start, count(*) AS incidents, CAST(sum(severity_score) AS BIGINT) AS risk FROM scored GROUP BY 1)
"""
TYPES = ["Data Exfiltration", "Failed Login", "Malware", "Phishing Attempt", "Port Scan", "Unauthorized Access"]
PIVOT = "\nper_ip AS (SELECT source_ip, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS t{i}" for i, t in enumerate(TYPES)) + " FROM incidents GROUP BY 1)"
FORECAST = """
dx AS (SELECT *, date_diff('day', DATE '1970-01-01', date) AS x FROM di),
fit AS (SELECT regr_slope(incidents, x) AS s, avg(x) AS mx, avg(incidents) AS my, max(date) AS last FROM dx),
season AS (SELECT isodow(date) AS w, avg(incidents - (my + s * (x - mx))) AS seasonal FROM dx, fit GROUP BY 1),
future AS (SELECT CAST(last + CAST(k AS INTEGER) AS DATE) AS date, my + s * (date_diff('day', DATE '1970-01-01', last) + k - mx) AS trend FROM fit, range(1, 8) g(k))
"""


#: Everything that shared devices reach, pair by pair.
GROUPS = """
met AS (SELECT DISTINCT source_ip, destination_device AS d, date_trunc('{grain}', timestamp) AS p FROM scored WHERE source_ip IS NOT NULL),
linked AS (SELECT DISTINCT a.source_ip AS a, b.source_ip AS b FROM met a JOIN met b USING (d, p)),
reached AS (WITH RECURSIVE r AS (SELECT a, b FROM linked UNION SELECT r.a, l.b FROM r JOIN linked l ON r.b = l.a) SELECT a AS source_ip, min(b) AS group_id FROM r GROUP BY a)
"""
def shift_sql(counted: str, limit: int, slack: int = 1000) -> str:
    """The cumulative sums carried from day to day."""
    sides = {"more": f"x - level - floor(level * 0.5) - {slack}", "fewer": f"level - floor(level * 0.5) - {slack} - x"}
    carried = " UNION ALL ".join(f"""
SELECT user_id, direction, min(day) AS first_day, min(day) FILTER (WHERE s > {limit}) AS alarm_day, max(day) AS last_day, max(s) / 1e3 AS excess, arg_min(level, day) / 1e3 AS level_before,
  arg_max(so_far, (s, -i)) / (arg_max(i, (s, -i)) - min(i) + 1) AS level_during
FROM (SELECT *, '{name}' AS direction, sum(logins) OVER (PARTITION BY user_id, stretch ORDER BY day) AS so_far FROM (
  WITH RECURSIVE r AS (
    SELECT user_id, i, day, logins, level, greatest(0, {d}) AS s, CASE WHEN {d} <= 0 THEN 1 ELSE 0 END AS stretch FROM lv WHERE i = 8
    UNION ALL SELECT lv.user_id, lv.i, lv.day, lv.logins, lv.level, greatest(0, r.s + {d.replace('level', 'lv.level')}), r.stretch + CASE WHEN r.s + {d.replace('level', 'lv.level')} <= 0 THEN 1 ELSE 0 END
      FROM r JOIN lv ON lv.user_id = r.user_id AND lv.i = r.i + 1)
  SELECT * FROM r WHERE s > 0)) GROUP BY user_id, direction, stretch""" for name, d in sides.items())
    return f"""
SELECT * FROM (WITH cells AS (SELECT user_id, CAST(login_time AS DATE) AS day, sum({counted}) AS n FROM logins GROUP BY ALL),
dense AS (SELECT user_id, CAST(d AS DATE) AS day FROM (SELECT user_id, unnest(generate_series(min(day), (SELECT max(day) FROM cells), INTERVAL 1 DAY)) AS d FROM cells GROUP BY user_id)),
ds AS (SELECT user_id, day, coalesce(n, 0) AS logins, row_number() OVER (PARTITION BY user_id ORDER BY day) AS i FROM dense LEFT JOIN cells USING (user_id, day)),
lv AS (SELECT *, CAST(logins * 1000 AS DOUBLE) AS x, floor(sum(logins) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) * 1000 / 7) AS level FROM ds)
SELECT user_id, direction, first_day, alarm_day, last_day, {r6('excess')} AS excess, {r6('level_before')} AS level_before, {r6('level_during')} AS level_during
FROM ({carried}) WHERE alarm_day IS NOT NULL)"""


#: Triple exponential smoothing carried from day to day; the season is a list of seven values.
SMOOTHED = """
cells AS (SELECT json_object('event_type', event_type, 'location', location)::VARCHAR AS series, date, count(*) AS n FROM scored GROUP BY ALL UNION ALL SELECT NULL, date, count(*) FROM scored GROUP BY date),
dense AS MATERIALIZED (SELECT s.series, d.t, d.date, coalesce(n, 0) AS n FROM (SELECT DISTINCT series FROM cells) s
  CROSS JOIN (SELECT CAST(x AS DATE) AS date, row_number() OVER (ORDER BY x) - 1 AS t FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS x FROM cells)) d
  LEFT JOIN cells ON cells.series IS NOT DISTINCT FROM s.series AND cells.date = d.date),
first AS (SELECT series, sum(n)::DOUBLE / 7 AS level, list(n::DOUBLE ORDER BY t) AS ns FROM dense WHERE t < 7 GROUP BY series),
states AS MATERIALIZED (SELECT * FROM (WITH RECURSIVE r AS (
  SELECT series, CAST(6 AS BIGINT) AS t, level, 0e0::DOUBLE AS trend, list_transform(ns, lambda x: x - first.level) AS season FROM first
  UNION ALL SELECT series, t, level, trend, list_concat(season[1 : t % 7], list_concat([0.2e0 * (n - level) + (1 - 0.2e0) * season[t % 7 + 1]], season[t % 7 + 2 : 7])) FROM (
    SELECT series, t, n, level, 0.05e0 * (level - before) + (1 - 0.05e0) * trend AS trend, season FROM (
      SELECT r.series, d.t, d.n, 0.3e0 * (d.n - r.season[d.t % 7 + 1]) + (1 - 0.3e0) * (r.level + r.trend) AS level, r.level AS before, r.trend, r.season
      FROM r JOIN dense d ON d.t = r.t + 1 AND d.series IS NOT DISTINCT FROM r.series)))
  SELECT * FROM r)),
made AS (SELECT series, t, h AS horizon, level + h * trend + season[(t + h) % 7 + 1] AS f FROM states CROSS JOIN range(1, 8) g(h)),
tested AS (SELECT m.series, horizon, sqrt(avg((n - f) * (n - f))) AS error, count(*) AS origins FROM made m JOIN dense d ON d.series IS NOT DISTINCT FROM m.series AND d.t = m.t + horizon
  WHERE m.t >= 13 GROUP BY ALL),
newest AS (SELECT m.series, CAST((SELECT max(date) FROM dense) + CAST(m.horizon AS INTEGER) AS DATE) AS date, m.horizon, greatest(f, 0) AS forecast, error, coalesce(origins, 0) AS origins FROM made m
  LEFT JOIN tested e ON e.series IS NOT DISTINCT FROM m.series AND e.horizon = m.horizon WHERE t = (SELECT max(t) FROM dense)),
reconciled AS (SELECT a.*, CASE WHEN series IS NULL THEN forecast ELSE forecast * whole / parts END AS reconciled FROM newest a
  JOIN (SELECT horizon, sum(forecast) FILTER (WHERE series IS NOT NULL) AS parts, sum(forecast) FILTER (WHERE series IS NULL) AS whole FROM newest GROUP BY 1) USING (horizon))
"""
_SKETCHED = ["source_ip", "destination_device", "location", "event_type"]
DAYS = "days AS (SELECT DISTINCT CAST(d AS DATE) AS until FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM scored))"


def _sketched(t):
    """The published sketch table of the incidents, read back."""
    path = new_path(t.spark, "sketches")
    sketches.publish_sketches(t.incidents, path, "timestamp", _SKETCHED)
    return sketches.read_sketches(t.spark, path)


def _rolling_sql(c: str) -> str:
    return f"""SELECT until, '{c}' AS column, count(*) AS rows, count({c}) AS present, count(DISTINCT {c}) AS distinct_values
FROM days JOIN scored ON date BETWEEN until - 6 AND until GROUP BY until"""


def _span_sql(c: str) -> str:
    return f"SELECT '{c}' AS column, count(*) AS rows, count({c}) AS present, count(DISTINCT {c}) AS distinct_values FROM scored WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'"


EARLIER = "earlier AS (SELECT * FROM scored WHERE timestamp < (SELECT date_trunc('week', max(timestamp)) FROM scored)),"


def boost_sql(rounds: int, depth: int, bins: int, shrink: int) -> str:
    """Boosted trees written out level by level, over the weekly features x0 to x3 of ``tr`` (with next week's ``y``) and ``wk``."""
    above = lambda i: " + ".join(f"CAST(x{i} > q{i}[{j}] AS BIGINT)" for j in range(1, bins))
    probabilities = ", ".join(f"{j / bins}e0" for j in range(1, bins))
    parts = [f"""
qs AS (SELECT {', '.join(f'quantile_cont(x{i}, [{probabilities}]) AS q{i}' for i in range(4))} FROM tr),
t0 AS MATERIALIZED (SELECT source_ip, week_start, risk, y, {', '.join(f'{above(i)} AS b{i}' for i in range(4))}, CAST(floor(sum(y) OVER () / count(y) OVER ()) AS BIGINT) AS fitted
  FROM (SELECT source_ip, week_start, risk, x0, x1, x2, x3, CAST(round(y * 1000000) AS HUGEINT) AS y FROM tr
    UNION ALL SELECT source_ip, week_start, risk, x0, x1, x2, x3, NULL FROM wk WHERE week_start = (SELECT max(week_start) FROM wk)), qs)"""]
    for n in range(rounds):
        parts.append(f"\nl{n}_0 AS (SELECT *, 0 AS node FROM t{n})")
        for level in range(depth):
            parts.append(f"""
h{n}_{level} AS (SELECT node, f, b, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(n) OVER (PARTITION BY node, f) AS all_n, sum(s) OVER (PARTITION BY node, f) AS all_s
  FROM (SELECT node, f, b, count(*) AS n, sum(y - fitted) AS s FROM (SELECT node, y, fitted, unnest([0, 1, 2, 3]) AS f, unnest([b0, b1, b2, b3]) AS b FROM l{n}_{level} WHERE y IS NOT NULL) GROUP BY ALL)
  WINDOW w AS (PARTITION BY node, f ORDER BY b)),
c{n}_{level} AS (SELECT node, arg_max((f, b), (CAST(s AS DOUBLE) * CAST(s AS DOUBLE) / n + CAST(all_s - s AS DOUBLE) * CAST(all_s - s AS DOUBLE) / (all_n - n), -f, -b)) AS cut FROM h{n}_{level} WHERE n < all_n GROUP BY node),
l{n}_{level + 1} AS MATERIALIZED (SELECT l.* EXCLUDE (node), 2 * node + CASE WHEN cut IS NOT NULL AND [b0, b1, b2, b3][cut[1] + 1] > cut[2] THEN 1 ELSE 0 END AS node FROM l{n}_{level} l LEFT JOIN c{n}_{level} USING (node))""")
        parts.append(f"""
t{n + 1} AS MATERIALIZED (SELECT l.* EXCLUDE (node, fitted), fitted + coalesce(v, 0) AS fitted FROM l{n}_{depth} l LEFT JOIN
  (SELECT node, CAST(floor(CAST(sum(y - fitted) AS DOUBLE) / (count(*) * {shrink})) AS BIGINT) AS v FROM l{n}_{depth} WHERE y IS NOT NULL GROUP BY node) USING (node))""")
    return ",".join(parts) + f",\nboosted AS (SELECT * FROM t{rounds})"


_GROUPED = "(SELECT source_ip, group_id, count(*) OVER (PARTITION BY group_id) AS group_size FROM reached)"


def determinant(m: list[list[str]]) -> str:
    """Expansion of a determinant of SQL terms."""
    if len(m) == 1:
        return m[0][0]
    minors = [determinant([row[:j] + row[j + 1 :] for row in m[1:]]) for j in range(len(m))]
    return "(" + " ".join(f"{'-' if j % 2 else '+'} {m[0][j]} * {minor}" for j, minor in enumerate(minors)) + ")"


_MATRIX = [[f"c{min(i, j)}{max(i, j)}" + (" + 0.01e0" if i == j else "") for j in range(4)] for i in range(4)]
_MATRIX = [[f"({x})" for x in row] for row in _MATRIX]
_SOLVED = [determinant([[f"d{i}" if j == k else x for j, x in enumerate(row)] for i, row in enumerate(_MATRIX)]) for k in range(4)]
_Z = [f"((x{i} - m{i}) / s{i})" for i in range(4)]
#: Ridge regression by Cramer's rule over the standardised moments.
PREDICTION = f"""
wk AS (SELECT source_ip, CAST(date_trunc('week', timestamp) AS DATE) AS week_start, count(*)::DOUBLE AS x0, coalesce(avg(severity_score), 0) AS x1,
  avg(CASE WHEN status = 'Successful' THEN 1e0 ELSE 0e0 END) AS x2, count(DISTINCT event_type)::DOUBLE AS x3, coalesce(sum(severity_score), 0)::DOUBLE AS risk
  FROM scored WHERE source_ip IS NOT NULL GROUP BY 1, 2),
tr AS (SELECT a.*, coalesce(b.risk, 0) AS y FROM wk a LEFT JOIN wk b ON a.source_ip = b.source_ip AND b.week_start = a.week_start + 7 WHERE a.week_start < (SELECT max(week_start) FROM wk)),
mo AS (SELECT avg(y) AS my, {', '.join(f"avg(x{i}) AS m{i}, CASE WHEN stddev_pop(x{i}) = 0 THEN 1 ELSE stddev_pop(x{i}) END AS s{i}" for i in range(4))} FROM tr),
co AS (SELECT {', '.join(f"avg({_Z[i]} * {_Z[j]}) AS c{i}{j}" for i in range(4) for j in range(i, 4))}, {', '.join(f"avg({_Z[i]} * (y - my)) AS d{i}" for i in range(4))} FROM tr, mo),
fit AS (SELECT {', '.join(f"{top} / {determinant(_MATRIX)} AS b{k}" for k, top in enumerate(_SOLVED))} FROM co)
"""


def _top_ip(t):
    """The most active source, as a one-row subquery."""
    return incident_sql.top_attackers(t.incidents, 1).select("source_ip").scalar()


def _anomaly_alerts(t):
    return measures.alert_anomalies(source_risk.ip_anomaly_scores(t.incidents))


def _detail(t):
    scores = source_risk.ip_basic_risk(t.incidents).select("source_ip", "basic_risk_score", "risk_level")
    return measures.ip_detail(t.incidents, scores, _top_ip(t))


MEASURES = [
    Query("risk_category", lambda t: full_profile(t).select("source_ip", "ensemble_risk_score", measures.risk_category(_c("ensemble_risk_score")).alias("risk_category")),
          f"SELECT source_ip, ensemble_risk_score, {CATEGORY} AS risk_category FROM profile", PROFILE_SQL),
    Query("success_rate_measure", lambda t: measures.success_rate_measure(t.incidents),
          f"""SELECT {r6("count(*) FILTER (WHERE status = 'Successful') / count(*)")} AS success_rate FROM incidents"""),
    Query("incidents_ytd", lambda t: timeseries.incidents_ytd(t.incidents),
          "SELECT date, incidents, CAST(sum(incidents) OVER (PARTITION BY year(date) ORDER BY date) AS BIGINT) AS incidents_ytd FROM di", DAILY),
    Query("kpi_cards", lambda t: measures.kpi_cards(t.incidents, full_events(t)), f"""
        SELECT count(*) AS total_incidents, count(*) FILTER (WHERE severity = 'Critical') AS critical_incidents,
          {r6("count(*) FILTER (WHERE status = 'Successful') / count(*)")} AS success_rate, count(DISTINCT source_ip) AS unique_ips, {r6('avg(ensemble_risk_score)')} AS avg_risk_score,
          (SELECT hour FROM es GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_hour FROM es""", ENSEMBLE_SQL),
    Query("alert_critical_ips", lambda t: measures.alert_critical_ips(full_profile(t)).select("source_ip", "ensemble_risk_score"),
          "SELECT source_ip, ensemble_risk_score FROM profile WHERE ensemble_risk_score > 80", PROFILE_SQL),
    Query("alert_high_ips", lambda t: measures.alert_critical_ips(full_profile(t), 40).select("source_ip", "ensemble_risk_score"),
          "SELECT source_ip, ensemble_risk_score FROM profile WHERE ensemble_risk_score > 40", PROFILE_SQL),
    Query("alert_spikes", lambda t: timeseries.alert_spikes(t.incidents),
          f"SELECT date, incidents, {r6('a')} AS daily_average FROM di, (SELECT avg(incidents) AS a FROM di) WHERE incidents > a * 2", DAILY),
    Query("alert_spikes_mild", lambda t: timeseries.alert_spikes(t.incidents, ratio=1.05),
          f"SELECT date, incidents, {r6('a')} AS daily_average FROM di, (SELECT avg(incidents) AS a FROM di) WHERE incidents > a * 1.05", DAILY),
    Query("alert_severity_clusters", lambda t: measures.alert_severity_clusters(t.incidents), f"SELECT * FROM ({SEVERE}) WHERE severe_incidents >= 5"),
    Query("brute_force_ips", lambda t: measures.brute_force_ips(t.logins), f"""
        SELECT ip_address, max(failed) AS max_failed, count(*) AS windows, min(window_start) AS first_window FROM ({FAILED}) WHERE failed >= 2 GROUP BY 1"""),
    Query("risk_velocity", lambda t: measures.risk_velocity(t.prepared),
          f"SELECT week_start, {r6('risk')} AS risk, {r6('risk - lag(risk) OVER (ORDER BY week_start)')} AS velocity FROM weekly", WEEKLY),
    Query("threat_persistence", lambda t: measures.threat_persistence(t.incidents), """
        SELECT source_ip, date_sub('day', min(timestamp), m) AS days_since_first, date_sub('day', max(timestamp), m) AS days_since_last
        FROM incidents, (SELECT max(timestamp) AS m FROM incidents) GROUP BY source_ip, m"""),
    Query("attack_diversity", lambda t: measures.attack_diversity(t.incidents), "SELECT source_ip, count(DISTINCT event_type) AS attack_diversity FROM incidents GROUP BY 1"),
    Query("period_over_period", lambda t: timeseries.period_over_period(t.incidents), f"""
        SELECT week_start, incidents, p AS previous, incidents - p AS change, {r6('(incidents - p) * 100 / p')} AS change_percent
        FROM (SELECT *, lag(incidents) OVER (ORDER BY week_start) AS p FROM weekly)""", WEEKLY),
    Query("user_login_anomalies", lambda t: measures.user_login_anomalies(t.logins), f"""
        SELECT user_id, attempts, {r6('fail_rate')} AS fail_rate, {r6('z')} AS z_score FROM (SELECT *, {z_sql('fail_rate')} AS z FROM
          (SELECT user_id, count(*) AS attempts, avg(CASE WHEN success = 'No' THEN 1 ELSE 0 END) AS fail_rate FROM logins GROUP BY 1)) WHERE abs(z) > 2"""),
    Query("login_shifts", lambda t: shifts.login_shifts(t.logins, limit=2.0), shift_sql("1", 2000)),
    Query("failed_login_shifts", lambda t: shifts.login_shifts(t.logins, failures_only=True, slack=0.5, limit=1.0), shift_sql("CASE WHEN success = 'No' THEN 1 ELSE 0 END", 1000, 500)),
    Query("incident_forecast", lambda t: timeseries.incident_forecast(t.incidents), f"""
        SELECT date, {r6('trend')} AS trend, {r6('coalesce(seasonal, 0)')} AS seasonal, {r6('greatest(trend + coalesce(seasonal, 0), 0)')} AS forecast
        FROM future LEFT JOIN season ON w = isodow(date)""", DAILY.strip() + "," + FORECAST),
    Query("series_forecast", lambda t: forecast.series_forecast(t.incidents), f"SELECT series, date, horizon, {r6('forecast')} AS forecast, {r6('reconciled')} AS reconciled, {r6('error')} AS error, origins, "
          f"{r6('greatest(reconciled - 1.2815515655446004 * error, 0)')} AS low, {r6('reconciled + 1.2815515655446004 * error')} AS high FROM reconciled", SMOOTHED),
    Query("ip_relationships", lambda t: measures.ip_relationships(t.incidents), """
        SELECT source_ip, destination_device, date, incidents, peers FROM (SELECT *, count(*) OVER (PARTITION BY destination_device, date) - 1 AS peers FROM
          (SELECT source_ip, destination_device, date, count(*) AS incidents FROM scored GROUP BY 1, 2, 3)) WHERE peers > 0"""),
    Query("related_ip_summary", lambda t: measures.related_ip_summary(t.incidents), """
        SELECT a.source_ip, count(DISTINCT (a.destination_device, a.date)) AS shared_links, count(DISTINCT a.destination_device) AS shared_devices, count(*) AS peer_meetings
        FROM links a JOIN links b ON a.destination_device = b.destination_device AND a.date = b.date AND a.source_ip <> b.source_ip GROUP BY 1""",
          "links AS (SELECT DISTINCT source_ip, destination_device, date FROM scored)"),
    Query("source_groups", lambda t: relations.source_groups(t.incidents, "hour"), f"SELECT source_ip, group_id, group_size FROM {_GROUPED}", GROUPS.format(grain="hour")),
    Query("source_groups_daily", lambda t: relations.source_groups(t.incidents), f"SELECT source_ip, group_id, group_size FROM {_GROUPED}", GROUPS.format(grain="day")),
    Query("source_group_summary", lambda t: relations.source_group_summary(t.incidents, "hour"), f"""
        SELECT group_id, group_size, count(*) AS incidents, count(DISTINCT destination_device) AS devices, min(timestamp) AS first_seen, max(timestamp) AS last_seen,
          {r6('avg(severity_score)')} AS avg_severity FROM scored JOIN {_GROUPED} USING (source_ip) WHERE group_size > 1 GROUP BY ALL""", GROUPS.format(grain="hour")),
    Query("rolling_distinct", lambda t: sketches.rolling_profile(_sketched(t)), f"SELECT * FROM ({' UNION ALL '.join(_rolling_sql(c) for c in _SKETCHED)})", DAYS),
    Query("span_distinct", lambda t: sketches.span_profile(_sketched(t), date(2024, 1, 8), date(2024, 1, 14)), f"SELECT * FROM ({' UNION ALL '.join(_span_sql(c) for c in _SKETCHED)})"),
    Query("risk_prediction", lambda t: measures.risk_prediction(t.prepared), f"""
        SELECT source_ip, week_start, {r6('risk')} AS risk, {r6(f"greatest(my + {' + '.join(f'b{i} * (x{i} - m{i}) / s{i}' for i in range(4))}, 0)")} AS predicted_risk
        FROM wk, mo, fit WHERE week_start = (SELECT max(week_start) FROM wk)""", PREDICTION),
    Query("risk_prediction_trees", lambda t: trees.risk_prediction_trees(t.prepared, 3, 2, 8, 2), f"""
        SELECT source_ip, week_start, {r6('risk')} AS risk, {r6('greatest(fitted / 1e6, 0)')} AS predicted_risk FROM boosted WHERE y IS NULL""", PREDICTION.strip() + "," + boost_sql(3, 2, 8, 2)),
    Query("risk_model_errors", lambda t: trees.risk_model_errors(t.prepared, rounds=3, depth=2, bins=8, shrink=2), f"""
        SELECT model, count(*) AS sources, {r6('avg(abs(guess - coalesce(truth, 0)))')} AS mean_absolute_error, {r6('sqrt(avg((guess - coalesce(truth, 0)) ** 2))')} AS root_mean_square_error
        FROM (SELECT source_ip, 'trees' AS model, greatest(fitted / 1e6, 0) AS guess FROM boosted WHERE y IS NULL
          UNION ALL SELECT source_ip, unnest(['linear', 'same again']), unnest([greatest(my + {' + '.join(f'b{i} * (x{i} - m{i}) / s{i}' for i in range(4))}, 0), risk])
          FROM wk, mo, fit WHERE week_start = (SELECT max(week_start) FROM wk))
        LEFT JOIN (SELECT source_ip, coalesce(sum(severity_score), 0)::DOUBLE AS truth FROM scored WHERE timestamp >= (SELECT date_trunc('week', max(timestamp)) FROM scored) GROUP BY 1) USING (source_ip)
        GROUP BY model""", (EARLIER + PREDICTION.strip() + "," + boost_sql(3, 2, 8, 2)).replace("FROM scored WHERE source_ip", "FROM earlier WHERE source_ip")),
    Query("geo_multiplier", lambda t: geo.geo_multiplier(t.prepared), f"""
        SELECT location, {r6('avg_severity')} AS avg_severity, {r6('avg_severity / (SELECT avg(severity_score) FROM scored)')} AS multiplier FROM ls""", LOC),
    Query("attack_type_correlation", lambda t: measures.attack_type_correlation(t.incidents), "\nUNION ALL ".join(
        f"SELECT '{a}' AS type_a, '{b}' AS type_b, {r6(f'corr(t{i}, t{j})')} AS r FROM per_ip" for i, a in enumerate(TYPES) for j, b in enumerate(TYPES)), PIVOT),
    Query("alert_anomalies", _anomaly_alerts, f"""
        SELECT source_ip, frequency, avg_severity, success_rate, event_diversity, avg_hour, location_count, CAST(isolation_score AS BIGINT) AS isolation_score, {r6('zm')} AS z_score_max,
          {r6('za')} AS z_score_avg, anomaly_score, anomaly_level FROM composite WHERE anomaly_level <> 'Normal'""", ANOMALY_SQL),
    Query("treat_outliers", lambda t: measures.treat_outliers(t.base("events").select("event_id", "value", "user_id"), ["value", "user_id"]), f"""
        SELECT event_id, {r6('value')} AS value, user_id, {r6('greatest(least(value, vh), vl)')} AS value_treated, {r6('greatest(least(user_id, uh), ul)')} AS user_id_treated
        FROM events, (SELECT quantile_cont(value, 0.05) AS vl, quantile_cont(value, 0.95) AS vh, quantile_cont(user_id, 0.05) AS ul, quantile_cont(user_id, 0.95) AS uh FROM events)"""),
    Query("quantiles", lambda t: ordering.exact_quantiles(t.base("lineitem").select("l_returnflag", "l_extendedprice"), "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q99": 0.99}, by=["l_returnflag"]), f"""
        SELECT l_returnflag, {r6('quantile_cont(l_extendedprice, 0.25)')} AS q25, {r6('quantile_cont(l_extendedprice, 0.5)')} AS q50,
          {r6('quantile_cont(l_extendedprice, 0.99)')} AS q99 FROM lineitem GROUP BY 1"""),
    Query("risk_vs_frequency", lambda t: measures.risk_vs_frequency(t.incidents, full_profile(t)).select("source_ip", "incident_count", "ensemble_risk_score"),
          "SELECT source_ip, (SELECT count(*) FROM incidents i WHERE i.source_ip = p.source_ip) AS incident_count, ensemble_risk_score FROM profile p", PROFILE_SQL),
    Query("slice_events", lambda t: measures.slice_events(t.incidents, date(2024, 1, 5), date(2024, 1, 20), ["China", "Russia"], ["Malware", "Port Scan"]), """
        SELECT * FROM incidents WHERE timestamp >= DATE '2024-01-05' AND timestamp < DATE '2024-01-21' AND location IN ('China', 'Russia') AND event_type IN ('Malware', 'Port Scan')"""),
    Query("ip_detail", _detail, """
        SELECT i.*, basic_risk_score, CASE WHEN basic_risk_score > 0 AND basic_risk_score <= 5 THEN 'Low' WHEN basic_risk_score <= 15 THEN 'Medium'
          WHEN basic_risk_score <= 30 THEN 'High' ELSE 'Critical' END AS risk_level
        FROM incidents i JOIN src s ON i.source_ip = s.source_ip WHERE i.source_ip = (SELECT source_ip FROM incidents GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""", PROFILE_SQL),
    Query("profile_dictionary", lambda t: quality.rule_violations({"top_risk_profiles": full_profile(t)}, DICTIONARY), violation_sql(DICTIONARY, {"top_risk_profiles": "finals"}),
          f"{PROFILE_SQL.strip()},\nfinals AS (SELECT *, {FINAL_LEVEL} AS final_risk_level FROM profile)"),
    Query("auth_trend", lambda t: timeseries.auth_trend(t.logins), f"SELECT date, total_logins, successful_logins, failed_logins, {r6('login_success_rate')} AS login_success_rate FROM lm", SECURITY),
]

# --- streaming ---------------------------------------------------------------------------------
TEN_MINUTES = SLIDING.format(key="", n="incidents", slide=10, copies=6, ts="timestamp", source="incidents", where="true")
SESSIONS = """
gaps AS (SELECT source_ip, timestamp, CASE WHEN timestamp - lag(timestamp) OVER w > INTERVAL 2 HOUR THEN 1 ELSE 0 END AS starts FROM incidents WINDOW w AS (PARTITION BY source_ip ORDER BY timestamp)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY source_ip ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS s FROM gaps)
"""


def _incidents(t):
    return t.incidents_from(t.stream("events"))


def _logins(t):
    return t.logins_from(t.stream("events"))


def _ended(t):
    return jobs.with_end(_incidents(t), "timestamp")


def _repeated(t):
    """The feed with every fiftieth event delivered twice."""
    return _incidents(t).unionAll(_incidents(t).where("event_id % 50 = 0"))


STREAMS = [
    Query("stream_incident_counts", lambda t: jobs.drain(jobs.stream_incident_counts(_ended(t)), "counts"), """
        SELECT date_trunc('hour', timestamp) AS window_start, date_trunc('hour', timestamp) + INTERVAL 1 HOUR AS window_end, severity, count(*) AS incidents
          FROM incidents GROUP BY ALL"""),
    Query("stream_spikes", lambda t: jobs.drain(jobs.stream_spikes(_ended(t), jobs.hourly_baseline(t.incidents), ratio=1.5), "spikes"), f"""
        SELECT window_start, window_end, incidents, {r6('b')} AS baseline FROM ({TEN_MINUTES})
        JOIN (SELECT hour(h) AS hh, avg(n) AS b FROM (SELECT date_trunc('hour', timestamp) AS h, count(*) AS n FROM incidents GROUP BY 1) GROUP BY 1) ON hh = hour(window_start)
        WHERE incidents > b * 1.5"""),
    Query("stream_campaigns", lambda t: jobs.drain(jobs.stream_campaigns(_ended(t), n=2, gap="2 hours"), "campaigns"), """
        SELECT * FROM (SELECT source_ip, min(timestamp) AS session_start, max(timestamp) + INTERVAL 2 HOUR AS session_end, count(*) AS events FROM numbered GROUP BY source_ip, s)
        WHERE events >= 2""", SESSIONS),
    Query("stream_correlate", lambda t: jobs.drain(jobs.stream_correlate(_ended(t), jobs.with_end(_logins(t), "login_time")), "correlated"), """
        SELECT event_id, timestamp, source_ip, login_id, login_time FROM incidents LEFT JOIN logins ON source_ip = ip_address
          AND login_time >= timestamp - INTERVAL 60 MINUTE AND login_time <= timestamp + INTERVAL 60 MINUTE"""),
    Query("stream_dedupe", lambda t: jobs.drain(jobs.stream_dedupe(_repeated(t)), "unique"), "SELECT * FROM incidents"),
    Query("stream_clean", lambda t: jobs.drain(jobs.stream_clean_incidents(_incidents(t)), "cleaned"), "SELECT * FROM incidents_cleaned", CLEAN_FIXTURE),
    Query("stream_clean_logins", lambda t: jobs.drain(jobs.stream_clean_logins(_logins(t)), "cleaned-logins"), "SELECT * FROM logins_cleaned", CLEAN_LOGINS),
    Query("stream_baseline_spikes", lambda t: baselines.drain_spikes(baselines.stream_baseline_spikes(_ended(t), deviations=1.5, least=0.5)), f"""
        SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, n AS incidents, {r6('mean')} AS expected, {r6('sqrt(variance)')} AS deviation FROM (
          WITH RECURSIVE hours AS (SELECT *, row_number() OVER (PARTITION BY hour(window_start) ORDER BY window_start) AS i
            FROM (SELECT date_trunc('hour', timestamp) AS window_start, count(*) AS n FROM incidents GROUP BY 1)),
          r AS (SELECT window_start, n, i, NULL::DOUBLE AS mean, NULL::DOUBLE AS variance, n::DOUBLE AS m, 0e0::DOUBLE AS v FROM hours WHERE i = 1
            UNION ALL SELECT h.window_start, h.n, h.i, m, v, m + 0.3e0 * (h.n - m), (1 - 0.3e0) * (v + 0.3e0 * (h.n - m) * (h.n - m)) FROM r JOIN hours h ON h.i = r.i + 1 AND hour(h.window_start) = hour(r.window_start))
          SELECT * FROM r) WHERE i > 3 AND n > mean + 1.5e0 * sqrt(variance) + 0.5e0"""),
    Query("stream_ip_periods", lambda t: periods.drain_periods(periods.stream_ip_periods(_ended(t))), """
        SELECT source_ip, min(timestamp) AS period_start, max(timestamp) AS period_end, count(*) AS incidents, CAST(sum(severity_score) AS BIGINT) AS severity_sum, TRUE AS closed
        FROM (SELECT *, sum(CASE WHEN timestamp - before < INTERVAL 6 HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY source_ip ORDER BY timestamp, event_id) AS period
          FROM (SELECT *, lag(timestamp) OVER (PARTITION BY source_ip ORDER BY timestamp, event_id) AS before FROM scored)) GROUP BY source_ip, period"""),
    Query("stream_ip_profile", lambda t: jobs.drain_updates(jobs.stream_ip_profile(_incidents(t)), "source_ip", "profiles"),
          "SELECT source_ip, count(*) AS incidents, CAST(sum(severity_score) AS BIGINT) AS severity_sum, max(timestamp) AS last_seen FROM scored GROUP BY 1"),
]

QUERIES = [*MEASURES, *STREAMS]
