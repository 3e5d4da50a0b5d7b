"""Every registered query against DuckDB, and the shape of the plans."""

import os
import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bench import HEADLINE
from check import compare
from small_tables import SMALL
from watchledger.operators import correlate, event_risk, incident_sql, ordering, patterns, source_risk, timeseries

QUERIES, SQL = queries(), oracle_sql()


# Corpus queries are compared by their own tests.  WATCHLEDGER_QUICK=1 keeps to the headline queries.
CHECKED = {n for n in SQL if not n.startswith("op") and n != "pipeline"}
if os.environ.get("WATCHLEDGER_QUICK"):
    CHECKED &= set(HEADLINE)
UNCHECKED = {n for n in HEADLINE if n in QUERIES and n not in SQL and not n.startswith("op")}


@pytest.mark.parametrize("name", sorted(CHECKED))
def test_equals_duckdb(spark, name):
    result = compare(spark, name, QUERIES[name], SQL[name], SMALL)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", sorted(UNCHECKED))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


PLANS = {
    "correlate": lambda t: correlate.correlate(t.incidents, t.logins),
    "top_attackers": lambda t: incident_sql.top_attackers(t.incidents),
    "ip_correlation": lambda t: incident_sql.ip_incident_login_correlation(t.incidents, t.logins),
    "source_metrics": lambda t: source_risk.source_metrics(t.incidents),
    "event_ensemble": lambda t: event_risk.event_ensemble(t.prepared, use_anomaly=False),
    "trailing_count": lambda t: ordering.trailing_count(t.prepared, "timestamp"),
    "sequences": lambda t: patterns.ip_sequences(t.prepared),
    "daily": lambda t: timeseries.daily_security_metrics(t.prepared, t.logins),
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_cross_joins_and_no_row_python(tables, name):
    plan = plan_of(PLANS[name](tables))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["correlate", "sequences", "source_metrics", "top_attackers"])
def test_no_row_level_window_without_keys(tables, name):
    """An un-keyed window may only run over one row per slice."""
    for line in plan_of(PLANS[name](tables)).splitlines():
        if "Window [" in line and re.search(r"windowspecdefinition\((?!.*_slice)", line):
            assert "ORDER BY" not in line or "source_ip" in line, line


def test_filter_and_columns_reach_the_scan(tables):
    plan = plan_of(incident_sql.daily_trend(tables.incidents))
    assert "In(event_type" in plan.split("PushedFilters")[1]
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "props" not in read
