"""Inspection and data-quality reports in long form, each from one or two aggregates."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from watchledger.functions.cleaning import coerce_timestamp, is_ip, strip
from watchledger.operators.ordering import exact_quantiles
from watchledger.schemas import SEVERITIES, STATUSES, Rule


def _unpivot(one_row: DataFrame, names: list[str], fields: list[str], key: str = "column") -> DataFrame:
    """One row of structs, one struct per column, to one row per column."""
    entries = [F.struct(F.lit(c).alias(key), *[F.col(f"`{c}`.{f}").alias(f) for f in fields]) for c in names]
    return one_row.select(F.inline(F.array(*entries)))


def _per_column(df: DataFrame, names: list[str], **measures) -> DataFrame:
    aggs = [F.struct(*[m(c).alias(k) for k, m in measures.items()]).alias(c) for c in names]
    return _unpivot(df.agg(*aggs), names, list(measures))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def sample_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def describe_table(df: DataFrame) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    names = numeric_columns(df)
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in names]
    # Equal values meet before anything is shuffled in full.
    counts = df.select(F.inline(F.array(*pairs))).where("value is not null").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    quartiles = exact_quantiles(counts, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by=["column"], weight="n")
    moments = _per_column(
        df, names, count=lambda c: F.count(c), mean=lambda c: F.avg(c), std=lambda c: F.stddev_samp(c),
        min=lambda c: F.min(c).cast("double"), max=lambda c: F.max(c).cast("double"),
    )
    return moments.join(F.broadcast(quartiles), "column", "left")  # one row per column


def table_info(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    return _per_column(df, df.columns, dtype=lambda c: F.any_value(F.lit(types[c])), non_null=lambda c: F.count(c))


def dtype_profile(df: DataFrame) -> DataFrame:
    """Column types: schema metadata only."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def missing_profile(df: DataFrame) -> DataFrame:
    return _per_column(
        df, df.columns, missing=lambda c: F.count_if(F.col(c).isNull()),
        missing_percent=lambda c: F.try_divide(F.count_if(F.col(c).isNull()) * 100.0, F.count(F.lit(1))),
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each full-row group; nulls compare equal."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")).withColumn(
        "duplicate_percent", F.try_divide(F.col("duplicates") * 100.0, F.col("rows")))


def cardinality_profile(df: DataFrame, list_up_to: int = 10, approximate: bool = False) -> DataFrame:
    """Distinct values per text column; the values themselves when there are few.

    ``approximate`` counts by sketch in one pass, without moving values, and lists none.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names]
    if approximate:
        return df.select(F.inline(F.array(*pairs))).groupBy("column").agg(F.approx_count_distinct("value", 0.02).alias("unique_values")).withColumn("values", F.lit(None).cast("string"))
    values = df.select(F.inline(F.array(*pairs))).where("value is not null").distinct()
    counts = values.groupBy("column").agg(F.count("value").alias("unique_values"))
    # Only columns with few values reach the list aggregate.
    few = values.join(F.broadcast(counts.where(F.col("unique_values") <= list_up_to)), "column", "left_semi")
    lists = few.groupBy("column").agg(F.array_join(F.array_sort(F.collect_set("value")), ",").alias("values"))
    return counts.join(F.broadcast(lists), "column", "left")


def coerce_report(df: DataFrame, column: str) -> DataFrame:
    """Values that are present but do not parse."""
    parsed = coerce_timestamp(F.col(column))
    return df.agg(
        F.count_if(F.col(column).isNotNull() & parsed.isNull()).alias("conversion_errors"),
        F.count(parsed).alias("parsed"), F.count(F.lit(1)).alias("rows"),
    )


def invalid_domain_values(df: DataFrame) -> DataFrame:
    """Distinct severities and statuses outside their domain; null counts as invalid."""

    def outside(column: str, allowed: list[str]) -> DataFrame:
        bad = F.col(column).isNull() | ~F.col(column).isin(allowed)
        return df.where(bad).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(column).alias("column"), "value", "rows")

    return outside("severity", SEVERITIES).unionByName(outside("status", STATUSES))


def timestamp_range_check(df: DataFrame, now: datetime, column: str = "timestamp", oldest: datetime = datetime(2020, 1, 1)) -> DataFrame:
    lit = lambda t: F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last")).withColumn(
        "unusual", F.coalesce((F.col("first") > lit(now)) | (F.col("last") < lit(oldest)), F.lit(False)))


def login_rate_check(cleaned_logins: DataFrame) -> DataFrame:
    """Flags success rates above .95 or below .05; takes the boolean outcome."""
    rate = cleaned_logins.agg(F.avg(F.col("success").cast("double")).alias("success_rate"))
    return rate.withColumn("unusual", (F.col("success_rate") > 0.95) | (F.col("success_rate") < 0.05))


def _metrics(df: DataFrame, section: str, metrics: dict[str, Column]) -> DataFrame:
    row = df.agg(*[c.cast("string").alias(k) for k, c in metrics.items()])
    entries = [F.struct(F.lit(k).alias("metric"), F.col(f"`{k}`").alias("value")) for k in metrics]
    return row.select(F.inline(F.array(*entries))).select(F.lit(section).alias("section"), "metric", "value")


def quality_report(incidents: DataFrame, logins: DataFrame, merged: DataFrame) -> DataFrame:
    """Totals, ranges, distinct addresses, nulls, severity counts, success rate, correlated rows."""
    nulls = lambda df: {f"missing_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    inc = _metrics(incidents, "incidents", {
        "total_records": F.count(F.lit(1)), "first": F.min("timestamp"), "last": F.max("timestamp"),
        "unique_ips": F.count_distinct("source_ip"), **nulls(incidents),
    })
    severities = incidents.where("severity is not null").groupBy("severity").agg(F.count(F.lit(1)).cast("string").alias("value")).select(
        F.lit("incidents").alias("section"), F.concat(F.lit("severity_"), "severity").alias("metric"), "value")
    log = _metrics(logins, "logins", {
        "total_records": F.count(F.lit(1)), "first": F.min("login_time"), "last": F.max("login_time"),
        "unique_ips": F.count_distinct("ip_address"), **nulls(logins),
        "success_rate": F.format_string("%.6f", F.avg(F.col("success").cast("double"))),
    })
    mer = _metrics(merged, "merged", {"total_records": F.count(F.lit(1)), "correlated_events": F.count("login_login_id")})
    return _union([inc, severities, log, mer])


def _violates(rule: Rule) -> Column:
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "in":
        return c.isNotNull() & ~c.isin(list(rule.allowed))
    if rule.kind == "between":
        return c.isNotNull() & ~c.between(*rule.allowed)
    if rule.kind == "positive":
        return c.isNotNull() & (c <= 0)
    if rule.kind == "ip":
        return c.isNotNull() & ~is_ip(c)
    if rule.kind == "not_blank":
        return c.isNotNull() & (F.length(strip(c)) == 0)
    raise ValueError(rule.kind)


def rule_violations(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Violating rows per rule, zero included.

    All row rules of a table share one scan; keys and references each need their own shuffle.
    """
    parts = []
    for name, df in tables.items():
        own = [r for r in rules if r.table == name]
        row_rules = [r for r in own if r.kind not in ("unique", "references")]
        if row_rules:
            counts = df.agg(*[F.count_if(_violates(r)).alias(f"v{i}") for i, r in enumerate(row_rules)])
            entries = [
                F.struct(F.lit(r.column).alias("column"), F.lit(r.kind).alias("rule"), F.col(f"v{i}").alias("violations"))
                for i, r in enumerate(row_rules)
            ]
            parts.append(counts.select(F.inline(F.array(*entries))).withColumn("table", F.lit(name)))
        for r in (r for r in own if r.kind in ("unique", "references")):
            key = df.where(F.col(r.column).isNotNull())
            if r.kind == "unique":
                repeated = key.groupBy(r.column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                count = repeated.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
            else:
                parent = tables[r.parent[0]].select(F.col(r.parent[1]).alias(r.column))
                # Repeated foreign keys shrink before the join.
                keys = key.groupBy(r.column).agg(F.count(F.lit(1)).alias("n"))
                count = keys.join(parent, r.column, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
            parts.append(count.select(F.lit(r.column).alias("column"), F.lit(r.kind).alias("rule"), "violations", F.lit(name).alias("table")))
    return _union(parts).select("table", "column", "rule", "violations")
