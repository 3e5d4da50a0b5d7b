"""Cleaning and scalar expressions.  Everything stays a built-in column expression."""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.schemas import SEVERITIES, SEVERITY_SCORES, STATUS_WEIGHTS

# Address patterns.
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_BODY = rf"{_OCTET}(\.{_OCTET}){{3}}"
_GROUP = r"[0-9A-Fa-f]{1,4}"
IPV6_FULL = rf"^{_GROUP}(:{_GROUP}){{7}}$"
IPV6_SHORT = rf"^({_GROUP}(:{_GROUP})*)?::({_GROUP}(:{_GROUP})*)?$"


def _lookup(column: Column, table: dict, default: Column | None = None) -> Column:
    """CASE over a fixed table."""
    cases = reduce(lambda chain, kv: chain.when(column == kv[0], F.lit(kv[1])), table.items(), F)
    return cases.otherwise(default) if default is not None else cases


def strip(column: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def title_case(column: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others."""
    pieces = F.split(column, r"(?<=\P{L})")
    capital = lambda piece: F.concat(F.upper(F.left(piece, F.lit(1))), F.lower(F.substr(piece, F.lit(2))))
    return F.array_join(F.transform(pieces, capital), "")


def canon_severity(column: Column) -> Column:
    """Known severities in canonical spelling, unknown values unchanged."""
    return _lookup(F.lower(column), {name.lower(): name for name in SEVERITIES}, column)


def title_severity(column: Column) -> Column:
    return title_case(column)


def is_ipv4(column: Column) -> Column:
    return column.rlike(f"^{IPV4_BODY}$")


def is_ipv6(column: Column) -> Column:
    """Eight groups, or fewer with one ``::``; an IPv4 tail and a zone suffix are allowed."""
    address = F.regexp_replace(column, r"%[^%]+$", "")
    groups = F.regexp_replace(address, f":{IPV4_BODY}$", ":0:0")
    short = groups.rlike(IPV6_SHORT) & (F.size(F.regexp_extract_all(groups, F.lit(_GROUP), F.lit(0))) <= 7)
    return groups.rlike(IPV6_FULL) | short


def is_ip(column: Column) -> Column:
    return is_ipv4(column) | is_ipv6(column)


def clean_ip(column: Column) -> Column:
    """Keep valid addresses, repair by dropping all but digits and dots, else null."""
    stripped = strip(column)
    repaired = F.regexp_replace(stripped, r"[^\p{Nd}.]", "")
    return F.when(is_ip(stripped), stripped).when(is_ipv4(repaired), repaired)


def clean_location(column: Column) -> Column:
    return title_case(strip(column))


def strip_location(column: Column) -> Column:
    return strip(column)


def severity_score(column: Column) -> Column:
    """1 to 4, null for unknown severities."""
    return _lookup(column, SEVERITY_SCORES)


def severity_score_sql(column: Column) -> Column:
    """1 to 4, 0 for unknown severities."""
    return _lookup(column, SEVERITY_SCORES, F.lit(0))


def status_weight(column: Column) -> Column:
    return _lookup(column, STATUS_WEIGHTS)


def login_success_bool(column: Column) -> Column:
    return F.when(column.isin("Yes", "yes"), F.lit(True)).when(column.isin("No", "no"), F.lit(False))


def coerce_timestamp(column: Column) -> Column:
    """Parse or null."""
    return column.try_cast("timestamp_ntz")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def month_name(ts: Column) -> Column:
    return F.date_format(ts, "MMMM")


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def is_business_hours(ts: Column) -> Column:
    """9 to 17, both included, any day."""
    return F.hour(ts).between(9, 17)


def is_business_hours_weekday(ts: Column) -> Column:
    """9 to 17, both included, Monday to Friday."""
    return is_business_hours(ts) & (F.weekday(ts) < 5)


def monday_week(ts: Column) -> Column:
    """``year-week`` with Monday-first weeks 00 to 53."""
    week = F.floor((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7).cast("int")
    return F.format_string("%04d-%02d", F.year(ts), week)


def time_features_etl(df: DataFrame, ts: str) -> DataFrame:
    """hour, day_of_week, month number, is_weekend."""
    t = F.col(ts)
    return df.withColumns({
        "hour": F.hour(t), "day_of_week": day_name(t), "month": F.month(t), "is_weekend": is_weekend(t),
    })


def time_features_eda(df: DataFrame, ts: str) -> DataFrame:
    """date, hour, day_of_week, month_name, year."""
    t = F.col(ts)
    return df.withColumns({
        "date": F.to_date(t), "hour": F.hour(t), "day_of_week": day_name(t), "month_name": month_name(t), "year": F.year(t),
    })


def clean_incidents(df: DataFrame) -> DataFrame:
    """Canonical severity, valid addresses, title-cased locations, time features and the score."""
    cleaned = df.withColumns({
        "severity": canon_severity(F.col("severity")),
        "source_ip": clean_ip(F.col("source_ip")),
        "location": clean_location(F.col("location")),
    })
    return time_features_etl(cleaned, "timestamp").withColumn("severity_score", severity_score(F.col("severity")))


def clean_logins(df: DataFrame) -> DataFrame:
    """Boolean outcome, valid addresses and time features."""
    cleaned = df.withColumns({
        "success": login_success_bool(F.col("success")),
        "ip_address": clean_ip(F.col("ip_address")),
    })
    return time_features_etl(cleaned, "login_time")


def dedupe(df: DataFrame) -> DataFrame:
    """Drop full-row duplicates."""
    return df.dropDuplicates()


def clean_incidents_eda(df: DataFrame) -> DataFrame:
    """Exploratory flavour: coerced time, titled severity, stripped location, no duplicates."""
    cleaned = df.withColumns({
        "timestamp": coerce_timestamp(F.col("timestamp")),
        "severity": title_severity(F.col("severity")),
        "location": strip_location(F.col("location")),
    })
    return prepare_incidents(dedupe(cleaned))


def clean_logins_eda(df: DataFrame) -> DataFrame:
    cleaned = df.withColumn("login_time", coerce_timestamp(F.col("login_time")))
    return time_features_eda(dedupe(cleaned), "login_time")


def clean_eda(incidents: DataFrame, logins: DataFrame) -> tuple[DataFrame, DataFrame]:
    return clean_incidents_eda(incidents), clean_logins_eda(logins)


def prepare_incidents(df: DataFrame) -> DataFrame:
    """Derived columns the exploratory operators read; narrow, no shuffle."""
    return time_features_eda(df, "timestamp").withColumn("severity_score", severity_score(F.col("severity")))


def band(column: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands ``(lo, hi]``; values outside the edges get null."""
    pairs = list(zip(edges[:-1], edges[1:], labels))

    def inside(lo: float, hi: float) -> Column:
        above = F.lit(True) if lo == float("-inf") else column > F.lit(float(lo))
        return above if hi == float("inf") else above & (column <= F.lit(float(hi)))

    chain = reduce(lambda chain, p: chain.when(inside(p[0], p[1]), F.lit(p[2])), pairs, F)
    return F.when(column.isNotNull(), chain)


def band_ge(column: Column, cuts: Sequence[float], labels: Sequence[str], default: str) -> Column:
    """Inclusive-lower bands, highest cut first."""
    return reduce(lambda chain, p: chain.when(column >= F.lit(p[0]), F.lit(p[1])), zip(cuts, labels), F).otherwise(default)
