"""Incident and login tables derived by Spark from the ``events`` stream table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from watchledger.functions import cleaning

# {k}: JSON field access, {str}: string type; the only differences between engines.
INCIDENTS_SQL = """
select event_id, ts as timestamp,
 case event_type
  when 'error' then case when event_id%2=0 then 'Malware' else 'Failed Login' end
  when 'view'  then case when event_id%2=0 then 'Phishing Attempt' else 'Port Scan' end
  else case when event_id%2=0 then 'Data Exfiltration' else 'Unauthorized Access' end end as event_type,
 case when value>=80 then 'Critical' when value>=40 then 'High' when value>=15 then 'Medium' else 'Low' end as severity,
 concat(case when user_id%10=0 then '10.1.' else '10.0.' end, cast(floor(user_id/256) as int), '.', user_id%256) as source_ip,
 concat('Device-', {k}) as destination_device,
 case cast(floor(event_id/2) as int)%4 when 0 then 'Successful' when 1 then 'Failed' when 2 then 'Blocked' else 'Allowed' end as status,
 case (user_id+event_id%3)%8 when 0 then 'China' when 1 then 'Russia' when 2 then 'Unknown'
  when 3 then cast(null as {str}) when 4 then 'United States' when 5 then 'Germany' when 6 then 'Brazil' else 'North Korea' end as location
from {events} where event_type in ('error','view','purchase')
"""

LOGINS_SQL = """
select event_id as login_id, concat('user',user_id) as user_id, ts as login_time,
 case when value<10 then 'No' else 'Yes' end as success,
 concat(case when user_id%10=1 then '10.2.' else '10.0.' end, cast(floor(user_id/256) as int), '.', user_id%256) as ip_address
from {events} where event_type in ('signup','click')
"""

RAW_SQL = """
select event_id, case when event_id%97=0 then 'not-a-date' else cast(timestamp as {str}) end as timestamp, event_type,
 case event_id%7 when 0 then lower(severity) when 1 then upper(severity) when 2 then severity||'?' else severity end as severity,
 case event_id%11 when 0 then ' '||source_ip||' ' when 1 then source_ip||'x' when 2 then 'fe80::1' when 3 then '999.1.1.1'
  when 4 then cast(null as {str}) else source_ip end as source_ip,
 destination_device, case when event_id%41=0 then 'Quarantined' else status end as status,
 case event_id%5 when 0 then '  '||lower(location)||' ' else location end as location
from {incidents}
"""

_SPARK = {"k": "get_json_object(props,'$.k')", "str": "string"}
_DUCK = {"k": "json_extract_string(props,'$.k')", "str": "varchar"}


class Tables:
    """The tables of one scale-factor folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The same file as an unbounded source."""
        reader = self.spark.readStream.schema(self.base(name).schema).option("pathGlobFilter", f"{name}.parquet")
        return reader.parquet(self.sf_dir)

    def _sql(self, text: str, **frames: DataFrame) -> DataFrame:
        for key in ("k", "str"):
            text = text.replace("{" + key + "}", _SPARK[key])
        return self.spark.sql(text, **frames)

    def incidents_from(self, events: DataFrame) -> DataFrame:
        return self._sql(INCIDENTS_SQL, events=events)

    def logins_from(self, events: DataFrame) -> DataFrame:
        return self._sql(LOGINS_SQL, events=events)

    @cached_property
    def incidents(self) -> DataFrame:
        return self.incidents_from(self.base("events"))

    @cached_property
    def logins(self) -> DataFrame:
        return self.logins_from(self.base("events"))

    @cached_property
    def raw_incidents(self) -> DataFrame:
        raw = self._sql(RAW_SQL, incidents=self.incidents)
        return raw.unionAll(raw.where("event_id % 50 = 0"))

    @cached_property
    def prepared(self) -> DataFrame:
        """Incidents with date, hour, day, month, year and severity_score."""
        return cleaning.prepare_incidents(self.incidents)

    @cached_property
    def prepared_logins(self) -> DataFrame:
        return cleaning.time_features_eda(self.logins, "login_time")


def oracle_views() -> str:
    """The same tables as DuckDB common table expressions."""
    fill = lambda text, **kw: text.format(**_DUCK, **kw).strip()
    raw = fill(RAW_SQL, incidents="incidents")
    return (
        f"incidents AS ({fill(INCIDENTS_SQL, events='events')}),\n"
        f"logins AS ({fill(LOGINS_SQL, events='events')}),\n"
        f"raw_once AS ({raw}),\n"
        "raw_incidents AS (SELECT * FROM raw_once UNION ALL SELECT * FROM raw_once WHERE event_id % 50 = 0),\n"
        "scored AS (SELECT *, CAST(timestamp AS DATE) AS date, hour(timestamp) AS hour, dayname(timestamp) AS day_of_week,"
        " monthname(timestamp) AS month_name, year(timestamp) AS year,"
        " CASE severity WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 WHEN 'Critical' THEN 4 END AS severity_score"
        " FROM incidents)"
    )
