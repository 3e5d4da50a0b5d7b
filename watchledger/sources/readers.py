"""CSV readers and writers of the base and published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from watchledger.functions.cleaning import clean_incidents, clean_logins
from watchledger.schemas import INCIDENTS, LOGINS

CORRUPT = "_corrupt_record"


def require_columns(df: DataFrame, columns: list[str], name: str = "table") -> DataFrame:
    """Raise when columns are missing; metadata only."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns in {name}: {missing}")
    return df


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: StructType, name: str) -> DataFrame:
    """Explicit schema, no inference; malformed lines are kept in ``_corrupt_record``."""
    header = _header(spark, path)
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise ValueError(f"missing columns in {name}: {missing}")
    # The file decides the order of its columns; extra ones stay text.
    types = {f.name: f for f in _nullable(schema).fields}
    layout = StructType([types.get(c, StructField(c, StringType())) for c in header] + [StructField(CORRUPT, StringType())])
    reader = spark.read.schema(layout).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("enforceSchema", False).csv(path)


def read_incidents(spark: SparkSession, path: str) -> DataFrame:
    df = read_table(spark, path, INCIDENTS, "incidents")
    return clean_incidents(df.select(*INCIDENTS.names))


def read_logins(spark: SparkSession, path: str) -> DataFrame:
    df = read_table(spark, path, LOGINS, "logins")
    return clean_logins(df.select(*LOGINS.names))


def malformed_lines(spark: SparkSession, path: str, schema: StructType, name: str) -> DataFrame:
    """Rows whose line does not fit the schema, with the whole line in ``_corrupt_record``."""
    return read_table(spark, path, schema, name).where(F.col(CORRUPT).isNotNull())


def read_raw_pair(spark: SparkSession, incidents_path: str, logins_path: str) -> tuple[DataFrame, DataFrame]:
    """Both files untyped."""
    raw = lambda p: spark.read.option("header", True).csv(p)
    return raw(incidents_path), raw(logins_path)


def shapes(incidents: DataFrame, logins: DataFrame) -> DataFrame:
    """Rows and columns per table and the total."""
    rows = lambda df, name: df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"))
    both = rows(incidents, "incidents").unionAll(rows(logins, "logins"))
    return both.unionAll(both.agg(F.lit("total").alias("table"), F.sum("rows").alias("rows"), F.max("columns").alias("columns")))
