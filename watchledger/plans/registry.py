"""How a query and its reference SQL are registered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, ShortType

from watchledger.sources.fixtures import Tables, oracle_views


@dataclass(frozen=True)
class Query:
    """``sql`` is the body of the equivalent statement, ``views`` further table expressions it needs."""

    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None = None
    views: str = ""

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        extra = f",\n{self.views.strip()}" if self.views else ""
        return f"WITH {oracle_views()}{extra}\n{self.sql.strip()}"


def r6(expression: str) -> str:
    """SQL rounding to six places without negative zero."""
    return f"(round(CAST({expression} AS DOUBLE), 6) + 0e0)"


def comparable(df: DataFrame) -> DataFrame:
    """Integers as bigint, doubles to six places: the form in which results are compared."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (FloatType, DoubleType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("bigint") if f.dataType.scale == 0 else F.round(c.cast("double"), 6)
        columns.append(c.alias(f.name))
    return df.select(*columns)
