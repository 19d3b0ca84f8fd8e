"""Registered queries: a name, the Spark query, and where SQL can say it, the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, TimestampType

from tidemark.sources.standins import Tables, sql_prefix

DIGITS = 4
# far above the noise of summing doubles in another order, far below the digits shown: values that end in exactly
# half a unit of the last digit round the same way in both engines
NUDGE = 1.0000000000001


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    floats: tuple[str, ...]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return presentable(self.build(Tables(spark, sf_dir)))

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        rounded = ", ".join(f"round(CAST({c} AS DOUBLE) * {NUDGE}, {DIGITS}) + 0.0 AS {c}" for c in self.floats)
        replace = f" REPLACE ({rounded})" if rounded else ""
        return f"{sql_prefix()}\nSELECT *{replace} FROM ({self.sql})"


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None, floats: str = ""):
    """Register a query; ``floats`` names the fractional columns, rounded on the SQL side as ``presentable`` does."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Query(name, ids, build, sql, tuple(floats.split()))
        return build

    return register


def presentable(df: DataFrame) -> DataFrame:
    """Fractional columns as DOUBLE rounded to 4 digits; instants as plain UTC timestamps."""

    def show(field):
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (DoubleType, FloatType)) or (isinstance(kind, DecimalType) and kind.scale > 0):
            # + 0.0 turns a negative zero into zero
            return (F.round(column.cast("double") * F.lit(NUDGE), DIGITS) + F.lit(0.0)).alias(field.name)
        if isinstance(kind, DecimalType):
            return column.cast("bigint").alias(field.name)
        if isinstance(kind, TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select(*[show(f) for f in df.schema.fields])
