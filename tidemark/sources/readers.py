"""Landed inputs: event logs, price ticks, versioned configuration, and bounded table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.schema import AMOUNT


def event_log(spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False) -> DataFrame:
    """Event-log rows with a fixed schema, as a batch or as a stream of landed files."""
    reader = spark.readStream if streaming else spark.read
    return reader.format(fmt).schema(schema.EVENT_LOG).load(path)


def price_ticks(spark: SparkSession, path: str, price_feed_id: Column, lo: Column, hi: Column) -> DataFrame:
    """``{"t": epoch seconds, "v": price}`` lines inside [lo, hi] as price rows.

    These prices belong to no block, so the second they were taken at stands in for the block number.
    """
    raw = spark.read.schema(f"t DOUBLE, v {AMOUNT}, feed STRING").json(path)
    return ticks_to_prices(raw, price_feed_id, lo, hi)


def ticks_to_prices(raw: DataFrame, price_feed_id: Column, lo: Column, hi: Column) -> DataFrame:
    at = F.timestamp_micros(F.round(F.col("t") * F.lit(1e6)).cast("bigint"))
    return (
        raw.filter(F.col("v").isNotNull())
        .withColumn("datetime", at)
        .filter(F.col("datetime").between(lo, hi))
        .select(
            "datetime",
            price_feed_id.cast("int").alias("price_feed_id"),
            F.floor(F.unix_micros("datetime") / F.lit(1_000_000)).cast("bigint").alias("block_number"),
            F.col("v").cast(AMOUNT).alias("price"),
        )
    )


def config_versions(spark: SparkSession, path: str, definition: str) -> DataFrame:
    """Versioned configuration files: lines of (source, version_date, content), ``content`` a JSON array."""
    raw = spark.read.schema("source STRING, version_date TIMESTAMP, content STRING").json(path)
    return parse_versions(raw, definition)


def parse_versions(raw: DataFrame, definition: str) -> DataFrame:
    """One row per definition of each readable version; versions that do not parse are dropped whole.

    ``definition`` is the DDL of one array element.
    """
    parsed = F.from_json(
        F.concat(F.lit('{"items":'), F.col("content"), F.lit("}")),
        f"items ARRAY<STRUCT<{definition}>>, _corrupt_record STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    return (
        raw.withColumn("_parsed", parsed)
        .filter(F.col("_parsed._corrupt_record").isNull() & F.col("_parsed.items").isNotNull())
        .select(*[c for c in raw.columns if c != "content"], F.explode("_parsed.items").alias("definition"))
    )


def between_times(df: DataFrame, lo: Column, hi: Column, column: str = "datetime") -> DataFrame:
    """Time-bounded scan; reaches the parquet reader as a pushed filter."""
    return df.filter(F.col(column).between(lo, hi))


def with_ids(df: DataFrame, column: str, ids: Sequence[int] | DataFrame) -> DataFrame:
    """Scan by id list: a pushed ``IN`` for a literal list, a semi join for a list held in a frame."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(ids.columns[0]).withColumnRenamed(ids.columns[0], column).distinct(), column, "left_semi")
    return df.filter(F.col(column).isin(list(ids)))
