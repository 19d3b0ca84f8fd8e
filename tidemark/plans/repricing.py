"""Prices of a stored timeline worked out again after a refresh, in the partitions that depend on it.

The timeline is stored by day, and beside it an index: which price feeds the rows of a day are valued by, and between
which instants. A refresh of some feeds over some time is joined with the index; only the days that it names are read
and rewritten, each as one partition, and a refresh that dies is repeated from its written copy.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import finish_merge, overwrite_partitions, rewrite_partitions
from tidemark.plans import valuation

SLOT = "day"
ROWS, FEEDS = "rows", "feeds"


def dependencies(rows: DataFrame, products: DataFrame) -> DataFrame:
    """``price_feed_id``, the day, and the first and last instant of its rows that the feed values."""
    feeds = F.array_compact(F.array_distinct(F.array("price_feed_1_id", "price_feed_2_id")))
    of_product = products.select("product_id", F.explode(feeds).alias("price_feed_id"))
    used = rows.groupBy("product_id", SLOT).agg(F.min("datetime").alias("first"), F.max("datetime").alias("last"))
    return used.join(of_product, "product_id").groupBy("price_feed_id", SLOT).agg(F.min("first").alias("first"), F.max("last").alias("last"))


def store(timeline: DataFrame, products: DataFrame, path: str) -> None:
    """Write the timeline by day, and the index of its feeds."""
    dated = timeline.withColumn(SLOT, F.to_date("datetime"))
    overwrite_partitions(dated, f"{path}/{ROWS}", SLOT)
    stored = timeline.sparkSession.read.parquet(f"{path}/{ROWS}")
    overwrite_partitions(dependencies(stored, products), f"{path}/{FEEDS}", SLOT)


def touched_days(spark: SparkSession, path: str, refreshed: DataFrame) -> DataFrame:
    """The days with rows that a refreshed feed values, within the refreshed time (from its earliest to its latest end)."""
    span = refreshed.agg(F.min("from").alias("lo"), F.max("to").alias("hi")).first()
    if span["lo"] is None:
        return spark.createDataFrame([], f"{SLOT} date")
    index = spark.read.parquet(f"{path}/{FEEDS}").filter((F.col("first") <= F.lit(span["hi"])) & (F.col("last") >= F.lit(span["lo"])))
    return index.join(refreshed.select("price_feed_id").distinct(), "price_feed_id", "left_semi").select(SLOT).distinct()


def reprice(
    spark: SparkSession,
    path: str,
    products: DataFrame,
    refreshed: DataFrame,
    prices: DataFrame,
    coverage: DataFrame,
    retries: DataFrame,
    feeds: DataFrame,
    as_of: datetime,
    resolved_path: str,
) -> DataFrame:
    """Clear what the refreshed feeds (price_feed_id, from, to) have valued, price it again by the tiers of
    ``valuation.resolve_missing`` and write it back. Returns the rows that were priced, with their tier and price, kept
    at ``resolved_path``."""
    of_product = products.select("product_id", F.col("price_feed_2_id").alias("price_feed_id"))
    keys = ["investor_id", "product_id", "datetime", "block_number"]

    def change(stored: DataFrame) -> DataFrame:
        cleared = valuation.invalidate(stored, products, refreshed)
        missing = stored.filter(valuation.in_refreshed_window(refreshed)).select(*keys).join(of_product, "product_id")
        missing = missing.join(valuation.affected_products(products, refreshed), "product_id", "left_semi")
        resolved = valuation.resolve_missing(missing, prices, coverage, retries, feeds, as_of)
        resolved.select(*keys, "price_feed_id", "tier", "price").write.mode("overwrite").parquet(resolved_path)
        return valuation.apply_prices(cleared, spark.read.parquet(resolved_path))

    rewrite_partitions(spark, f"{path}/{ROWS}", touched_days(spark, path, refreshed), SLOT, change)
    return spark.read.parquet(resolved_path)


def read(spark: SparkSession, path: str) -> DataFrame:
    finish_merge(spark, f"{path}/{ROWS}", SLOT)
    return spark.read.parquet(f"{path}/{ROWS}")
