"""Orphans, duplicates, counts over time and outlier tests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.json_fields import variant_field
from tidemark.functions.timegrid import time_bucket
from tidemark.operators.latest import last_by

# fixed values: networks that no longer run and are left out of alerts
DEAD_CHAINS = ("aurora", "emerald", "celo", "harmony", "heco")


def investment_key(product_id: Column) -> Column:
    return F.concat(F.lit("product:investment:"), product_id.cast("string"))


def feed_key(price_feed_id: Column) -> Column:
    return F.concat(F.lit("price:feed:"), price_feed_id.cast("string"))


def statistics_key(product_id: Column) -> Column:
    return F.concat(F.lit("product:statistics:"), product_id.cast("string"))


def products_without_state(products: DataFrame, states: DataFrame) -> DataFrame:
    """Live products per chain that have no import state; ``eol`` is read where it is, under the variant."""
    live = products.filter(variant_field(F.col("product_data"), "eol") != "true")
    return (
        live.withColumn("import_key", investment_key(F.col("product_id")))
        .join(states.select("import_key"), "import_key", "left_anti")
        .groupBy("chain")
        .agg(F.count("*").alias("products"))
    )


def unreferenced_feeds(feeds: DataFrame, products: DataFrame, null_safe: bool = False) -> DataFrame:
    """Feeds no product refers to.

    As SQL's NOT IN, one product without a feed makes the answer empty; ``null_safe`` disregards such products.
    """
    used = products.select(F.col("price_feed_1_id").alias("_used")).unionByName(
        products.select(F.col("price_feed_2_id").alias("_used"))
    )
    kept = feeds.join(used.filter(F.col("_used").isNotNull()).distinct(), F.col("price_feed_id") == F.col("_used"), "left_anti")
    if null_safe:
        return kept
    any_null = used.agg(F.coalesce(F.bool_or(F.col("_used").isNull()), F.lit(False)))
    return kept.filter(~any_null.scalar())


def duplicates(df: DataFrame, keys: Sequence[str], alternatives: Sequence[str], ts: str = "datetime") -> DataFrame:
    """Keys stored under more than one datetime, with how many alternatives of each column they have.

    The alternatives themselves come from ``duplicate_rows``: a key may have very many.
    """
    return (
        df.groupBy(*keys)
        .agg(F.countDistinct(ts).alias("datetimes"), *[F.countDistinct(c).alias(f"{c}s") for c in alternatives])
        .filter(F.col("datetimes") > 1)
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str], alternatives: Sequence[str], ts: str = "datetime") -> DataFrame:
    """One row per key and alternative for keys stored under more than one datetime."""
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi")).filter(F.col("_lo") != F.col("_hi"))
    return df.join(bounds.select(*keys), list(keys), "left_semi").select(*keys, ts, *alternatives).distinct()


def not_in_rows(rows: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Row-value NOT IN on several columns."""
    return rows.join(listed.select(*on).distinct(), list(on), "left_anti")


def counts_per_bucket(rows: DataFrame, period: str, keys: Sequence[str], ts: str = "datetime", out: str = "count") -> DataFrame:
    return rows.groupBy(time_bucket(period, F.col(ts)).alias("time"), *keys).agg(F.count("*").alias(out))


def transfer_counts(ledger: DataFrame, products: DataFrame, period: str, by: str = "chain") -> DataFrame:
    """Balance movements per bucket and product or chain; reward snapshots (no movement) are left out.

    Counted per product before the join, so only (bucket, product) counts are joined.
    """
    moved = ledger.filter(F.col("balance_diff") != 0)
    counts = counts_per_bucket(moved, period, ["product_id"], out="transfers")
    named = counts.join(products.select("product_id", "chain", "product_key"), "product_id")
    return named.groupBy("time", by).agg(F.sum("transfers").alias("transfers"))


def error_counts(errors: DataFrame, period: str, by: Sequence[str] = ("chain",)) -> DataFrame:
    return counts_per_bucket(errors, period, by, out="errors")


def missing_prices(timeline: DataFrame, products: DataFrame) -> DataFrame:
    """Timeline rows without a USD price, per chain."""
    open_rows = timeline.filter(F.col("underlying_to_usd_price").isNull()).groupBy("product_id").agg(F.count("*").alias("n"))
    return (
        open_rows.join(products.select("product_id", "chain"), "product_id", "left")
        .groupBy("chain")
        .agg(F.sum("n").alias("rows_without_price"))
    )


def rising(series: DataFrame, key: str, value: str, sigmas: float = 2.5, ts: str = "datetime") -> DataFrame:
    """1 where the last hour exceeds mean + 2.5 sample deviations of the key's hours, else 0, NULL when undefined."""
    stats = series.groupBy(key).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_dev"), last_by(value, ts).alias("last_value")
    )
    return stats.select(
        key, "last_value", (F.col("last_value") > F.col("_mean") + F.lit(sigmas) * F.col("_dev")).cast("int").alias("is_rising")
    )


def rising_errors(errors: DataFrame, as_of: datetime) -> DataFrame:
    """Outlier test on hourly error counts; the unfinished hour and dead networks are left out."""
    done = errors.filter(F.col("datetime") < time_bucket("1hour", F.lit(as_of))).filter(~F.col("chain").isin(*DEAD_CHAINS))
    hourly = done.groupBy("chain", time_bucket("1hour", F.col("datetime")).alias("datetime")).agg(F.count("*").alias("errors"))
    return rising(hourly, "chain", "errors")


def rising_work(metrics: DataFrame, as_of: datetime, import_types: Sequence[str] = ("product:investment", "product:share-rate")) -> DataFrame:
    """Outlier test on the hourly amount of work left (failed plus not covered)."""
    done = metrics.filter(
        (F.col("datetime") < time_bucket("1hour", F.lit(as_of))) & F.col("import_type").isin(*import_types)
    ).filter(~F.col("chain").isin(*DEAD_CHAINS))
    hourly = done.groupBy("chain", time_bucket("1hour", F.col("datetime")).alias("datetime")).agg(
        (F.sum("errors_count") + F.sum("not_covered_yet")).alias("work")
    )
    return rising(hourly, "chain", "work")


def ms_per_block(blocks: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Mean milliseconds per block between the lowest and highest block (of a height range), per chain."""
    if lo is not None:
        blocks = blocks.filter(F.col("block_number") >= lo)
    if hi is not None:
        blocks = blocks.filter(F.col("block_number") <= hi)
    ends = blocks.groupBy("chain").agg(
        F.min(F.struct("block_number", "datetime")).alias("_lo"), F.max(F.struct("block_number", "datetime")).alias("_hi")
    )
    span = F.unix_micros("_hi.datetime") - F.unix_micros("_lo.datetime")
    return ends.select(
        "chain", F.try_divide(span / F.lit(1000.0), F.col("_hi.block_number") - F.col("_lo.block_number")).alias("ms_per_block")
    )


def expired(rows: DataFrame, as_of: datetime, keep: str, ts: str = "datetime") -> DataFrame:
    """What retention keeps: rows younger than a period (``6 MONTH``, ``1 MONTH``)."""
    return rows.filter(F.col(ts) >= F.lit(as_of) - F.expr(f"INTERVAL {keep}"))
