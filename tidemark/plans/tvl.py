"""Value locked per day, its growth, and the share of the underlying captured."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.json_fields import display_id, is_eol
from tidemark.functions.timegrid import time_bucket
from tidemark.operators.latest import last_by

MAX_TVL_RANGE = timedelta(days=7)


def described(products: DataFrame, *columns: str) -> DataFrame:
    """Products with ``columns`` and their display id, for a join by product. The JSON is read once per product and stays
    behind; the hint keeps the side from being broadcast, as its rows are many times larger than the files they come from."""
    return products.select(*columns, display_id(F.col("product_data")).alias("vault_id")).hint("merge")


def daily_tvl(
    stats: DataFrame, products: DataFrame, daily_prices: DataFrame, lo: Column | None = None, hi: Column | None = None
) -> DataFrame:
    """Most staked per (day, product) times the day's average price of the underlying."""
    if lo is not None:
        # the same bounds on both sides, so that both scans prune
        stats = stats.filter(F.col("datetime").between(lo, hi))
        daily_prices = daily_prices.filter(F.col("datetime").between(lo, hi))
    staked = (
        stats.groupBy("product_id", time_bucket("1day", F.col("datetime")).alias("day"))
        .agg(F.max("staked_underlying").alias("max_staked"))
        .withColumnRenamed("day", "datetime")
    )
    prices = daily_prices.select(F.col("price_feed_id").alias("price_feed_2_id"), "datetime", "price_avg")
    return (
        staked.join(described(products, "product_id", "price_feed_2_id", "chain", "product_key"), "product_id")
        .join(prices, ["price_feed_2_id", "datetime"])
        .select(
            "datetime",
            "product_id",
            "chain",
            "product_key",
            "vault_id",
            (F.col("max_staked").cast("double") * F.col("price_avg")).alias("tvl"),
        )
    )


def chain_tvl(tvl: DataFrame) -> DataFrame:
    return tvl.groupBy("datetime", "chain").agg(F.sum("tvl").alias("tvl"))


def growth(tvl: DataFrame) -> DataFrame:
    """First against last value of each product in the period."""
    return tvl.groupBy("product_id", "product_key", "chain", "vault_id").agg(
        F.min("datetime").alias("compare_to_datetime"),
        F.max("datetime").alias("recent_datetime"),
        F.min_by("tvl", "datetime").alias("compare_to_tvl"),
        F.max_by("tvl", "datetime").alias("recent_tvl"),
    ).withColumn("diff_tvl", F.coalesce("recent_tvl", F.lit(0.0)) - F.coalesce("compare_to_tvl", F.lit(0.0)))


def growth_by_chain(grown: DataFrame) -> DataFrame:
    """Growth per chain with the grand totals beside it (one row per chain reaches the unpartitioned window)."""
    everything = Window.partitionBy()
    columns = {"compare_to_tvl": "compare_to_tvl", "recent_tvl": "recent_tvl", "diff_tvl": "chain_diff_tvl"}
    per_chain = grown.groupBy("chain").agg(*[F.sum(c).alias(n) for c, n in columns.items()])
    totals = {"total_compare_to_tvl": "compare_to_tvl", "total_recent_tvl": "recent_tvl", "total_diff_tvl": "chain_diff_tvl"}
    return per_chain.withColumns({n: F.sum(c).over(everything) for n, c in totals.items()})


def tvl_of_product(
    stats: DataFrame, products: DataFrame, daily_prices: DataFrame, product_id: int, start: datetime, end: datetime
) -> DataFrame:
    """Daily value of one vault over at most a week; retired products and boosts are refused."""
    if start > end:
        raise ValueError("start must be before end")
    if end - start > MAX_TVL_RANGE:
        raise ValueError("the range must not exceed a week")
    product = products.filter(F.col("product_id") == product_id)
    facts = product.select(
        F.get_json_object("product_data", "$.boost").isNotNull().alias("boost"),
        F.coalesce(is_eol(F.col("product_data")), F.lit(False)).alias("eol"),
    ).first()
    if facts is None:
        raise ValueError("product not found")
    if facts["boost"] or facts["eol"]:
        raise ValueError("boosts and retired products are not supported")
    own = stats.filter(F.col("product_id") == product_id)
    return daily_tvl(own, product, daily_prices, F.lit(start), F.lit(end)).select("datetime", "tvl")


def daily_capture(stats: DataFrame, products: DataFrame) -> DataFrame:
    return (
        stats.groupBy("product_id", time_bucket("1day", F.col("datetime")).alias("time"))
        .agg(F.max("underlying_capture_percentage").alias("capture"))
        .join(described(products, "product_id"), "product_id")
    )


def capture_change(stats: DataFrame, products: DataFrame, start: Column, end: Column) -> DataFrame:
    """Last capture before ``end`` against the last before ``start``, per product, in one pass."""
    at = F.struct("datetime", "block_number", "underlying_capture_percentage")
    early = F.when(F.col("datetime") < start, at)
    compared = (
        stats.filter(F.col("datetime") < end)
        .groupBy("product_id")
        .agg(F.max(early).alias("_early"), F.max(at).alias("_late"))
        .select(
            "product_id",
            F.col("_early.datetime").alias("compare_to_datetime"),
            F.col("_late.datetime").alias("recent_datetime"),
            F.col("_early.underlying_capture_percentage").alias("compare_to_capture"),
            F.col("_late.underlying_capture_percentage").alias("recent_capture"),
        )
    )
    diff = F.coalesce("recent_capture", F.lit(0.0)) - F.coalesce("compare_to_capture", F.lit(0.0))
    return compared.withColumn("diff_capture", diff).join(described(products, "product_id", "product_key"), "product_id")


def midnight_staked_value(stats: DataFrame, products: DataFrame, ticks: DataFrame) -> DataFrame:
    """Per (day, product): the most any staked amount of the day was worth at a tick stamped exactly midnight.

    The maximum of a product over two sets lies at one of their ends, so both sides shrink to their minimum and
    maximum before the join.
    """
    staked = stats.groupBy("product_id", time_bucket("1day", F.col("datetime")).alias("datetime")).agg(
        F.min(F.col("staked_underlying").cast("double")).alias("s_lo"), F.max(F.col("staked_underlying").cast("double")).alias("s_hi")
    )
    price = (
        ticks.filter(F.date_trunc("day", "datetime") == F.col("datetime"))
        .groupBy(F.col("price_feed_id").alias("price_feed_2_id"), "datetime")
        .agg(F.min(F.col("price").cast("double")).alias("p_lo"), F.max(F.col("price").cast("double")).alias("p_hi"))
    )
    ends = [F.col(s) * F.col(p) for s in ("s_lo", "s_hi") for p in ("p_lo", "p_hi")]
    return (
        staked.join(described(products, "product_id", "price_feed_2_id", "chain"), "product_id")
        .join(price, ["price_feed_2_id", "datetime"])
        .select("datetime", "product_id", "chain", "vault_id", F.greatest(*ends).alias("staked_value_usd"))
    )


def stats_listing(stats: DataFrame, products: DataFrame) -> DataFrame:
    """Raw statistics with display ids; amounts as text."""
    amounts = ("vault_total_supply", "share_to_underlying_price", "staked_underlying", "underlying_total_supply")
    return stats.join(described(products, "product_id"), "product_id").select(
        "product_id", "vault_id", "datetime", "block_number",
        *[F.col(c).cast("string").alias(c) for c in amounts],
        "underlying_capture_percentage",
    )
