"""Valued timelines, missing-price resolution, and snapshot series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import evm
from tidemark.functions.range_columns import midpoint
from tidemark.functions.timegrid import SAMPLING_MS, interval, time_bucket
from tidemark.operators import asof, intervals
from tidemark.operators.gapfill import gapfill, interpolate
from tidemark.operators.latest import last_by
from tidemark.operators.scan import Run, running
from tidemark.operators.transfers import TOO_LARGE
from tidemark.operators.upsert import nullify, update_from
from tidemark.session import cut_lineage, tasks_for

PRICED = ("underlying_to_usd_price", "usd_balance", "usd_diff")
REWARD_PRICED = (
    "pending_rewards", "pending_rewards_diff", "pending_rewards_to_usd_price",
    "pending_rewards_usd_balance", "pending_rewards_usd_diff",
)


def value(balance: Column, share_price: Column, usd_price: Column | None = None) -> Column:
    """Two price hops, multiplied in DOUBLE."""
    underlying = balance.cast("double") * share_price.cast("double")
    return underlying if usd_price is None else underlying * usd_price.cast("double")


def build_timeline(ledger: DataFrame, products: DataFrame, share_rates: DataFrame, prices: DataFrame) -> DataFrame:
    """Ledger rows valued with the share rate of their own block and the USD price of their 15-minute bucket.

    A ledger row without a share rate keeps NULL underlying amounts and, as it has nothing to value, no USD price.
    """
    feeds = products.select("product_id", "price_feed_1_id", "price_feed_2_id")
    rates = share_rates.select(
        F.col("price_feed_id").alias("price_feed_1_id"), "block_number", "datetime",
        F.col("price").cast("double").alias("share_to_underlying_price"),
    )
    rated = ledger.join(feeds, "product_id").join(rates, ["price_feed_1_id", "block_number", "datetime"], "left")
    return with_usd(_underlying(rated), prices)


def _underlying(rated: DataFrame) -> DataFrame:
    rate = F.col("share_to_underlying_price")
    return rated.withColumns(
        {
            "balance": F.col("balance").cast("double"),
            "balance_diff": F.col("balance_diff").cast("double"),
            "underlying_balance": value(F.col("balance"), rate),
            "underlying_diff": value(F.col("balance_diff"), rate),
        }
    )


def with_usd(timeline: DataFrame, prices: DataFrame, bucket: str = "15min") -> DataFrame:
    """Add the USD columns from the price of the row's bucket (feed ``price_feed_2_id``)."""
    matched = asof.same_bucket(timeline, prices.withColumnRenamed("price_feed_id", "price_feed_2_id"), bucket, key="price_feed_2_id")
    known = F.col("underlying_balance").isNotNull() & F.col("underlying_diff").isNotNull()
    price = F.when(known, F.col("match_price").cast("double"))
    return (
        matched.withColumn("underlying_to_usd_price", price)
        .withColumns(
            {
                "usd_balance": F.col("underlying_balance") * F.col("underlying_to_usd_price"),
                "usd_diff": F.col("underlying_diff") * F.col("underlying_to_usd_price"),
            }
        )
        .drop("match_price", "match_block_number", "match_datetime")
    )


def first_prices(prices: DataFrame) -> DataFrame:
    """First tick of each feed."""
    return (
        prices.groupBy("price_feed_id")
        .agg(F.min(F.struct("datetime", "block_number", "price")).alias("_first"))
        .select(
            "price_feed_id",
            F.col("_first.datetime").alias("first_datetime"),
            F.col("_first.block_number").alias("first_block_number"),
            F.col("_first.price").alias("first_price"),
        )
    )


def required_spans(as_of: Column, margin: str = "1day", late_margin: str = "1month") -> dict[str, tuple[Column, Column]]:
    """Spans that must have been imported before a missing price may be filled, by tier.

    Uses columns datetime, first_date (start of the feed's coverage) and first_datetime (its first tick).
    """
    at, created, first = F.col("datetime"), F.col("first_date"), F.col("first_datetime")
    return {
        "no_prices": (created, F.least(at + interval(late_margin), as_of)),
        "before_first": (created, first),
        "interpolated": (F.greatest(at - interval(margin), first), F.least(at + interval(margin), as_of)),
    }


def resolve_missing(
    unpriced: DataFrame, prices: DataFrame, coverage: DataFrame, retries: DataFrame, feeds: DataFrame, as_of: datetime
) -> DataFrame:
    """Prices for rows without one, in four tiers; rows no tier may fill get none.

    1. a tick in the same 15-minute bucket; 2. the feed has no tick at all: 0; 3. the row precedes the first tick:
    the first price; 4. interpolation. Tiers 2-4 apply only where the feed was successfully imported (covered and
    not queued for retry) over one unbroken stretch that contains the tier's required span.
    ``unpriced`` has price_feed_id and datetime; ``feeds`` has price_feed_id and first_date; ``coverage`` and
    ``retries`` hold (price_feed_id, from, to) in epoch milliseconds.
    """
    matched = asof.same_bucket(unpriced, prices)
    columns = unpriced.columns
    in_bucket = matched.filter(F.col("match_price").isNotNull()).select(
        *columns, F.lit(1).alias("tier"), F.col("match_price").cast("double").alias("price")
    )
    # what is left is looked at several times below, so it is written down once
    left_over = cut_lineage(
        matched.filter(F.col("match_price").isNull())
        .select(*columns)
        .join(feeds.select("price_feed_id", "first_date"), "price_feed_id", "left")
        .join(first_prices(prices).drop("first_block_number"), "price_feed_id", "left")
    )
    tier = (
        F.when(F.col("first_price").isNull(), 2).when(F.col("datetime") < F.col("first_datetime"), 3).otherwise(4)
    )
    spans = required_spans(F.lit(as_of))
    need = [
        F.when(tier == 2, spans["no_prices"][end]).when(tier == 3, spans["before_first"][end]).otherwise(spans["interpolated"][end])
        for end in (0, 1)
    ]
    asked = left_over.withColumns({"tier": tier, "_need_from": F.unix_millis(need[0]), "_need_to": F.unix_millis(need[1])})
    green = intervals.exclude(coverage, retries, ["price_feed_id"], cell_width=SAMPLING_MS["1day"])
    fillable = cut_lineage(_inside_one_range(asked, green).filter("_is_green"))
    at_edge = fillable.filter(F.col("tier") < 4).select(
        *columns, "tier", F.when(F.col("tier") == 2, F.lit(0.0)).otherwise(F.col("first_price").cast("double")).alias("price")
    )
    between = asof.interpolated_price(fillable.filter(F.col("tier") == 4).select(*columns, "tier"), prices)
    interpolated = between.filter(F.col("interpolated_price").isNotNull()).select(
        *columns, "tier", F.col("interpolated_price").alias("price")
    )
    return in_bucket.unionByName(at_edge).unionByName(interpolated)


def _inside_one_range(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """``_is_green``: one of the feed's (disjoint) ranges contains [_need_from, _need_to].

    The only candidate is the last range starting at or before ``_need_from``: an as-of lookup, not a range join.
    """
    starts = ranges.select(
        "price_feed_id", F.col("from").alias("_need_from"), F.col("to").alias("_range_to"), F.lit(0).alias("_is_row")
    )
    # a place is looked up once, however many rows ask for it (all rows before a feed's first tick ask for the same)
    places = rows.select("price_feed_id", "_need_from").distinct()
    stream = places.withColumn("_is_row", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    day = F.floor(F.col("_need_from") / F.lit(SAMPLING_MS["1day"])).cast("long")
    reached = running(
        stream, ["price_feed_id"], ["_need_from", "_is_row"], day, {"_reach": Run("last", F.col("_range_to"))}
    )
    reach = reached.filter(F.col("_is_row") == 1).select("price_feed_id", "_need_from", "_reach")
    return (
        rows.join(reach, ["price_feed_id", "_need_from"], "left")
        .withColumn("_is_green", F.coalesce(F.col("_reach") >= F.col("_need_to"), F.lit(False)))
        .drop("_reach", "_need_from", "_need_to")
    )


def apply_prices(timeline: DataFrame, resolved: DataFrame) -> DataFrame:
    """Write resolved prices into the timeline rows they belong to."""
    keys = ["investor_id", "product_id", "datetime", "block_number"]
    return update_from(
        timeline,
        resolved.select(*keys, F.col("price").alias("_price")),
        keys,
        {
            "underlying_to_usd_price": F.col("_price"),
            "usd_balance": F.col("underlying_balance") * F.col("_price"),
            "usd_diff": F.col("underlying_diff") * F.col("_price"),
        },
    )


def affected_products(products: DataFrame, refreshed: DataFrame) -> DataFrame:
    """Products that use a refreshed feed as either of their two."""
    feeds = refreshed.select("price_feed_id").distinct()
    return (
        products.join(feeds, F.col("price_feed_1_id") == F.col("price_feed_id"), "left_semi").select("product_id")
        .unionByName(products.join(feeds, F.col("price_feed_2_id") == F.col("price_feed_id"), "left_semi").select("product_id"))
        .distinct()
    )


def in_refreshed_window(refreshed: DataFrame) -> Column:
    """Whether ``datetime`` lies between the earliest ``from`` and the latest ``to``."""
    return F.col("datetime").between(refreshed.agg(F.min("from")).scalar(), refreshed.agg(F.max("to")).scalar())


def invalidate(timeline: DataFrame, products: DataFrame, refreshed: DataFrame) -> DataFrame:
    """Null the USD columns of rows whose product uses a refreshed feed, inside the refreshed window.

    ``refreshed`` has price_feed_id, from and to (timestamps); the window spans from the earliest ``from`` to the
    latest ``to``.
    """
    marked = timeline.join(affected_products(products, refreshed).withColumn("_touched", F.lit(True)), "product_id", "left")
    hit = F.col("_touched") & in_refreshed_window(refreshed)
    columns = [c for c in (*PRICED, *REWARD_PRICED) if c in timeline.columns]
    return nullify(marked, hit, columns).select(*timeline.columns)


def bridged_share_rates(
    transfers: DataFrame, prices: DataFrame, origin_blocks: DataFrame, readings: DataFrame, tolerance: str = "10min"
) -> DataFrame:
    """Share rate for products living on another network than their vault.

    First the nearest rate of the feed within the tolerance; else the origin network's block nearest in time
    (within an hour) and the reading taken at that block.
    ``transfers``: price_feed_id, datetime, origin_chain, ...; ``origin_blocks``: chain, datetime, block_number;
    ``readings``: price_feed_id, block_number, datetime, price.
    """
    minutes = F.expr(f"INTERVAL '{int(tolerance.removesuffix('min'))}' MINUTE")
    near = asof.nearest(transfers, prices, "price_feed_id", minutes, ["price", "block_number"], prefix="rate_")
    blocks = origin_blocks.withColumnRenamed("chain", "origin_chain")
    placed = asof.nearest(near, blocks, "origin_chain", F.expr("INTERVAL 1 HOUR"), ["block_number"], prefix="origin_")
    at_block = readings.select(
        "price_feed_id",
        F.col("block_number").alias("origin_block_number"),
        F.col("datetime").alias("_read_datetime"),
        F.col("price").alias("_read_price"),
    )
    found = F.col("rate_price").isNotNull()
    return (
        placed.join(at_block, ["price_feed_id", "origin_block_number"], "left")
        .withColumns(
            {
                "share_rate": F.coalesce("rate_price", "_read_price"),
                "share_rate_datetime": F.coalesce("rate_datetime", "_read_datetime"),
                "share_rate_block_number": F.when(found, F.col("rate_block_number")).otherwise(F.col("origin_block_number")),
                "share_rate_source": F.when(found, "feed").when(F.col("_read_price").isNotNull(), "origin"),
            }
        )
        .drop("rate_price", "rate_datetime", "rate_block_number", "origin_block_number", "origin_datetime", "_read_price", "_read_datetime")
    )


def preferred_block_time(rows: DataFrame, stored_blocks: DataFrame, fetched: str = "fetched_datetime") -> DataFrame:
    """Block time: the stored one where there is one, else the one that came with the row."""
    stored = stored_blocks.groupBy("chain", "block_number").agg(F.min("datetime").alias("_stored"))
    return (
        rows.join(stored, ["chain", "block_number"], "left")
        .withColumn("datetime", F.coalesce("_stored", fetched))
        .drop("_stored")
    )


def block_list(
    blocks: DataFrame,
    step: str,
    as_of: datetime,
    latest: DataFrame | None = None,
    first_date: Column | None = None,
    first_block: Column | None = None,
) -> DataFrame:
    """Blocks sampled at a time step per chain, with block numbers interpolated where a bucket is empty.

    ``latest`` (chain, latest_datetime, latest_block_number) gives the interpolation a right edge. ``first_date``
    or ``first_block`` (which wins) cut the list afterwards.
    """
    earliest = blocks.agg(F.min("datetime")).scalar()
    end = F.lit(as_of) - interval(step)
    sampled = gapfill(
        blocks, ["chain"], step, earliest - interval(step), end,
        {"block_number": last_by("block_number", "datetime", "block_number")},
    )
    if latest is None:
        filled = interpolate(sampled, ["chain"], "block_number", "interpolated_block_number")
    else:
        filled = interpolate(
            sampled.join(latest, "chain", "left"), ["chain"], "block_number", "interpolated_block_number",
            next_at=F.col("latest_datetime"), next_value=F.col("latest_block_number"),
        ).drop("latest_datetime", "latest_block_number")
    listed = filled.filter(F.col("interpolated_block_number").isNotNull())
    if first_block is not None:
        return listed.filter(F.col("interpolated_block_number") >= first_block)
    if first_date is not None:
        return listed.filter(F.col("datetime") >= first_date)
    return listed


def snapshot_ranges(listed: DataFrame, first_block: Column, latest_block: Column, max_length: Column | int) -> DataFrame:
    """Ranges between sampled blocks and the block in their middle at which a snapshot is taken."""
    numbered = listed.withColumn("_block", F.floor("interpolated_block_number").cast("bigint"))
    ranges = intervals.ranges_from_blocks(numbered, ["chain"], "_block", first_block, latest_block, max_length)
    return ranges.withColumn("snapshot_block", midpoint(F.col("from"), F.col("to")))


def match_readings(asked: DataFrame, readings: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(ranges answered by exactly one reading at their snapshot block, ranges answered by none or several)."""
    at = [*keys, "snapshot_block"]
    payload = [c for c in readings.columns if c not in (*keys, "block_number")]
    # nearly every reading is a group of its own, so what a task holds is as much as it reads: tasks follow the rows
    tasks = tasks_for(readings, asked)
    asked = asked.repartition(tasks, *at)
    answers = (
        readings.withColumnRenamed("block_number", "snapshot_block")
        .repartition(tasks, *at)
        .groupBy(*at)
        .agg(F.count("*").alias("_answers"), *[F.first(c).alias(c) for c in payload])
    )
    joined = asked.join(answers, at, "left")
    once = F.coalesce(F.col("_answers") == 1, F.lit(False))
    return joined.filter(once).drop("_answers"), joined.filter(~once).select(*asked.columns, "_answers")


def share_rate_series(readings: DataFrame) -> DataFrame:
    """Readings (ppfs and decimals) as share-rate ticks, one per feed and block."""
    rate = evm.share_rate(F.col("ppfs"), F.col("share_decimals"), F.col("underlying_decimals"))
    return readings.groupBy("price_feed_id", "block_number").agg(
        F.min("datetime").alias("datetime"), F.min(rate).alias("price")
    )


def split_readings(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings whose supplies can be held in token units, the others with the ``reason``)."""
    fits = (
        evm.fits_scaled(F.col("raw_staked"), F.col("underlying_decimals"))
        & evm.fits_scaled(F.col("raw_underlying_supply"), F.col("underlying_decimals"))
        & evm.fits_scaled(F.col("raw_vault_supply"), F.col("share_decimals"))
    )
    return readings.filter(fits), readings.filter(~fits).withColumn("reason", F.lit(TOO_LARGE))


def vault_stats(readings: DataFrame) -> DataFrame:
    """Scaled supplies, share rate and the share of the underlying's supply held by the vault.

    A supply that does not fit fails the job; ``split_readings`` takes such readings out first.
    """
    staked = evm.scaled(F.col("raw_staked"), F.col("underlying_decimals"))
    total = evm.scaled(F.col("raw_underlying_supply"), F.col("underlying_decimals"))
    return readings.select(
        "product_id",
        "datetime",
        "block_number",
        evm.scaled(F.col("raw_vault_supply"), F.col("share_decimals")).alias("vault_total_supply"),
        evm.share_rate(F.col("ppfs"), F.col("share_decimals"), F.col("underlying_decimals")).alias("share_to_underlying_price"),
        staked.alias("staked_underlying"),
        total.alias("underlying_total_supply"),
        F.try_divide(staked.cast("double"), total.cast("double")).alias("underlying_capture_percentage"),
    )
