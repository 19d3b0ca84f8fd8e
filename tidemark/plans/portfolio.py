"""Balances, timelines, holder counts and the lookups around them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hexbytes import from_hex_text, to_hex_text
from tidemark.functions.json_fields import contract_address, display_id, is_eol, is_true, pretty, variant_field
from tidemark.functions.timegrid import interval, time_bucket
from tidemark.operators import bitmaps, sketches
from tidemark.operators.asof import first_at_or_above
from tidemark.operators.latest import current_holders, last_by
from tidemark.operators.ohlc import rollup_between
from tidemark.plans.valuation import value

COUNT_THRESHOLDS = [10**k for k in range(8)]

# fixed values: asset types, and the feed-key patterns of a share token
SHARE_ASSET, OTHER_ASSET = "mooToken", "token"
SHARE_KEY_PATTERNS = ("^[a-z0-9:_-]+$", ":moo[^:]+$")


class NotReady(RuntimeError):
    """The requested block cannot be answered from what has been imported."""


def check_ready(states: DataFrame, ranges: DataFrame, block: int, allow_later_retries: bool = True) -> None:
    """Raise unless every state is created, indexed up to ``block`` and has nothing (earlier) to retry.

    One aggregate row comes back to the caller, never the states themselves.
    """
    retry = ranges.filter(F.col("kind") == "retry")
    if allow_later_retries:
        retry = retry.filter(F.col("from") < block)
    facts = states.agg(
        F.count("*").alias("states"),
        F.max((F.col("contract_created_at_block") > block).cast("int")).alias("uncreated"),
        F.min("chain_latest_block_number").alias("latest"),
    ).first()
    if not facts["states"]:
        raise NotReady("Import state not found")
    if facts["uncreated"]:
        raise NotReady("This block is before the contract creation")
    if facts["latest"] < block:
        raise NotReady(f"This block is not yet indexed. Last indexed block: {facts['latest']}")
    if not retry.join(states.select("import_key"), "import_key", "left_semi").limit(1).isEmpty():
        raise NotReady("Some previous block was not indexed")


def block_time(blocks: DataFrame, chain: str, block: int) -> datetime:
    """When a chain's block was made: the time of the earliest stored block that is not below it. One row comes back."""
    row = first_at_or_above(blocks.filter(F.col("chain") == chain), F.lit(block)).first()
    if row is None:
        raise NotReady(f"No block of {chain} at or after {block} is stored")
    return row["datetime"]


def balances_at_block(
    ledger: DataFrame,
    products: DataFrame,
    investors: DataFrame,
    ticks: DataFrame,
    blocks: DataFrame,
    states: DataFrame,
    ranges: DataFrame,
    chain: str,
    block: int,
    at: datetime | None = None,
    grace: str | None = None,
    require_prices: bool = True,
) -> DataFrame:
    """``balances_at`` for a chain's products, refused unless their imports are ready for the block. The block's time is
    looked up unless given; each product's ledger counts from the creation of its contract; prices are rolled up for
    the one hour that is asked for."""
    scope = products.filter(F.col("chain") == chain)
    own = states.join(scope.select("product_id"), "product_id", "left_semi")
    check_ready(own, ranges, block)
    at = at or block_time(blocks, chain, block)
    created = own.groupBy("product_id").agg(F.min("contract_creation_date").alias("_created"))
    rows = ledger.join(created, "product_id").filter(F.col("datetime") >= F.col("_created")).drop("_created")
    return balances_at(rows, scope, investors, rollup_between(ticks, "1hour", at, at), block, at, None, grace, require_prices)


def balances_at(
    ledger: DataFrame,
    products: DataFrame,
    investors: DataFrame,
    hourly: DataFrame,
    block: int | Column,
    block_time: datetime | Column,
    since: datetime | Column | None = None,
    grace: str | None = None,
    require_prices: bool = True,
) -> DataFrame:
    """Holders of every product in ``products`` at a block, valued at that hour's average prices.

    ``grace`` widens the ledger window past the block time. With ``require_prices`` a product lacking either
    hourly price has no rows; otherwise its values are NULL.
    """
    at = block_time if isinstance(block_time, Column) else F.lit(block_time)
    end = at if grace is None else at + interval(grace)
    rows = ledger.filter((F.col("datetime") <= end) & (F.col("block_number") <= block))
    if since is not None:
        rows = rows.filter(F.col("datetime") >= (since if isinstance(since, Column) else F.lit(since)))
    scope = products.select("product_id", "price_feed_1_id", "price_feed_2_id", "product_data")
    last = current_holders(rows.join(scope.select("product_id"), "product_id", "left_semi"))
    hour = hourly.filter(F.col("datetime") == time_bucket("1hour", at))
    how = "inner" if require_prices else "left"
    p1 = hour.select(F.col("price_feed_id").alias("price_feed_1_id"), F.col("price_avg").alias("share_to_underlying_price"))
    p2 = hour.select(F.col("price_feed_id").alias("price_feed_2_id"), F.col("price_avg").alias("underlying_to_usd_price"))
    # price the few products first, then join them once to the many holders
    priced = scope.join(p1, "price_feed_1_id", how).join(p2, "price_feed_2_id", how)
    share, usd = F.col("share_to_underlying_price"), F.col("underlying_to_usd_price")
    return (
        last.join(priced, "product_id")
        .join(investors.select("investor_id", "address"), "investor_id")
        .select(
            "product_id",
            F.get_json_object("product_data", "$.vault.id").alias("vault_id"),
            F.get_json_object("product_data", "$.vault.contract_address").alias("vault_address"),
            F.get_json_object("product_data", "$.vault.want_address").alias("want_address"),
            to_hex_text(F.col("address")).alias("investor_address"),
            "share_to_underlying_price",
            "underlying_to_usd_price",
            F.col("last_balance").cast("double").alias("share_token_balance"),
            value(F.col("last_balance"), share).alias("underlying_balance"),
            value(F.col("last_balance"), share, usd).alias("usd_balance"),
        )
    )


def points_products(products: DataFrame, platform_id: str | None = None, chain: str | None = None, include_eol: bool = False) -> DataFrame:
    """Products whose vault earns points, of one platform and chain if given."""
    kept = live_products(products, include_eol).filter(is_true(F.col("product_data"), "$.vault.earning_eigenlayer_points"))
    if platform_id is not None:
        kept = kept.filter(F.get_json_object("product_data", "$.vault.platform_id") == platform_id)
    return kept if chain is None else kept.filter(F.col("chain") == chain)


def live_products(products: DataFrame, include_eol: bool = False) -> DataFrame:
    allowed = ["true", "false"] if include_eol else ["false"]
    return products.filter(F.get_json_object("product_data", "$.dashboardEol").isin(allowed))


def not_retired(products: DataFrame, chains: Sequence[str] | None = None) -> DataFrame:
    """Products whose own variant says ``eol`` is false."""
    kept = products.filter(variant_field(F.col("product_data"), "eol", ("boost", "vault")) == "false")
    return kept if chains is None else kept.filter(F.col("chain").isin(list(chains)))


def select_products(
    products: DataFrame,
    include_eol: bool = False,
    chain: str | None = None,
    address: str | None = None,
    key: str | None = None,
) -> DataFrame:
    """Product lookups: all, by chain, by contract address (any case) or by key (any case)."""
    if key is not None:
        return products.filter(F.col("product_key") == key.lower())
    kept = products if address is not None else live_products(products, include_eol)
    if chain is not None:
        kept = kept.filter(F.col("chain") == chain)
    if address is not None:
        kept = kept.filter(contract_address(F.col("product_data")) == address.lower())
    return kept


def investor_timeline(timeline: DataFrame, products: DataFrame, investor_id: int | None = None) -> DataFrame:
    rows = timeline if investor_id is None else timeline.filter(F.col("investor_id") == investor_id)
    data = F.col("product_data")
    return rows.join(products.select("product_id", "product_key", "chain", "product_data"), "product_id").select(
        "investor_id",
        "datetime",
        "product_key",
        display_id(data).alias("display_name"),
        "chain",
        is_eol(data).alias("is_eol"),
        is_true(data, "$.dashboardEol").alias("is_dashboard_eol"),
        to_hex_text(F.col("transaction_hash")).alias("transaction_hash"),
        "share_to_underlying_price",
        "underlying_to_usd_price",
        F.col("balance").alias("share_balance"),
        "underlying_balance",
        "usd_balance",
        F.col("balance_diff").alias("share_diff"),
        "underlying_diff",
        "usd_diff",
    )


def threshold_counts(timeline: DataFrame, products: DataFrame) -> DataFrame:
    """Investors ever seen per product (a last balance of 0 still counts), and above 1, 10, ... 10^7 USD."""
    last = timeline.groupBy("product_id", "investor_id").agg(
        last_by("usd_balance", "datetime", "block_number").alias("usd")
    )
    counts = last.groupBy("product_id").agg(
        F.count("*").alias("investor_count"),
        *[F.count_if(F.col("usd") > n).alias(f"investor_count_more_than_{n}_usd") for n in COUNT_THRESHOLDS],
    )
    return counts.join(
        products.select("product_id", "product_key", display_id(F.col("product_data")).alias("vault_id")), "product_id"
    )


def investor_counts(timeline: DataFrame, snapshots: DataFrame, products: DataFrame, as_of: datetime) -> DataFrame:
    """Threshold counts of live products with their sketch counts of 3, 7, 15 and 30 days ago."""
    live = live_products(products)
    history = sketches.counts_before(
        snapshots, F.lit(as_of), {"hist_3d": 3, "hist_7d": 7, "hist_15d": 15, "hist_30d": 30}
    )
    scoped = timeline.join(live.select("product_id"), "product_id", "left_semi")
    return threshold_counts(scoped, live).join(history, "product_id", "left")


def product_holders(ledger: DataFrame, investors: DataFrame) -> DataFrame:
    """Current holders per product with their balance and last event."""
    return (
        current_holders(ledger)
        .join(investors.select("investor_id", "address"), "investor_id")
        .select(
            "product_id",
            to_hex_text(F.col("address")).alias("investor_address"),
            F.col("last_balance").cast("string").alias("balance_txt"),
            F.col("last_balance").alias("balance_num"),
            F.col("last_datetime").alias("last_event"),
            F.col("last_block_number").alias("last_event_block_number"),
        )
    )


def holder_totals(ledger: DataFrame, investors: DataFrame, min_balance: float) -> DataFrame:
    """Per address, the sum of its investors' last balances, where above a minimum; with its log10."""
    last = ledger.groupBy("investor_id").agg(last_by("balance", "datetime", "block_number").alias("last_balance"))
    total = F.sum("last_balance")
    return (
        last.join(investors.select("investor_id", "address"), "investor_id", "left")
        .groupBy(to_hex_text(F.col("address")).alias("address"))
        .agg(total.alias("total_balance"))
        .filter(F.col("total_balance") > min_balance)
        .withColumn("log_balance", F.log10(F.col("total_balance").cast("double")))
    )


def holder_histogram(totals: DataFrame, buckets: int, low: float, high: float) -> DataFrame:
    """Holders per log-size bucket; 0 and ``buckets + 1`` hold what lies outside [low, high)."""
    return totals.groupBy(
        F.width_bucket("log_balance", F.lit(float(low)), F.lit(float(high)), F.lit(buckets)).alias("bucket")
    ).agg(F.count("*").alias("holders"))


def exact_holders(ledger: DataFrame, period: str, lo: Column, hi: Column) -> DataFrame:
    """Distinct investors with a positive carried-forward balance, per bucket; buckets with none are left out."""
    return bitmaps.counts(bitmaps.holders(ledger, [], period, lo, hi), ["datetime"])


def holders_by(holdings: DataFrame, products: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct holders per day and product attribute, from the stored bitmaps of each product and day."""
    named = holdings.join(products.select("product_id", *by), "product_id")
    return bitmaps.counts(named, ["datetime", *by])


def transactions(rows: DataFrame, products: DataFrame, rates: DataFrame | None = None, valued: bool = False) -> DataFrame:
    """Transaction list: raw, with the share rate of the same block, or valued (rows of the timeline)."""
    listed = rows.join(products.select("product_id", "product_key", "chain", "product_data", "price_feed_1_id"), "product_id")
    columns = [
        "chain",
        "product_key",
        display_id(F.col("product_data")).alias("product_name"),
        "investor_id",
        "datetime",
        "block_number",
        F.col("balance"),
        F.col("balance_diff"),
    ]
    if rates is not None:
        tick = rates.select(
            F.col("price_feed_id").alias("price_feed_1_id"), "datetime", "block_number", F.col("price").alias("ppfs")
        )
        listed = listed.join(tick, ["price_feed_1_id", "datetime", "block_number"])
        columns.append(F.col("ppfs"))
    if valued:
        columns += ["share_to_underlying_price", "underlying_balance", "underlying_diff", "underlying_to_usd_price", "usd_balance", "usd_diff"]
    return listed.select(*columns, to_hex_text(F.col("transaction_hash")).alias("trx_hash"))


def investor_by_address(investors: DataFrame, address: str | DataFrame) -> DataFrame:
    """Investor ids of one address, or of a frame of addresses (text, any case)."""
    if isinstance(address, DataFrame):
        wanted = address.select(from_hex_text(F.lower(F.col(address.columns[0]))).alias("address"))
        return investors.join(wanted, "address", "left_semi")
    return investors.filter(F.col("address") == from_hex_text(F.lit(address.lower())))


def ledger_export(ledger: DataFrame, products: DataFrame, investors: DataFrame) -> DataFrame:
    return (
        ledger.join(products.select("product_id", "product_key", "chain"), "product_id", "left")
        .join(investors.select("investor_id", "address"), "investor_id", "left")
        .select(
            "datetime", "block_number", "chain", "product_key",
            to_hex_text(F.col("address")).alias("investor_address"), "balance",
        )
    )


def feed_ticks(prices: DataFrame, feeds: DataFrame) -> DataFrame:
    """Raw prices with their feed key, numeric and as text."""
    return prices.join(feeds.select("price_feed_id", "feed_key"), "price_feed_id", "left").select(
        "datetime", "feed_key", "block_number", F.col("price").cast("double").alias("price"), F.col("price").cast("string").alias("price_txt")
    )


def product_ticks(prices: DataFrame, products: DataFrame, hop: int) -> DataFrame:
    """Ticks of each product through its first or second feed."""
    feed = F.col(f"price_feed_{hop}_id")
    return prices.join(products.select("product_id", feed.alias("price_feed_id")), "price_feed_id").select(
        "product_id", "datetime", "block_number", "price"
    )


def products_sharing_feed(products: DataFrame) -> DataFrame:
    """Products whose share-rate feed also serves another product."""
    shared = products.groupBy("price_feed_1_id").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return products.join(shared, "price_feed_1_id", "left_semi").select("price_feed_1_id", "product_id", "product_key")


def find_feed(feeds: DataFrame, price_type: str, namespace: str, external_id: str | None = None) -> DataFrame:
    """Smallest feed id of each external id (or of one) among share-rate or USD feeds."""
    key = F.col("feed_key")
    if price_type == "share_to_underlying":
        kind = key.startswith(f"{namespace}:") & key.endswith(":ppfs")
    elif price_type == "underlying_to_usd":
        kind = key.startswith(f"{namespace}-data:")
    else:
        kind = F.lit(False)
    outer = F.get_json_object("price_feed_data", "$.externalId").alias("external_id")
    found = feeds.filter(kind).groupBy(outer).agg(
        F.min("price_feed_id").alias("price_feed_id"), F.min_by("feed_key", "price_feed_id").alias("feed_key")
    )
    return found if external_id is None else found.filter(F.col("external_id") == external_id)


def classify_feeds(feeds: DataFrame, kinds: Sequence[str] | None = None, text: str = "") -> DataFrame:
    """USD feeds with an asset type read off the key; filtered by type and by a text in the key if given."""
    key = F.col("feed_key")
    is_share = key.rlike(SHARE_KEY_PATTERNS[0]) | key.rlike(SHARE_KEY_PATTERNS[1])
    typed = feeds.filter(F.col("to_asset_key") == "fiat:USD").withColumn(
        "asset_type", F.when(is_share, F.lit(SHARE_ASSET)).otherwise(F.lit(OTHER_ASSET))
    )
    if kinds is not None:
        typed = typed.filter(F.col("asset_type").isin(list(kinds)))
    return typed.filter(key.contains(text)) if text else typed


def as_column_values(rows: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """One (column, value) row per field, all as text."""
    texts = rows.select(F.col(key).alias("_id"), *[c.cast("string").alias(n) for n, c in columns.items()])
    return texts.unpivot("_id", list(columns), "column", "value").withColumnRenamed("_id", key)


def product_fields(products: DataFrame) -> DataFrame:
    data = F.col("product_data")
    return as_column_values(
        products,
        "product_id",
        {
            "product_id": F.col("product_id"),
            "product_key": F.col("product_key"),
            "chain": F.col("chain"),
            "price_feed_1_id": F.col("price_feed_1_id"),
            "price_feed_2_id": F.col("price_feed_2_id"),
            "contract_address": contract_address(data),
            "product_data": pretty(data),
        },
    )


def chain_products(products: DataFrame) -> DataFrame:
    """The products of each chain, one row per product."""
    return products.select("chain", "product_id")


def lookup(requests: DataFrame, dim: DataFrame, on: str, require: bool = False) -> DataFrame:
    """Requests enriched by id; a missing id gives NULLs, or an error with ``require``."""
    from tidemark.operators.upsert import strict

    joined = requests.join(dim.withColumn("_found", F.lit(True)), on, "left")
    if require:
        joined = strict(joined, F.col("_found").isNotNull(), f"unknown {on}")
    return joined.drop("_found")
