"""Products, price feeds and ignored addresses built from versioned definitions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hexbytes import ZERO_ADDRESS, from_hex_text, is_address
from tidemark.functions.json_fields import contract_address
from tidemark.operators.latest import keep_first
from tidemark.operators.upsert import strict

# fixed values: contracts that hold shares on behalf of others, by network
MANUAL_IGNORED = [
    ("0x000000000000000000000000000000000000dead", "fantom"),
    ("0x2c85a6aa1974230d3e91ba32956271e5a11b0392", "bsc"),
    ("0xb9208616368c362c531afe3b813a5cef181399b7", "bsc"),
    ("0x00957197874ee40211fe15b205754124834da532", "fantom"),
    ("0x27caa27b47182873add2acff8212a5a664c1a4a0", "bsc"),
    ("0x155f5acbda6ad32e74297836139edc13ee391a35", "bsc"),
    ("0x4f44b32be113e56f279554efa4e70128dc57c7ec", "fantom"),
    ("0x75d4ab6843593c111eeb02ff07055009c836a1ef", "fantom"),
    ("0x3609a304c6a41d87e895b9c1fd18c02ba989ba90", "fantom"),
    ("0xbf0ff8ac03f3e0dd7d8faa9b571eba999a854146", "fantom"),
    ("0x5563cc1ee23c4b17c861418cff16641d46e12436", "fantom"),
    ("0xc1c7ef18abc94013f6c58c6cdf9e829a48075b4e", "fantom"),
    ("0x8e5e4d08485673770ab372c05f95081be0636fa2", "fantom"),
    ("0x8bf3552f84ff21056d92f5e7bc47ee613786d4fc", "fantom"),
    ("0xf9ce2522027bd40d3b1aee4abe969831fe3beaf5", "optimism"),
    ("0x20dd72ed959b6147912c2e529f0a0c651c33c9ce", "fantom"),
    ("0x3f4f523acf811e713e7c34852b24e927d773a9e5", "fantom"),
    ("0xbc3df9a5879432135f4a976795b1fc1728279012", "polygon"),
    ("0x3983c50ff4cd25b43a335d63839b1e36c7930d41", "optimism"),
    ("0x230691a28c8290a553bfbc911ab2aba0b2df152d", "fantom"),
    ("0xd126ba764d2fa052fc14ae012aef590bc6ae0c4f", "polygon"),
    ("0x24aaab9da14308baf9d670e2a37369fe8cb5fe36", "fuse"),
    ("0xa9e6e271b27b20f65394914f8784b3b860dbd259", "cronos"),
    ("0xca077eec87e2621f5b09afe47c42baf88c6af18c", "avax"),
    ("0xc808b28a006c91523de75ea23f48be8b7a9536d1", "optimism"),
    ("0xc9a509da14525ad3710e9448a0839ee2e90e48b1", "moonriver"),
    ("0xe2379cb4c4627e5e9df459ce08c2342c696c4c1f", "fantom"),
    ("0xc2d2a8e5237d17abd9313dc17b5ab2a9b8c8c019", "fantom"),
]


def newest_definitions(
    versions: DataFrame,
    definitions: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    is_retired: Column,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Slowly-changing reduction: each key's newest definition and the date it was retired.

    ``versions`` lists every readable version (``scope`` columns, ``order`` columns, ``version_date``) and
    ``definitions`` what each contains (``keys``, ``order`` columns and payload). A key is live in the versions
    that hold it unretired. It is retired at the first version after its last live one, whether that one marks it
    or drops it; a later revival clears the date. One aggregate per key: no key x version grid.
    """
    scope, order = list(scope), list(order)
    listed = versions.select(*scope, *order, "version_date").distinct()
    at = F.struct(*order)
    by_scope = Window.partitionBy(*scope).orderBy(*order)
    following = listed.select(
        *scope, at.alias("_last_live"), F.lead("version_date").over(by_scope).alias("_retired_after_live")
    )
    payload = [c for c in definitions.columns if c not in (*keys, *order, "version_date")]
    seen = definitions.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), at).alias("_newest"),
        F.max(F.when(~is_retired, at)).alias("_last_live"),
        F.min_by("version_date", at).alias("_first_date"),
        F.max_by("version_date", at).alias("version_date"),
    )
    dated = seen.join(following, [*[k for k in scope], "_last_live"], "left")
    never_live = F.col("_last_live").isNull()
    retired_date = F.when(never_live, F.col("_first_date")).otherwise(F.col("_retired_after_live"))
    return dated.select(
        *keys,
        *[F.col("_newest")[c].alias(c) for c in payload if c not in keys],
        "version_date",
        retired_date.alias("eol_date"),
        retired_date.isNotNull().alias("eol"),
    )


def usable_vaults(definitions: DataFrame) -> DataFrame:
    """Definitions with an earned-token address and a valid contract address."""
    return definitions.filter(F.col("earned_token_address").isNotNull() & (F.col("earned_token_address") != "")).filter(
        is_address(F.col("contract_address"))
    )


def without_managed_liquidity(definitions: DataFrame) -> DataFrame:
    """Leave out concentrated-liquidity vaults and the reward pools on top of them."""
    # fixed values: the type names and token prefixes of such vaults
    pool = (
        (F.col("type") == "gov")
        & (F.col("version") >= 2)
        & F.col("token").startswith("cow")
        & F.col("earned_token").startswith("rCow")
    )
    return definitions.filter(~F.coalesce(pool, F.lit(False)) & ~F.coalesce(F.col("type") == "cowcentrated", F.lit(False)))


def protocol_columns(oracle_id: Column, own_protocol: str, own_tokens: Sequence[str] = ()) -> dict[str, Column]:
    """Protocol and product from an oracle id: split at the first dash; the house's own tokens go to itself."""
    dashed = oracle_id.contains("-")
    own = oracle_id.startswith("be") | oracle_id.isin(list(own_tokens))
    return {
        "protocol": F.when(dashed, F.substring_index(oracle_id, "-", 1))
        .when(own, F.lit(own_protocol))
        .otherwise(F.lit("unknown")),
        "protocol_product": F.when(dashed, F.regexp_extract(oracle_id, r"(?s)^[^-]*-(.*)$", 1)).otherwise(oracle_id),
    }


def expand_bridged(vaults: DataFrame, bridged: str = "bridged") -> DataFrame:
    """Each vault plus one copy per network it is bridged to (``bridged``: map network -> contract address).

    Only standard vaults have copies; a copy keeps the original's id and network for its price feeds.
    """
    original = vaults.withColumns({"origin_chain": F.col("chain"), "origin_id": F.col("id"), "is_bridged": F.lit(False)})
    copies = (
        original.filter(~F.col("is_gov_vault"))
        .select("*", F.explode(F.map_entries(bridged)).alias("_copy"))
        .filter(F.col("_copy.value").isNotNull())
        .withColumns(
            {
                "id": F.concat_ws("-", F.col("_copy.key"), F.lit("bridged"), F.col("id")),
                "token_name": F.concat_ws(" ", F.col("_copy.key"), F.col("token_name")),
                "chain": F.col("_copy.key"),
                "contract_address": F.col("_copy.value"),
                "token_decimals": F.lit(18),
                "is_bridged": F.lit(True),
            }
        )
        .drop("_copy")
    )
    return original.unionByName(copies).drop(bridged)


def normalize_vault_id(vault_id: Column) -> Column:
    """Ids get a suffix when a vault is retired or paused; strip each kind once, in this order."""
    for suffix in ("-eol", "-pause", "=eol"):
        vault_id = F.regexp_replace(vault_id, f"{suffix}$", "")
    return vault_id


def is_dashboard_eol(eol: Column, eol_date: Column, as_of: datetime | Column, after_days: int = 30) -> Column:
    """Retired for longer than a month; FALSE when the retirement date is unknown."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    old = eol_date < now - F.expr(f"INTERVAL {after_days} DAY")
    return F.when(eol & eol_date.isNotNull(), old).otherwise(F.lit(False))


def share_feeds(vaults: DataFrame, namespace: str) -> DataFrame:
    """Feed 1 of each vault: share -> underlying. Bridged copies share their original's feed."""
    vault_id = normalize_vault_id(F.col("origin_id"))
    share = F.concat_ws(":", F.lit(namespace), F.col("origin_chain"), vault_id)
    return vaults.select(
        F.concat_ws(":", share, F.lit("ppfs")).alias("feed_key"),
        share.alias("from_asset_key"),
        F.concat_ws(":", "protocol", "origin_chain", "protocol_product").alias("to_asset_key"),
        F.to_json(F.struct((~F.col("eol")).alias("active"), vault_id.alias("externalId"))).alias("price_feed_data"),
    )


def usd_feeds(vaults: DataFrame, namespace: str, as_of: datetime) -> DataFrame:
    """Feed 2 of each vault: underlying -> USD."""
    underlying = F.concat_ws(":", "protocol", "origin_chain", "protocol_product")
    active = ~is_dashboard_eol(F.col("eol"), F.col("eol_date"), as_of)
    return vaults.select(
        F.concat_ws(":", F.lit(f"{namespace}-data"), underlying).alias("feed_key"),
        underlying.alias("from_asset_key"),
        F.lit("fiat:USD").alias("to_asset_key"),
        F.to_json(F.struct(active.alias("active"), F.col("want_price_feed_key").alias("externalId"))).alias("price_feed_data"),
    )


def reward_feeds(products: DataFrame, reward_token: Column, namespace: str, as_of: datetime) -> DataFrame:
    """Feed of the reward token -> USD, for governance vaults and boosts."""
    asset = F.concat_ws(":", F.col("chain"), reward_token)
    active = ~is_dashboard_eol(F.col("eol"), F.col("eol_date"), as_of)
    return products.select(
        F.concat_ws(":", F.lit(f"{namespace}-data"), asset).alias("feed_key"),
        asset.alias("from_asset_key"),
        F.lit("fiat:USD").alias("to_asset_key"),
        F.to_json(F.struct(active.alias("active"), reward_token.alias("externalId"))).alias("price_feed_data"),
    )


def product_key(namespace: str, kind: str, chain: Column, address: Column) -> Column:
    return F.concat_ws(":", F.lit(namespace), F.lit(kind), chain, F.lower(address))


def attach_boosts(boosts: DataFrame, vaults: DataFrame, require: bool = True) -> DataFrame:
    """Boosts with the two feeds of the vault they belong to (matched on chain and normalised id).

    A boost without its vault is an error unless ``require`` is off, which keeps it with NULL feeds.
    """
    feeds = vaults.select(
        "chain", normalize_vault_id(F.col("id")).alias("_vault"), "price_feed_1_id", "price_feed_2_id", F.lit(True).alias("_found")
    )
    feeds = keep_first(feeds, ["chain", "_vault"], ["price_feed_1_id"])
    joined = boosts.withColumn("_vault", normalize_vault_id(F.col("vault_id"))).join(feeds, ["chain", "_vault"], "left")
    if require:
        joined = strict(joined, F.col("_found").isNotNull(), "boost without its vault")
    return joined.drop("_vault", "_found")


def log_contracts(products: DataFrame) -> DataFrame:
    """Contract, decimals and event kinds of each product, by its type.

    Boosts and governance vaults are staked into; a governance vault counts in the staked token's decimals.
    """
    data = F.col("product_data")
    kind = F.get_json_object(data, "$.type")
    boost, governance = kind.endswith("boost"), kind.endswith("gov-vault")
    decimals = (
        F.when(boost, F.get_json_object(data, "$.boost.staked_token_decimals"))
        .when(governance, F.get_json_object(data, "$.vault.want_decimals"))
        .otherwise(F.get_json_object(data, "$.vault.token_decimals"))
    )
    return products.select(
        "product_id", "chain", contract_address(data).alias("contract_address"),
        decimals.cast("int").alias("decimals"), (boost | governance).alias("stakes"),
    )


def share_rate_targets(products: DataFrame) -> DataFrame:
    """Standard vaults to read share rates from: one per share-rate feed (bridged copies share their vault's)."""
    kind = F.get_json_object("product_data", "$.type")
    standard = products.filter((kind == "vault") | kind.endswith(":vault")).filter(F.col("price_feed_1_id").isNotNull())
    return keep_first(standard.select("price_feed_1_id", "product_id", "chain"), ["price_feed_1_id"], ["product_id"])


def valid_zaps(zaps: DataFrame, chain: str | None = None) -> DataFrame:
    """Helper-contract addresses, valid ones only, of one chain or of all."""
    kept = zaps.filter(is_address(F.col("address")))
    if chain is not None:
        kept = kept.filter(F.col("chain") == chain)
    return kept.select("chain", F.lower("address").alias("address"))


def ignored_addresses(products: DataFrame, zaps: DataFrame, chains: DataFrame) -> DataFrame:
    """Addresses that are never investors: product contracts, the zero address, known holders, helper contracts."""
    spark = products.sparkSession
    listed = spark.createDataFrame(MANUAL_IGNORED, "address STRING, chain STRING").select("chain", "address")
    everywhere = chains.select("chain", F.lit(ZERO_ADDRESS).alias("address"))
    return (
        products.select("chain", F.lower("contract_address").alias("address"))
        .unionByName(everywhere)
        .unionByName(listed)
        .unionByName(valid_zaps(zaps))
        .distinct()
        .select("chain", from_hex_text(F.col("address")).alias("address"))
    )


def feed_work_list(products: DataFrame, feeds: DataFrame) -> DataFrame:
    """Distinct feeds behind a set of products: underlying prices and reward prices."""
    wanted = (
        products.select(F.col("price_feed_2_id").alias("price_feed_id"))
        .unionByName(products.select(F.col("pending_rewards_price_feed_id").alias("price_feed_id")))
        .filter(F.col("price_feed_id").isNotNull())
        .distinct()
    )
    return feeds.join(wanted, "price_feed_id", "left_semi")
