"""Products, feeds, investors: lookups, versioned definitions, dimension builds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import json_fields as jf
from tidemark.functions.hexbytes import from_hex_text, is_address, to_hex_text
from tidemark.functions.timegrid import SAMPLING_MS
from tidemark.operators import upsert as up
from tidemark.operators.json_merge import leaves, merge_column
from tidemark.operators.latest import keep_first
from tidemark.plans import dims, portfolio
from tidemark.queries.registry import query
from tidemark.session import dealt, scratch_path
from tidemark.sources import readers
from tidemark.sources.standins import _address, _chain_of, _sql_addr, _sql_chain

AS_OF = datetime(2024, 2, 1)


@query("product_display_ids", "P1 P2 P4", "SELECT product_id, display_id, is_eol, is_eol AS is_dashboard_eol, contract_address FROM products")
def _(t):
    data = F.col("product_data")
    return t.products.select(
        "product_id", jf.display_id(data).alias("display_id"), jf.is_eol(data).alias("is_eol"),
        jf.is_true(data, "$.dashboardEol").alias("is_dashboard_eol"), jf.contract_address(data).alias("contract_address"),
    )


@query("products_live", "P4 P9 P3", "SELECT product_id, product_key, chain FROM products WHERE NOT is_eol")
def _(t):
    return portfolio.select_products(t.products).select("product_id", "product_key", "chain")


@query("products_all_of_chain", "P3 P9", "SELECT product_id, product_key FROM products WHERE chain = 'purchase'")
def _(t):
    return portfolio.select_products(t.products, include_eol=True, chain="purchase").select("product_id", "product_key")


@query("product_by_contract", "P9", f"SELECT product_id, product_key FROM products WHERE chain = 'view' AND contract_address = {_sql_addr('CAST(174 AS BIGINT)')}")
def _(t):
    found = portfolio.select_products(t.products, chain="view", address="0x" + "0" * 38 + "AE")
    return found.select("product_id", "product_key")


@query("product_by_key", "P9 F2", f"SELECT product_id, chain FROM products WHERE product_key = 'boost:view:' || {_sql_addr('CAST(174 AS BIGINT)')}")
def _(t):
    found = portfolio.select_products(t.products, key="BOOST:VIEW:0x" + "0" * 38 + "AE")
    return found.select("product_id", "chain")


@query("products_earning_points", "P9", "SELECT product_id, platform_id FROM products WHERE NOT is_eol AND NOT is_boost AND earns_points")
def _(t):
    return portfolio.points_products(t.products).select("product_id", F.get_json_object("product_data", "$.vault.platform_id").alias("platform_id"))


@query(
    "products_dashboard_eol", "P5",
    """SELECT product_id, CASE WHEN is_eol AND d IS NOT NULL THEN d < TIMESTAMP '2024-02-01' - INTERVAL 30 DAY ELSE false END AS dashboard_eol
       FROM (SELECT product_id, is_eol, CASE WHEN product_id % 4 <> 0 THEN TIMESTAMP '2024-02-01' - to_days(CAST(product_id % 60 AS INT)) END AS d FROM products)""",
)
def _(t):
    since = F.timestamp_seconds(F.unix_seconds(F.lit(AS_OF)) - F.pmod("product_id", F.lit(60)) * 86400)
    date = F.when(F.pmod("product_id", F.lit(4)) != 0, since)
    return t.products.select("product_id", dims.is_dashboard_eol(jf.is_eol(F.col("product_data")), date, AS_OF).alias("dashboard_eol"))


@query(
    "feeds_classified", "P6 P7",
    """SELECT price_feed_id, feed_key, CASE WHEN regexp_matches(feed_key, '^[a-z0-9:_-]+$') OR regexp_matches(feed_key, ':moo[^:]+$') THEN 'mooToken' ELSE 'token' END AS asset_type
       FROM feeds WHERE to_asset_key = 'fiat:USD' AND feed_key LIKE '%click%'""",
)
def _(t):
    return portfolio.classify_feeds(t.feeds, text="click").select("price_feed_id", "feed_key", "asset_type")


@query(
    "feeds_by_external_id", "P8 P7",
    """SELECT external_id, min(price_feed_id) AS price_feed_id, arg_min(feed_key, price_feed_id) AS feed_key FROM feeds WHERE feed_key LIKE 'tide-data:%' GROUP BY 1""",
)
def _(t):
    return portfolio.find_feed(t.feeds, "underlying_to_usd", "tide")


@query(
    "feed_of_share_rate", "P8",
    """SELECT external_id, min(price_feed_id) AS price_feed_id, arg_min(feed_key, price_feed_id) AS feed_key FROM feeds WHERE feed_key LIKE 'tide:%:ppfs' GROUP BY 1 HAVING external_id = 'small ring'""",
)
def _(t):
    return portfolio.find_feed(t.feeds, "share_to_underlying", "tide", "small ring")


@query(
    "import_keys", "P10 P17",
    """SELECT product_id, 'product:investment:' || product_id AS investment_key, 'price:feed:' || price_feed_2_id AS feed_key, 'product:statistics:' || product_id AS statistics_key, '{"chain":"' || chain || '"}' AS public_state FROM products""",
)
def _(t):
    from tidemark.plans.monitoring import feed_key, investment_key, statistics_key

    state = F.to_json(F.struct("chain", F.col("product_id").alias("productId"), F.col("price_feed_2_id").alias("priceFeedId")))
    return t.products.select(
        "product_id",
        investment_key(F.col("product_id")).alias("investment_key"),
        feed_key(F.col("price_feed_2_id")).alias("feed_key"),
        statistics_key(F.col("product_id")).alias("statistics_key"),
        jf.drop_id_fields(state).alias("public_state"),
    )


@query(
    "product_fields", "P11 P20",
    """SELECT product_id, 'product_id' AS "column", CAST(product_id AS VARCHAR) AS value FROM products UNION ALL SELECT product_id, 'product_key', product_key FROM products
       UNION ALL SELECT product_id, 'chain', chain FROM products UNION ALL SELECT product_id, 'price_feed_1_id', CAST(price_feed_1_id AS VARCHAR) FROM products
       UNION ALL SELECT product_id, 'price_feed_2_id', CAST(price_feed_2_id AS VARCHAR) FROM products UNION ALL SELECT product_id, 'contract_address', contract_address FROM products""",
)
def _(t):
    return portfolio.product_fields(t.products).filter(F.col("column") != "product_data")


@query(
    "protocol_parse", "P16",
    """SELECT p_partkey, CASE WHEN o LIKE '%-%' THEN split_part(o, '-', 1) WHEN o LIKE 'be%' OR o = 'TIDE' THEN 'tide' ELSE 'unknown' END AS protocol,
       CASE WHEN o LIKE '%-%' THEN substr(o, strpos(o, '-') + 1) ELSE o END AS protocol_product
       FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN lower(p_type) || '-' || replace(p_name, ' ', '-') WHEN 1 THEN 'be' || p_brand WHEN 2 THEN 'TIDE' ELSE p_name END AS o FROM part)""",
)
def _(t):
    key = F.pmod("p_partkey", F.lit(4))
    oracle = (
        F.when(key == 0, F.concat(F.lower("p_type"), F.lit("-"), F.replace("p_name", F.lit(" "), F.lit("-"))))
        .when(key == 1, F.concat(F.lit("be"), F.col("p_brand"))).when(key == 2, F.lit("TIDE")).otherwise(F.col("p_name"))
    )
    return t.raw("part").withColumn("o", oracle).select("p_partkey", *[c.alias(n) for n, c in dims.protocol_columns(F.col("o"), "tide", ["TIDE"]).items()])


@query("price_feed_references", "D17 O2", "SELECT price_feed_id, feed_key FROM feeds WHERE price_feed_id IN (SELECT price_feed_2_id FROM products WHERE NOT is_eol UNION SELECT pending_rewards_price_feed_id FROM products WHERE NOT is_eol)")
def _(t):
    return dims.feed_work_list(portfolio.live_products(t.products), t.feeds).select("price_feed_id", "feed_key")


@query(
    "log_contracts", "D2",
    """SELECT product_id, chain, contract_address, CAST(CASE WHEN is_boost THEN (product_id - 1) % 4 + 6 WHEN is_gov THEN 6 ELSE 18 END AS INT) AS decimals, is_boost OR is_gov AS stakes FROM products""",
)
def _(t):
    return dims.log_contracts(t.products)


@query("share_rate_targets", "D14 O2", "SELECT price_feed_1_id, min(product_id) AS product_id, arg_min(chain, product_id) AS chain FROM products WHERE NOT is_boost AND NOT is_gov AND price_feed_1_id IS NOT NULL GROUP BY 1")
def _(t):
    return dims.share_rate_targets(t.products)


@query("products_sharing_feed", "Q11 J3", "SELECT price_feed_1_id, product_id, product_key FROM products WHERE price_feed_1_id IN (SELECT price_feed_1_id FROM products GROUP BY 1 HAVING count(*) > 1)")
def _(t):
    return portfolio.products_sharing_feed(t.products)


@query("investor_ids_of_addresses", "Q12 F1 S5", "SELECT investor_id, address FROM investors WHERE address IN (SELECT address FROM ignored)")
def _(t):
    wanted = t.ignored.select(to_hex_text(F.col("address")).alias("a")).distinct().select(F.upper("a").alias("a"))
    wanted = wanted.select(F.concat(F.lit("0x"), F.substring("a", 3, 40)).alias("a"))
    return portfolio.investor_by_address(t.investors, wanted).select("investor_id", to_hex_text(F.col("address")).alias("address"))


@query("ignored_addresses_of_chain", "Q20 F1", "SELECT address FROM ignored WHERE chain = 'view'")
def _(t):
    return t.ignored.filter(F.col("chain") == "view").select(to_hex_text(F.col("address")).alias("address"))


@query("hex_round_trip", "F1 F2", "SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR)) AS digest, true AS same, CASE WHEN c_custkey % 2 = 0 THEN true ELSE false END AS valid FROM customer")
def _(t):
    text = F.concat(F.lit("0x"), F.md5(F.col("c_custkey").cast("string")))
    address = F.when(F.pmod("c_custkey", F.lit(2)) == 0, _address(F.col("c_custkey"))).otherwise(F.lit("0x12"))
    back = to_hex_text(from_hex_text(text))
    return t.raw("customer").select("c_custkey", F.substring(back, 3, 32).alias("digest"), (back == text).alias("same"), is_address(address).alias("valid"))


_TIMES = "CASE WHEN c_custkey % 100 = 0 THEN 60000 ELSE c_custkey % 1000 END"


@query("long_hex_round_trip", "F1", f"SELECT c_custkey, length(repeat(c_name, {_TIMES})) AS bytes, md5(repeat(c_name, {_TIMES})) AS digest FROM customer")
def _(t):
    # long texts, one in a hundred of 2^20 characters and more, and their hex twice as long
    long = F.repeat("c_name", F.expr(f"CAST({_TIMES} AS INT)"))
    back = from_hex_text(F.concat(F.lit("0x"), F.hex(long)))
    return dealt(t.raw("customer"), "c_custkey").select("c_custkey", F.octet_length(back).cast("bigint").alias("bytes"), F.md5(back).alias("digest"))


@query("chain_product_lists", "J22", "SELECT chain, product_id FROM products")
def _(t):
    return portfolio.chain_products(t.products)


@query("enriched_requests", "J21", "SELECT event_id, product_key FROM (SELECT event_id, CAST(event_id % 3000 + 1 AS INT) AS product_id FROM events) LEFT JOIN products USING (product_id) ORDER BY event_id")
def _(t):
    asked = t.raw("events").select("event_id", (F.pmod("event_id", F.lit(3000)) + 1).cast("int").alias("product_id"))
    return portfolio.lookup(asked, t.products.select("product_id", "product_key"), "product_id").select("event_id", "product_key").orderBy("event_id")


@query("enriched_requests_strict", "J21", "SELECT event_id, product_key FROM (SELECT event_id, CAST(event_id % 5 + 1 AS INT) AS product_id FROM events) JOIN products USING (product_id)")
def _(t):
    asked = t.raw("events").select("event_id", (F.pmod("event_id", F.lit(5)) + 1).cast("int").alias("product_id"))
    return portfolio.lookup(asked, t.products.select("product_id", "product_key"), "product_id", require=True).select("event_id", "product_key")


@query("events_of_products", "S5 O3", "SELECT l.block_number, l.product_id FROM ledger_diffs l WHERE product_id IN (2, 3, 5)")
def _(t):
    return readers.with_ids(t.ledger_diffs, "product_id", [2, 3, 5]).select("block_number", "product_id")


@query("events_of_live_products", "S5 J3", "SELECT l.block_number, l.product_id FROM ledger_diffs l WHERE product_id IN (SELECT product_id FROM products WHERE NOT is_eol AND NOT is_boost)")
def _(t):
    live = portfolio.live_products(t.products).filter(F.get_json_object("product_data", "$.vault").isNotNull()).select("product_id")
    return readers.with_ids(t.ledger_diffs, "product_id", live).select("block_number", "product_id")


# --- versioned definitions: each part is listed in most months; missing months mean it was dropped ---------------

MONTHS = 12
DEFINITION = "id: STRING, status: STRING, contract_address: STRING, earned_token_address: STRING, type: STRING, token: STRING, earned_token: STRING, version: INT"
_SQL_VERSIONS = """SELECT p.*, m AS month, TIMESTAMP '2023-01-01' + to_days(CAST(m * 30 AS INT)) AS version_date,
     CASE WHEN (p_partkey * 7 + m) % 13 = 5 OR (p_partkey % 10 = 3 AND m >= 8) THEN 'eol' ELSE 'active' END AS status
   FROM part p, (SELECT unnest(generate_series(0, 11)) AS m) WHERE (p_partkey + m) % 9 <> 0 AND NOT (p_partkey % 10 = 4 AND m >= 9) AND m >= p_partkey % 5"""


def version_content(t):
    """Definition rows: chain, month and the definition itself."""
    key, m = F.col("p_partkey"), F.col("month")
    listed = dealt(t.raw("part"), "p_partkey").withColumn("month", F.explode(F.sequence(F.lit(0), F.lit(MONTHS - 1))))
    kept = listed.filter((F.pmod(key + m, F.lit(9)) != 0) & ~((F.pmod(key, F.lit(10)) == 4) & (m >= 9)) & (m >= F.pmod(key, F.lit(5))))
    eol = (F.pmod(key * 7 + m, F.lit(13)) == 5) | ((F.pmod(key, F.lit(10)) == 3) & (m >= 8))
    return kept.select(
        _chain_of(key).alias("chain"),
        "month",
        F.timestamp_seconds(F.unix_seconds(F.lit("2023-01-01").cast("timestamp")) + m * F.lit(30 * 86400)).alias("version_date"),
        F.struct(
            F.concat(F.lower("p_type"), F.lit("-"), key.cast("string")).alias("id"),
            F.when(eol, "eol").otherwise("active").alias("status"),
            _address(key).alias("contract_address"),
            F.when(F.pmod(key, F.lit(50)) != 49, _address(key + 5)).alias("earned_token_address"),
            F.when(F.pmod(key, F.lit(17)) == 16, "cowcentrated").when(F.pmod(key, F.lit(17)) == 15, "gov").otherwise("standard").alias("type"),
            F.concat(F.lit("cow"), F.col("p_brand")).alias("token"),
            F.concat(F.lit("rCow"), F.col("p_brand")).alias("earned_token"),
            F.pmod(key, F.lit(3)).cast("int").alias("version"),
        ).alias("definition"),
    )


@query(
    "config_version_rows", "S3",
    f"SELECT month, status, count(*) AS n FROM ({_SQL_VERSIONS}) WHERE NOT ({_sql_chain('p_partkey')} = 'error' AND month = 6) GROUP BY 1, 2",
)
def _(t):
    # one JSON array per chain, month and hundred parts; those of one chain and month do not parse
    hundred = F.floor(F.substring_index("definition.id", "-", -1).cast("bigint") / 100)
    files = version_content(t).groupBy("chain", "month", "version_date", hundred.alias("slice")).agg(F.to_json(F.collect_list("definition")).alias("content"))
    broken = (F.col("chain") == "error") & (F.col("month") == 6)
    files = files.withColumn("content", F.when(broken, F.concat(F.lit("{"), F.col("content"))).otherwise(F.col("content")))
    path = scratch_path(t.spark, "versions")
    files.select(F.col("chain").alias("source"), "version_date", "content").write.json(path)
    parsed = readers.config_versions(t.spark, path, DEFINITION)
    month = (F.datediff("version_date", F.lit("2023-01-01")) / 30).cast("bigint").alias("month")
    return parsed.groupBy(month, "definition.status").agg(F.count("*").alias("n"))


_NEWEST = f"""WITH v AS ({_SQL_VERSIONS}), a AS (SELECT p_partkey, max(month) FILTER (WHERE status <> 'eol') AS live, min(month) AS first, max(month) AS last FROM v GROUP BY 1)
   SELECT p_partkey, CASE WHEN live IS NULL THEN first WHEN live < 11 THEN live + 1 END AS eol_month, last FROM a"""


@query(
    "newest_definitions", "D5",
    f"""SELECT {_sql_addr('p_partkey')} AS contract_address, eol_month IS NOT NULL AS eol, TIMESTAMP '2023-01-01' + to_days(CAST(eol_month * 30 AS INT)) AS eol_date,
        TIMESTAMP '2023-01-01' + to_days(CAST(last * 30 AS INT)) AS version_date FROM ({_NEWEST})""",
)
def _(t):
    rows = version_content(t).select("chain", "month", "version_date", "definition.*")
    reduced = dims.newest_definitions(
        rows.select("month", "version_date"), rows, ["contract_address"], ["month"], F.col("status") == "eol"
    )
    return reduced.select("contract_address", "eol", "eol_date", "version_date")


@query(
    "usable_definitions", "D6 P19",
    """SELECT p_partkey % 17 = 15 AS governance, count(*) AS n FROM part WHERE p_partkey % 50 <> 49 AND p_partkey % 17 <> 16 AND NOT (p_partkey % 17 = 15 AND p_partkey % 3 >= 2) GROUP BY 1""",
)
def _(t):
    one_each = keep_first(version_content(t).select("definition.*"), ["id"], ["status"])
    usable = dims.without_managed_liquidity(dims.usable_vaults(one_each))
    return usable.groupBy((F.col("type") == "gov").alias("governance")).agg(F.count("*").alias("n"))


def vaults(t):
    """Vault definitions as the dimension build wants them; one in six is bridged to two other networks."""
    key = F.col("p_partkey")
    oracle = F.concat(F.lower("p_type"), F.lit("-"), key.cast("string"))
    return t.raw("part").select(
        F.concat(oracle, F.when(F.pmod(key, F.lit(11)) == 10, "-eol").otherwise("")).alias("id"),
        _chain_of(key).alias("chain"),
        (F.pmod(key, F.lit(11)) == 10).alias("eol"),
        F.when(F.pmod(key, F.lit(22)) == 10, F.lit(datetime(2023, 6, 1))).alias("eol_date"),
        _address(key).alias("contract_address"),
        F.col("p_brand").alias("token_name"),
        F.lit(18).alias("token_decimals"),
        (F.pmod(key, F.lit(9)) == 8).alias("is_gov_vault"),
        F.col("p_name").alias("want_price_feed_key"),
        *[c.alias(n) for n, c in dims.protocol_columns(oracle, "tide").items()],
        F.when(
            F.pmod(key, F.lit(6)) == 0,
            F.create_map(F.lit("base"), _address(key + 2000000), F.lit("mode"), F.when(F.pmod(key, F.lit(12)) == 0, _address(key + 3000000))),
        ).alias("bridged"),
    )


_VAULT_ID = "lower(p_type) || '-' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 11 = 10 THEN '-eol' ELSE '' END"


@query(
    "bridged_products", "P19",
    f"""SELECT {_VAULT_ID} AS id, {_sql_chain('p_partkey')} AS chain, {_sql_addr('p_partkey')} AS contract_address, p_brand AS token_name, false AS is_bridged FROM part
        UNION ALL SELECT 'base-bridged-' || {_VAULT_ID}, 'base', {_sql_addr('(p_partkey + 2000000)')}, 'base ' || p_brand, true FROM part WHERE p_partkey % 6 = 0 AND p_partkey % 9 <> 8
        UNION ALL SELECT 'mode-bridged-' || {_VAULT_ID}, 'mode', {_sql_addr('(p_partkey + 3000000)')}, 'mode ' || p_brand, true FROM part WHERE p_partkey % 12 = 0 AND p_partkey % 9 <> 8""",
)
def _(t):
    return dims.expand_bridged(vaults(t)).select("id", "chain", "contract_address", "token_name", "is_bridged")


_PLAIN_ID = "lower(p_type) || '-' || CAST(p_partkey AS VARCHAR)"


@query(
    "dimension_feeds", "D7 P16",
    f"""SELECT DISTINCT feed_key, from_asset_key, to_asset_key, active, external_id FROM (
        SELECT 'tide:' || c || ':' || i || ':ppfs' AS feed_key, 'tide:' || c || ':' || i AS from_asset_key, lower(p_type) || ':' || c || ':' || CAST(p_partkey AS VARCHAR) AS to_asset_key, p_partkey % 11 <> 10 AS active, i AS external_id
        FROM (SELECT *, {_sql_chain('p_partkey')} AS c, {_PLAIN_ID} AS i FROM part)
        UNION ALL SELECT 'tide-data:' || lower(p_type) || ':' || c || ':' || CAST(p_partkey AS VARCHAR), lower(p_type) || ':' || c || ':' || CAST(p_partkey AS VARCHAR), 'fiat:USD', p_partkey % 22 <> 10, p_name
        FROM (SELECT *, {_sql_chain('p_partkey')} AS c FROM part)
        UNION ALL SELECT DISTINCT 'tide-data:' || c || ':W' || upper(c), c || ':W' || upper(c), 'fiat:USD', true, 'W' || upper(c) FROM (SELECT {_sql_chain('p_partkey')} AS c FROM part WHERE p_partkey % 9 = 8))""",
)
def _(t):
    all_vaults = dims.expand_bridged(vaults(t))
    native = F.concat(F.lit("W"), F.upper("chain"))
    rewards = dims.reward_feeds(all_vaults.filter("is_gov_vault"), native, "tide", AS_OF)
    feeds = dims.share_feeds(all_vaults, "tide").unionByName(dims.usd_feeds(all_vaults, "tide", AS_OF)).unionByName(rewards)
    active = F.get_json_object("price_feed_data", "$.active") == "true"
    one_each = feeds.groupBy("feed_key", "from_asset_key", "to_asset_key").agg(
        F.max(active).alias("active"), F.min(F.get_json_object("price_feed_data", "$.externalId")).alias("external_id")
    )
    return one_each


@query("product_keys", "D7 P10", f"SELECT 'tide:vault:' || {_sql_chain('p_partkey')} || ':' || {_sql_addr('p_partkey')} AS product_key FROM part")
def _(t):
    shouting = F.concat(F.lit("0x"), F.upper(F.substring("contract_address", 3, 40)))
    return vaults(t).select(dims.product_key("tide", "vault", F.col("chain"), shouting).alias("product_key"))


@query(
    "boosts_with_vault_feeds", "D7b",
    f"""SELECT s.s_suppkey, p.price_feed_1_id, p.price_feed_2_id FROM supplier s JOIN products p ON p.product_id = s.s_suppkey + 1""",
)
def _(t):
    key = F.col("s_suppkey")
    boosts = t.raw("supplier").join(t.raw("part"), F.col("p_partkey") == key).select(
        "s_suppkey", _chain_of(key).alias("chain"), F.concat(F.lower("p_type"), F.lit("-"), key.cast("string"), F.lit("-pause")).alias("vault_id")
    )
    data = jf.display_id(F.col("product_data"))
    known = t.products.select("chain", F.concat(data, F.lit("-eol")).alias("id"), "price_feed_1_id", "price_feed_2_id")
    return dims.attach_boosts(boosts, known).select("s_suppkey", "price_feed_1_id", "price_feed_2_id")


@query(
    "ignore_list", "D8 D18 S8",
    f"""SELECT chain, address FROM (
        SELECT chain, contract_address AS address FROM products UNION SELECT DISTINCT chain, '0x' || repeat('0', 40) FROM products
        UNION SELECT {_sql_chain('s_suppkey')}, {_sql_addr('(s_suppkey + 7000000)')} FROM supplier WHERE s_suppkey % 5 <> 4
        UNION SELECT chain, address FROM (VALUES {', '.join(f"('{a}', '{c}')" for a, c in dims.MANUAL_IGNORED)}) m(address, chain))""",
)
def _(t):
    key = F.col("s_suppkey")
    zaps = t.raw("supplier").select(_chain_of(key).alias("chain"), F.when(F.pmod(key, F.lit(5)) != 4, _address(key + 7000000)).otherwise(F.lit("0xnone")).alias("address"))
    products = t.products.select("chain", jf.contract_address(F.col("product_data")).alias("contract_address"))
    listed = dims.ignored_addresses(products, zaps, t.products.select("chain").distinct())
    return listed.select("chain", to_hex_text(F.col("address")).alias("address"))


@query(
    "surrogate_ids", "S12",
    """WITH stored AS (SELECT CAST(c_custkey AS INT) AS investor_id, c_name FROM customer WHERE c_mktsegment <> 'BUILDING'),
       fresh AS (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT c_name FROM stored))
       SELECT CAST((SELECT max(investor_id) FROM stored) + row_number() OVER (ORDER BY md5(c_name)) AS INT) AS investor_id, c_name FROM fresh""",
)
def _(t):
    customers = t.raw("customer").select(F.col("c_custkey").cast("int").alias("investor_id"), "c_name", "c_mktsegment")
    stored = customers.filter(F.col("c_mktsegment") != "BUILDING").select("investor_id", "c_name")
    return up.assign_ids(stored, customers.select("c_name"), "c_name", "investor_id")


@query(
    "merged_json_settings", "J7 S11",
    """SELECT c_custkey, c_mktsegment AS segment, CAST(c_custkey AS VARCHAR) AS kept, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS nested_value,
       'x' AS nested_kept, CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 2 END AS list_length FROM customer""",
)
def _(t):
    old = F.to_json(F.struct(
        F.lit("?").alias("segment"), F.col("c_custkey").alias("kept"),
        F.struct(F.lit("old").alias("value"), F.lit("x").alias("only_old")).alias("nested"), F.array(F.lit(1), F.lit(2)).alias("list"),
    ))
    new = F.when(
        F.pmod("c_custkey", F.lit(2)) == 0,
        F.to_json(F.struct(F.col("c_mktsegment").alias("segment"), F.struct(F.lit("new").alias("value")).alias("nested"), F.array(F.lit(3)).alias("list"))),
    ).otherwise(F.to_json(F.struct(F.col("c_mktsegment").alias("segment"))))
    merged = merge_column(t.raw("customer").select("c_custkey", old.alias("old"), new.alias("new")), ["c_custkey"], "old", "new", "m")
    get = lambda path: F.get_json_object("m", path)
    return merged.select(
        "c_custkey", get("$.segment").alias("segment"), get("$.kept").alias("kept"), get("$.nested.value").alias("nested_value"),
        get("$.nested.only_old").alias("nested_kept"), F.json_array_length(get("$.list")).alias("list_length"),
    )


def deep_json(levels, fields, item):
    """JSON text of an object, so many levels down, and a list of one item beside the way at every tenth level."""
    step = '"in":{'
    tens = F.repeat(F.lit(f'{step * 9}"list":[{item}],{step}'), F.floor(levels / 10).cast("int"))
    return F.concat(F.lit("{"), tens, F.repeat(F.lit(step), F.pmod(levels, F.lit(10)).cast("int")), fields, F.repeat(F.lit("}"), (levels + 1).cast("int")))


@query(
    "merged_json_deep", "J7 S11",
    """SELECT event_id, 20 + event_id % 21 AS levels, CAST(event_id AS VARCHAR) AS kept, event_type AS added, CASE WHEN event_id % 3 = 0 THEN 'new' ELSE 'old' END AS changed, '[1,2]' AS list FROM events""",
)
def _(t):
    # one JSON text per event, 20 to 40 levels deep, and what a batch brings for it
    levels = F.col("levels")
    field = lambda name, value: F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))
    old = F.concat_ws(",", field("kept", F.col("event_id").cast("string")), field("changed", F.lit("old")))
    added = field("added", F.col("event_type"))
    new = F.when(F.pmod("event_id", F.lit(3)) == 0, F.concat_ws(",", added, field("changed", F.lit("new")))).otherwise(added)
    events = dealt(t.raw("events").select("event_id", "event_type"), "event_id")  # the texts are made by many tasks
    events = events.withColumn("levels", F.pmod("event_id", F.lit(21)) + 20)
    rows = events.select("event_id", "levels", deep_json(levels, old, 1).alias("old"), deep_json(levels, new, 2).alias("new"))
    merged = merge_column(rows, ["event_id"], "old", "new", "m")
    # the innermost object stands between the last opening and the first closing brace
    inner = F.from_json(F.concat(F.lit("{"), F.regexp_extract("m", r"\{([^{}]*)\}", 1), F.lit("}")), "kept string, added string, changed string")
    lists = F.get_json_object("m", "$" + ".in" * 9 + ".list")
    return merged.select("event_id", "levels", inner["kept"].alias("kept"), inner["added"].alias("added"), inner["changed"].alias("changed"), lists.alias("list"))


@query(
    "merged_json_leaves", "J7 S11",
    """SELECT event_id, n AS depth, CASE WHEN n = 20 + event_id % 21 + 1 THEN 3 ELSE 1 END AS leaves FROM events, (SELECT unnest(range(1, 42)) AS n)
       WHERE n = 20 + event_id % 21 + 1 OR n % 10 = 0 AND n <= 20 + event_id % 21""",
)
def _(t):
    # the path table itself: where the leaves of the merge stand
    levels = F.col("levels")
    events = dealt(t.raw("events").select("event_id"), "event_id").withColumn("levels", F.pmod("event_id", F.lit(21)) + 20)
    old, new = deep_json(levels, F.lit('"a":1,"b":{"x":2}'), 1), deep_json(levels, F.lit('"b":{"x":2},"c":null'), 2)
    rows = events.select("event_id", old.alias("old"), new.alias("new"))
    found = leaves(rows, ["event_id"], "old", "new")
    return found.groupBy("event_id", F.size("_path").cast("bigint").alias("depth")).agg(F.count("*").alias("leaves"))


@query("sampling_periods", "F11", "SELECT event_id, ts + to_milliseconds(1296000000) AS after_half_month FROM events")
def _(t):
    half_month = F.lit(SAMPLING_MS["1month"] // 2 * 1000)
    return t.raw("events").select("event_id", F.timestamp_micros(F.unix_micros("ts") + half_month).alias("after_half_month"))


@query("json_field_functions", "F5 F12", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, 2 AS items, '{"k":' || json_extract_string(props, '$.k') || '}' AS rebuilt FROM events""")
def _(t):
    k = F.get_json_object("props", "$.k").cast("int")
    listed = F.to_json(F.array(k, k + 1))
    return t.raw("events").select("event_id", k.alias("k"), F.json_array_length(listed).alias("items"), F.to_json(F.struct(k.alias("k"))).alias("rebuilt"))
