"""Engine tables derived from the given tables (see FIXTURES.md), and the same derivations as SQL.

Every table grows with the given data. ``Tables`` builds them lazily; ``SQL_TABLES`` is the CTE text the checking
SQL starts with.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hexbytes import from_hex_text
from tidemark.functions.timegrid import cell
from tidemark.operators.ohlc import rollup
from tidemark.operators.scan import running_balance
from tidemark.plans.coverage import COVERED, RETRY
from tidemark.plans.tvl import daily_tvl
from tidemark.plans.valuation import build_timeline
from tidemark.schema import AMOUNT
from tidemark.session import configure

# read timestamps as instants (session time zone UTC), so that filters on them are pushed to the files
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PRODUCTS = 8
START = "2024-01-01"


def _type_index(column: str = "event_type"):
    return F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), F.col(column)).cast("int")


def _chain_of(key):
    return F.element_at(F.array(*[F.lit(t) for t in EVENT_TYPES]), (F.pmod(key, F.lit(5)) + 1).cast("int"))


def _address(key):
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(key)), 40, "0"))


class Tables:
    """The engine's tables over one directory of given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def ledger_diffs(self) -> DataFrame:
        """Balance changes: purchases, signups and views add, clicks and errors take away."""
        amount = F.col("value").cast(AMOUNT)
        return self.raw("events").select(
            F.col("ts").alias("datetime"),
            F.col("event_id").alias("block_number"),
            (F.pmod("event_id", F.lit(PRODUCTS)) + 1).cast("int").alias("product_id"),
            F.col("user_id").cast("int").alias("investor_id"),
            F.unhex(F.md5(F.col("event_id").cast("string"))).alias("transaction_hash"),
            F.when(F.col("event_type").isin("click", "error"), -amount).otherwise(amount).alias("balance_diff"),
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """investment_balance_ts: the diffs with the balance after each."""
        return running_balance(
            self.ledger_diffs, ["product_id", "investor_id"], ["datetime", "block_number"], "balance_diff", cell(F.col("datetime"), 1)
        )

    @cached_property
    def price_ts(self) -> DataFrame:
        return self.raw("events").select(
            F.col("ts").alias("datetime"),
            _type_index().alias("price_feed_id"),
            F.col("event_id").alias("block_number"),
            F.col("value").cast(AMOUNT).alias("price"),
        )

    @cached_property
    def share_rates(self) -> DataFrame:
        """Share-rate ticks: one for each ledger row, in the first feed of its product."""
        return self.raw("events").select(
            F.col("ts").alias("datetime"),
            (F.pmod(F.pmod("event_id", F.lit(PRODUCTS)), F.lit(5)) + 1).cast("int").alias("price_feed_id"),
            F.col("event_id").alias("block_number"),
            (F.lit(1.0) + F.pmod("event_id", F.lit(10)) / F.lit(100.0)).cast(AMOUNT).alias("price"),
        )

    @cached_property
    def price_1h(self) -> DataFrame:
        return rollup(self.price_ts, "1hour")

    @cached_property
    def price_1d(self) -> DataFrame:
        return rollup(self.price_ts, "1day")

    @cached_property
    def timeline(self) -> DataFrame:
        """investor_timeline_ts: the ledger valued by share rate and USD price."""
        return build_timeline(self.ledger, self.products, self.share_rates, self.price_ts)

    @cached_property
    def tvl(self) -> DataFrame:
        return daily_tvl(self.vault_stats, self.products, self.price_1d)

    @cached_property
    def midnight_ticks(self) -> DataFrame:
        """A second price source whose ticks are stamped midnight."""
        day = F.pmod(F.datediff("o_orderdate", F.lit("1995-01-01")), F.lit(30)).cast("int")
        return self.raw("orders").select(
            F.date_add(F.lit(START), day).cast("timestamp").alias("datetime"),
            (F.pmod("o_custkey", F.lit(5)) + 1).cast("int").alias("price_feed_id"),
            F.col("o_orderkey").alias("block_number"),
            (F.col("o_totalprice") / 1000).cast(AMOUNT).alias("price"),
        )

    @cached_property
    def blocks(self) -> DataFrame:
        return self.raw("events").select(
            F.col("ts").alias("datetime"), F.col("event_type").alias("chain"), F.col("event_id").alias("block_number")
        )

    @cached_property
    def products(self) -> DataFrame:
        """One product per part: one in seven is a boost, one in 13 of the rest a governance vault, one in eleven retired, one in 97 lacks its first feed."""
        key = F.col("p_partkey")
        ident = F.concat(F.lower(F.col("p_type")), F.lit("-"), key.cast("string"))
        eol = F.pmod(key, F.lit(11)) == 10
        fields = F.struct(
            ident.alias("id"),
            eol.alias("eol"),
            _address(key).alias("contract_address"),
            _address(key + 1000000).alias("want_address"),
            F.col("p_brand").alias("platform_id"),
            (F.pmod(key, F.lit(3)) == 0).alias("earning_eigenlayer_points"),
            F.lit(18).alias("token_decimals"),
            F.lit(6).alias("want_decimals"),
            (F.pmod(key, F.lit(4)) + 6).alias("staked_token_decimals"),
        )
        boost = F.pmod(key, F.lit(7)) == 6
        data = F.to_json(
            F.struct(
                F.when(boost, "boost").when(F.pmod(key, F.lit(13)) == 12, "gov-vault").otherwise("vault").alias("type"),
                eol.alias("dashboardEol"),
                F.when(~boost, fields).alias("vault"),
                F.when(boost, fields).alias("boost"),
            )
        )
        return self.raw("part").select(
            (key + 1).cast("int").alias("product_id"),
            F.concat_ws(":", F.when(boost, "boost").otherwise("vault"), _chain_of(key), _address(key)).alias("product_key"),
            _chain_of(key).alias("chain"),
            F.when(F.pmod(key, F.lit(97)) != 96, F.pmod(key, F.lit(5)) + 1).cast("int").alias("price_feed_1_id"),
            (F.pmod(key + 1, F.lit(5)) + 1).cast("int").alias("price_feed_2_id"),
            F.when(boost, F.pmod(key, F.lit(5)) + 1).cast("int").alias("pending_rewards_price_feed_id"),
            data.alias("product_data"),
        )

    @cached_property
    def feeds(self) -> DataFrame:
        """One price feed per part; odd ones are USD feeds."""
        key = F.col("p_partkey")
        usd = F.pmod(key, F.lit(2)) == 1
        asset = F.concat_ws(":", F.lower("p_type"), _chain_of(key), key.cast("string"))
        # one USD feed in three is written with a capital letter
        shown = F.when(F.pmod(key, F.lit(3)) == 0, F.initcap(asset)).otherwise(asset)
        return self.raw("part").select(
            (key + 1).cast("int").alias("price_feed_id"),
            F.when(usd, F.concat(F.lit("tide-data:"), shown)).otherwise(F.concat(F.lit("tide:"), asset, F.lit(":ppfs"))).alias("feed_key"),
            asset.alias("from_asset_key"),
            F.when(usd, F.lit("fiat:USD")).otherwise(F.concat(F.lit("token:"), asset)).alias("to_asset_key"),
            F.to_json(F.struct(F.lit(True).alias("active"), F.col("p_name").alias("externalId"))).alias("price_feed_data"),
        )

    @cached_property
    def investors(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").cast("int").alias("investor_id"),
            from_hex_text(_address(F.col("c_custkey"))).alias("address"),
            F.to_json(F.struct(F.col("c_mktsegment").alias("segment"))).alias("investor_data"),
        )

    @cached_property
    def vault_stats(self) -> DataFrame:
        day = F.pmod(F.datediff("l_shipdate", F.lit("1995-01-01")), F.lit(30)).cast("long")
        at = F.unix_micros(F.lit(START).cast("timestamp")) + (day * 24 + F.col("l_linenumber")) * F.lit(3_600_000_000)
        staked, rate = F.col("l_quantity").cast(AMOUNT), (F.col("l_tax") + 1)
        total = F.col("l_quantity") + F.col("l_discount") * 100
        return self.raw("lineitem").select(
            (F.col("l_partkey") + 1).cast("int").alias("product_id"),
            F.timestamp_micros(at).alias("datetime"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("block_number"),
            (F.col("l_quantity") / rate).cast(AMOUNT).alias("vault_total_supply"),
            rate.cast(AMOUNT).alias("share_to_underlying_price"),
            staked.alias("staked_underlying"),
            total.cast(AMOUNT).alias("underlying_total_supply"),
            (F.col("l_quantity") / total).alias("underlying_capture_percentage"),
        )

    @cached_property
    def errors(self) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == "error").select(
            F.concat(F.lit("net"), F.pmod("user_id", F.lit(10)).cast("string")).alias("chain"),
            F.col("ts").alias("datetime"),
            F.concat(F.lit("https://node"), F.pmod("user_id", F.lit(3)).cast("string"), F.lit("/rpc")).alias("rpc_url"),
            F.col("props").alias("request"),
            F.lit('{"error": true}').alias("response"),
        )

    @cached_property
    def coverage(self) -> DataFrame:
        """Coverage ranges: each order covers up to 40 days after its date; pending ones wait for a retry."""
        start = F.datediff("o_orderdate", F.lit("1970-01-01")).cast("long")
        return self.raw("orders").select(
            F.concat(F.lit("product:investment:"), (F.col("o_custkey") + 1).cast("string")).alias("import_key"),
            F.when(F.col("o_orderstatus") == "P", RETRY).otherwise(COVERED).alias("kind"),
            start.alias("from"),
            (start + F.pmod("o_orderkey", F.lit(40))).alias("to"),
        )

    @cached_property
    def states(self) -> DataFrame:
        """Import states of the products that have a customer of the same number; blocks are epoch days."""
        key = F.col("c_custkey")
        return self.raw("customer").select(
            F.concat(F.lit("product:investment:"), (key + 1).cast("string")).alias("import_key"),
            F.lit("product:investment").alias("type"),
            _chain_of(key).alias("chain"),
            (key + 1).cast("int").alias("product_id"),
            (F.lit(9000) + F.pmod(key, F.lit(500))).cast("long").alias("contract_created_at_block"),
            F.timestamp_seconds(F.unix_seconds(F.lit(START).cast("timestamp")) - F.pmod(key, F.lit(500)) * 86400).alias("contract_creation_date"),
            (F.lit(11000) + F.pmod(key, F.lit(800))).cast("long").alias("chain_latest_block_number"),
            F.timestamp_seconds(F.unix_seconds(F.lit(START).cast("timestamp")) + key * 60).alias("last_import_date"),
        )

    @cached_property
    def trades(self) -> DataFrame:
        """Second ledger with day-granular dates: signed shares and their price."""
        lines = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        shares = F.col("l_quantity").cast(AMOUNT)
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").cast("int").alias("investor_id"),
            F.pmod("l_partkey", F.lit(4)).cast("int").alias("product_id"),
            F.col("o_orderdate").alias("datetime"),
            F.col("o_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("part"),
            F.col("l_extendedprice").alias("amount"),
            F.when(F.col("l_returnflag") == "R", -shares).otherwise(shares).alias("shares"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        )

    TRADE_KEYS = ["investor_id", "product_id"]
    TRADE_ORDER = ["datetime", "order_id", "line", "part", "amount", "shares"]

    @cached_property
    def legs(self) -> DataFrame:
        """Paired transfer legs; blocks hold eight events, so an owner may have several legs in one."""
        amount = F.col("value").cast(AMOUNT)
        leg = lambda owner, a: F.struct(_address(owner).alias("owner_address"), a.alias("amount_transferred"))
        receiver = F.pmod(F.col("user_id") * 7 + F.col("event_id"), F.lit(20))
        sender = F.pmod("user_id", F.lit(20))
        return (
            self.raw("events")
            .withColumn("_leg", F.explode(F.array(leg(sender, -amount), leg(receiver, amount))))
            .select(
                F.col("event_type").alias("chain"),
                _address(F.pmod("event_id", F.lit(2))).alias("token_address"),
                F.col("_leg.owner_address").alias("owner_address"),
                F.floor(F.col("event_id") / 8).cast("bigint").alias("block_number"),
                F.md5(F.col("event_id").cast("string")).alias("transaction_hash"),
                F.col("event_id").alias("log_index"),
                F.col("_leg.amount_transferred").alias("amount_transferred"),
            )
        )

    @cached_property
    def ignored(self) -> DataFrame:
        """Owners numbered as the nations of two regions are ignored on every chain."""
        return self.raw("nation").filter(F.col("n_regionkey").isin(0, 2)).select(
            F.explode(F.array(*[F.lit(t) for t in EVENT_TYPES])).alias("chain"),
            from_hex_text(_address(F.col("n_nationkey").cast("long"))).alias("address"),
        )


_CHAIN = "(['click','error','purchase','signup','view'])[CAST({k} % 5 AS INT) + 1]"
_ADDR = "('0x' || lpad(lower(to_hex({k})), 40, '0'))"


def _sql_chain(k: str) -> str:
    return _CHAIN.format(k=k)


def _sql_addr(k: str) -> str:
    return _ADDR.format(k=k)


SQL_TABLES = {
    "ledger_diffs": """
        SELECT ts AS datetime, event_id AS block_number, CAST(event_id % 8 + 1 AS INT) AS product_id,
               CAST(user_id AS INT) AS investor_id, '0x' || md5(CAST(event_id AS VARCHAR)) AS transaction_hash,
               CASE WHEN event_type IN ('click','error') THEN -CAST(value AS DECIMAL(38,18)) ELSE CAST(value AS DECIMAL(38,18)) END AS balance_diff
        FROM events""",
    "ledger": """
        SELECT *, sum(balance_diff) OVER (PARTITION BY product_id, investor_id ORDER BY datetime, block_number ROWS UNBOUNDED PRECEDING) AS balance
        FROM ledger_diffs""",
    "price_ts": """
        SELECT ts AS datetime, CAST(list_position(['click','error','purchase','signup','view'], event_type) AS INT) AS price_feed_id,
               event_id AS block_number, CAST(value AS DECIMAL(38,18)) AS price FROM events""",
    "midnight_ticks": """
        SELECT TIMESTAMP '2024-01-01' + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS INT)) AS datetime,
               CAST(o_custkey % 5 + 1 AS INT) AS price_feed_id, o_orderkey AS block_number, o_totalprice / 1000 AS price FROM orders""",
    "blocks": "SELECT ts AS datetime, event_type AS chain, event_id AS block_number FROM events",
    "products": f"""
        SELECT CAST(p_partkey + 1 AS INT) AS product_id,
               CASE WHEN p_partkey % 7 = 6 THEN 'boost' ELSE 'vault' END || ':' || {_sql_chain('p_partkey')} || ':' || {_sql_addr('p_partkey')} AS product_key,
               {_sql_chain('p_partkey')} AS chain,
               CASE WHEN p_partkey % 97 <> 96 THEN CAST(p_partkey % 5 + 1 AS INT) END AS price_feed_1_id,
               CAST((p_partkey + 1) % 5 + 1 AS INT) AS price_feed_2_id,
               CASE WHEN p_partkey % 7 = 6 THEN CAST(p_partkey % 5 + 1 AS INT) END AS pending_rewards_price_feed_id,
               p_partkey % 7 = 6 AS is_boost, p_partkey % 11 = 10 AS is_eol,
               lower(p_type) || '-' || CAST(p_partkey AS VARCHAR) AS display_id,
               {_sql_addr('p_partkey')} AS contract_address, {_sql_addr('(p_partkey + 1000000)')} AS want_address,
               p_brand AS platform_id, p_partkey % 3 = 0 AS earns_points, p_partkey % 7 <> 6 AND p_partkey % 13 = 12 AS is_gov
        FROM part""",
    "feeds": f"""
        SELECT CAST(p_partkey + 1 AS INT) AS price_feed_id,
               CASE WHEN p_partkey % 2 = 1 THEN 'tide-data:' || CASE WHEN p_partkey % 3 = 0 THEN upper(left(asset, 1)) || substr(asset, 2) ELSE asset END
                    ELSE 'tide:' || asset || ':ppfs' END AS feed_key,
               asset AS from_asset_key, CASE WHEN p_partkey % 2 = 1 THEN 'fiat:USD' ELSE 'token:' || asset END AS to_asset_key,
               p_name AS external_id
        FROM (SELECT *, lower(p_type) || ':' || {_sql_chain('p_partkey')} || ':' || CAST(p_partkey AS VARCHAR) AS asset FROM part)""",
    "investors": f"SELECT CAST(c_custkey AS INT) AS investor_id, {_sql_addr('c_custkey')} AS address, c_mktsegment AS segment FROM customer",
    "vault_stats": """
        SELECT CAST(l_partkey + 1 AS INT) AS product_id,
               TIMESTAMP '2024-01-01' + to_hours(CAST((date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 30) * 24 + l_linenumber AS INT)) AS datetime,
               l_orderkey * 8 + l_linenumber AS block_number, l_quantity / (l_tax + 1) AS vault_total_supply,
               l_tax + 1 AS share_to_underlying_price, l_quantity AS staked_underlying,
               l_quantity + l_discount * 100 AS underlying_total_supply,
               l_quantity / (l_quantity + l_discount * 100) AS underlying_capture_percentage
        FROM lineitem""",
    "errors": """
        SELECT 'net' || CAST(user_id % 10 AS VARCHAR) AS chain, ts AS datetime,
               'https://node' || CAST(user_id % 3 AS VARCHAR) || '/rpc' AS rpc_url, props AS request
        FROM events WHERE event_type = 'error'""",
    "coverage": """
        SELECT 'product:investment:' || CAST(o_custkey + 1 AS VARCHAR) AS import_key,
               CASE WHEN o_orderstatus = 'P' THEN 'retry' ELSE 'covered' END AS kind,
               date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS "from",
               date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + o_orderkey % 40 AS "to"
        FROM orders""",
    "states": f"""
        SELECT 'product:investment:' || CAST(c_custkey + 1 AS VARCHAR) AS import_key, 'product:investment' AS type,
               {_sql_chain('c_custkey')} AS chain, CAST(c_custkey + 1 AS INT) AS product_id,
               9000 + c_custkey % 500 AS contract_created_at_block,
               TIMESTAMP '2024-01-01' - to_days(CAST(c_custkey % 500 AS INT)) AS contract_creation_date,
               11000 + c_custkey % 800 AS chain_latest_block_number,
               TIMESTAMP '2024-01-01' + to_minutes(c_custkey) AS last_import_date
        FROM customer""",
    "trades": """
        SELECT CAST(o_custkey AS INT) AS investor_id, CAST(l_partkey % 4 AS INT) AS product_id, o_orderdate AS datetime,
               o_orderkey AS order_id, l_linenumber AS line, l_partkey AS part, l_extendedprice AS amount,
               CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS shares, l_extendedprice / l_quantity AS price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "legs": f"""
        SELECT event_type AS chain, {_sql_addr('(event_id % 2)')} AS token_address,
               unnest([{_sql_addr('(user_id % 20)')}, {_sql_addr('((user_id * 7 + event_id) % 20)')}]) AS owner_address,
               event_id // 8 AS block_number, md5(CAST(event_id AS VARCHAR)) AS transaction_hash, event_id AS log_index,
               unnest([-CAST(value AS DECIMAL(38,18)), CAST(value AS DECIMAL(38,18))]) AS amount_transferred
        FROM events""",
    "ignored": f"""
        SELECT unnest(['click','error','purchase','signup','view']) AS chain, {_sql_addr('CAST(n_nationkey AS BIGINT)')} AS address
        FROM nation WHERE n_regionkey IN (0, 2)""",
    "price_1h": """
        SELECT price_feed_id, time_bucket(INTERVAL '1 hour', datetime) AS datetime, avg(CAST(price AS DOUBLE)) AS price_avg,
               max(price) AS price_high, min(price) AS price_low, first(price ORDER BY datetime, block_number) AS price_open,
               last(price ORDER BY datetime, block_number) AS price_close FROM price_ts GROUP BY 1, 2""",
    "price_1d": """
        SELECT price_feed_id, time_bucket(INTERVAL '1 day', datetime) AS datetime, avg(CAST(price AS DOUBLE)) AS price_avg,
               max(price) AS price_high, min(price) AS price_low, first(price ORDER BY datetime, block_number) AS price_open,
               last(price ORDER BY datetime, block_number) AS price_close FROM price_ts GROUP BY 1, 2""",
    "price_15m": """
        SELECT price_feed_id, time_bucket(INTERVAL '15 minutes', datetime) AS bucket, last(price ORDER BY datetime, block_number) AS price,
               last(block_number ORDER BY datetime, block_number) AS block_number, max(datetime) AS datetime
        FROM price_ts GROUP BY 1, 2""",
    "timeline": """
        SELECT l.investor_id, l.product_id, l.datetime, l.block_number, l.transaction_hash, CAST(l.balance AS DOUBLE) AS balance,
               CAST(l.balance_diff AS DOUBLE) AS balance_diff, 1.0 + l.block_number % 10 / 100.0::DOUBLE AS share_to_underlying_price,
               CAST(l.balance AS DOUBLE) * (1.0 + l.block_number % 10 / 100.0::DOUBLE) AS underlying_balance,
               CAST(l.balance_diff AS DOUBLE) * (1.0 + l.block_number % 10 / 100.0::DOUBLE) AS underlying_diff,
               CAST(q.price AS DOUBLE) AS underlying_to_usd_price,
               CAST(l.balance AS DOUBLE) * (1.0 + l.block_number % 10 / 100.0::DOUBLE) * CAST(q.price AS DOUBLE) AS usd_balance,
               CAST(l.balance_diff AS DOUBLE) * (1.0 + l.block_number % 10 / 100.0::DOUBLE) * CAST(q.price AS DOUBLE) AS usd_diff,
               p.price_feed_2_id
        FROM ledger l JOIN products p ON p.product_id = l.product_id
        LEFT JOIN price_15m q ON q.price_feed_id = p.price_feed_2_id AND q.bucket = time_bucket(INTERVAL '15 minutes', l.datetime)""",
    "tvl": """
        SELECT s.datetime, s.product_id, p.chain, p.product_key, p.display_id AS vault_id, s.max_staked * q.price_avg AS tvl
        FROM (SELECT product_id, time_bucket(INTERVAL '1 day', datetime) AS datetime, max(staked_underlying) AS max_staked FROM vault_stats GROUP BY 1, 2) s
        JOIN products p ON p.product_id = s.product_id
        JOIN price_1d q ON q.price_feed_id = p.price_feed_2_id AND q.datetime = s.datetime""",
}


def sql_prefix() -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in SQL_TABLES.items())
