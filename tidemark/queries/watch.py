"""Value locked, growth, capture, counts, orphans, duplicates and outliers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.timegrid import time_bucket
from tidemark.operators import ohlc
from tidemark.plans import monitoring as mon
from tidemark.plans import portfolio, tvl
from tidemark.queries.registry import query
from tidemark.sources import bucketed

AS_OF = datetime(2024, 2, 1)


@query("tvl_daily", "A18 J15 Q10", "SELECT * FROM tvl", "tvl")
def _(t):
    return t.tvl


def bucketed_tvl(t, buckets=8):
    """Daily value locked from two tables laid out by feed and day."""
    keys = ["price_feed_2_id", "datetime"]
    staked = t.vault_stats.groupBy("product_id", time_bucket("1day", F.col("datetime")).alias("datetime")).agg(F.max("staked_underlying").alias("max_staked"))
    staked = staked.join(t.products.select("product_id", "price_feed_2_id", "chain"), "product_id")
    prices = t.price_1d.select(F.col("price_feed_id").alias("price_feed_2_id"), "datetime", "price_avg")
    left, right = bucketed.write(staked, "staked", keys, buckets), bucketed.write(prices, "daily_prices", keys, buckets)
    joined = left.join(right.hint("merge"), keys)
    return joined.select(*keys, "product_id", "chain", (F.col("max_staked").cast("double") * F.col("price_avg")).alias("tvl"))


@query("tvl_daily_bucketed", "A18 J15", "SELECT datetime, product_id, chain, tvl FROM tvl", "tvl")
def _(t):
    return bucketed_tvl(t).select("datetime", "product_id", "chain", "tvl")


@query("tvl_per_feed_bucketed", "A18 J15", "SELECT p.price_feed_2_id, datetime, sum(tvl) AS tvl FROM tvl JOIN products p USING (product_id) GROUP BY 1, 2", "tvl")
def _(t):
    return bucketed_tvl(t).groupBy("price_feed_2_id", "datetime").agg(F.sum("tvl").alias("tvl"))


@query("tvl_per_chain", "A18", "SELECT datetime, chain, sum(tvl) AS tvl FROM tvl GROUP BY 1, 2", "tvl")
def _(t):
    return tvl.chain_tvl(t.tvl)


@query(
    "tvl_one_week", "Q10 S4",
    "SELECT * FROM tvl WHERE datetime BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-16'",
    "tvl",
)
def _(t):
    lo, hi = datetime(2024, 1, 10), datetime(2024, 1, 16, 23, 59, 59)
    return tvl.daily_tvl(t.vault_stats, t.products, ohlc.rollup_between(t.price_ts, "1day", lo, hi), F.lit(lo), F.lit(hi))


@query("tvl_of_one_product", "Q10", "SELECT datetime, tvl FROM tvl WHERE product_id = 1 AND datetime BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-16'", "tvl")
def _(t):
    # the report of one vault over a week at most
    lo, hi = datetime(2024, 1, 10), datetime(2024, 1, 16, 23, 59, 59)
    return tvl.tvl_of_product(t.vault_stats, t.products, ohlc.rollup_between(t.price_ts, "1day", lo, hi), 1, lo, hi)


_GROWTH = """SELECT product_id, product_key, chain, vault_id, min(datetime) AS compare_to_datetime, max(datetime) AS recent_datetime, arg_min(tvl, datetime) AS compare_to_tvl, arg_max(tvl, datetime) AS recent_tvl,
   arg_max(tvl, datetime) - arg_min(tvl, datetime) AS diff_tvl FROM {source} GROUP BY 1, 2, 3, 4"""
_LIVE = "(SELECT t.* FROM tvl t JOIN products p USING (product_id) WHERE NOT p.is_eol)"


@query("tvl_growth", "A19", _GROWTH.format(source="tvl"), "compare_to_tvl recent_tvl diff_tvl")
def _(t):
    return tvl.growth(t.tvl).orderBy(F.col("diff_tvl").desc())


@query("tvl_growth_live", "Q19 P2 P4", _GROWTH.format(source=_LIVE), "compare_to_tvl recent_tvl diff_tvl")
def _(t):
    live = portfolio.not_retired(t.products)
    return tvl.growth(tvl.daily_tvl(t.vault_stats, live, t.price_1d)).orderBy(F.col("diff_tvl").desc())


@query(
    "tvl_growth_per_chain", "A20 W5",
    f"""SELECT chain, compare_to_tvl, sum(compare_to_tvl) OVER () AS total_compare_to_tvl, recent_tvl, sum(recent_tvl) OVER () AS total_recent_tvl, chain_diff_tvl, sum(chain_diff_tvl) OVER () AS total_diff_tvl
        FROM (SELECT chain, sum(compare_to_tvl) AS compare_to_tvl, sum(recent_tvl) AS recent_tvl, sum(diff_tvl) AS chain_diff_tvl FROM ({_GROWTH.format(source=_LIVE)}) GROUP BY 1)""",
    "compare_to_tvl total_compare_to_tvl recent_tvl total_recent_tvl chain_diff_tvl total_diff_tvl",
)
def _(t):
    live = portfolio.not_retired(t.products)
    return tvl.growth_by_chain(tvl.growth(tvl.daily_tvl(t.vault_stats, live, t.price_1d)))


@query(
    "capture_daily", "A22",
    "SELECT s.product_id, time_bucket(INTERVAL '1 day', datetime) AS time, max(underlying_capture_percentage) AS capture, any_value(p.display_id) AS vault_id FROM vault_stats s JOIN products p USING (product_id) GROUP BY 1, 2",
    "capture",
)
def _(t):
    return tvl.daily_capture(t.vault_stats, t.products)


_ORDERED = "ORDER BY datetime, block_number, underlying_capture_percentage"


@query(
    "capture_change", "A22 J18",
    f"""SELECT s.*, p.product_key, p.display_id AS vault_id FROM (SELECT product_id, max(datetime) FILTER (WHERE datetime < TIMESTAMP '2024-01-15') AS compare_to_datetime, max(datetime) AS recent_datetime,
        last(underlying_capture_percentage {_ORDERED}) FILTER (WHERE datetime < TIMESTAMP '2024-01-15') AS compare_to_capture, last(underlying_capture_percentage {_ORDERED}) AS recent_capture,
        last(underlying_capture_percentage {_ORDERED}) - coalesce(last(underlying_capture_percentage {_ORDERED}) FILTER (WHERE datetime < TIMESTAMP '2024-01-15'), 0) AS diff_capture
        FROM vault_stats WHERE datetime < TIMESTAMP '2024-01-28' GROUP BY 1) s JOIN products p USING (product_id)""",
    "compare_to_capture recent_capture diff_capture",
)
def _(t):
    return tvl.capture_change(t.vault_stats, t.products, F.lit(datetime(2024, 1, 15)), F.lit(datetime(2024, 1, 28)))


_MIDNIGHT = """SELECT time_bucket(INTERVAL '1 day', s.datetime) AS datetime, s.product_id, any_value(p.chain) AS chain, any_value(p.display_id) AS vault_id, max(s.staked_underlying * m.price) AS staked_value_usd
   FROM vault_stats s JOIN products p USING (product_id) JOIN midnight_ticks m ON m.price_feed_id = p.price_feed_2_id AND m.datetime = time_bucket(INTERVAL '1 day', s.datetime) GROUP BY 1, 2"""


@query("midnight_staked_value", "J16", _MIDNIGHT, "staked_value_usd")
def _(t):
    return tvl.midnight_staked_value(t.vault_stats, t.products, t.midnight_ticks)


@query("midnight_staked_value_per_chain", "J16", f"SELECT datetime, chain, sum(staked_value_usd) AS staked_value_usd FROM ({_MIDNIGHT}) GROUP BY 1, 2", "staked_value_usd")
def _(t):
    value = tvl.midnight_staked_value(t.vault_stats, t.products, t.midnight_ticks)
    return value.groupBy("datetime", "chain").agg(F.sum("staked_value_usd").alias("staked_value_usd"))


@query(
    "vault_stats_listing", "Q18 P20",
    """SELECT s.product_id, p.display_id AS vault_id, s.datetime, s.block_number, CAST(CAST(CAST(s.staked_underlying AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS VARCHAR) AS staked_underlying,
       CAST(CAST(CAST(s.share_to_underlying_price AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS VARCHAR) AS share_to_underlying_price, CAST(CAST(CAST(s.underlying_total_supply AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS VARCHAR) AS underlying_total_supply, s.underlying_capture_percentage FROM vault_stats s JOIN products p USING (product_id)""",
    "underlying_capture_percentage",
)
def _(t):
    listed = tvl.stats_listing(t.vault_stats, t.products).orderBy("datetime")
    return listed.drop("vault_total_supply")  # a quotient of doubles: its last digits are each engine's own


@query("transfer_counts_per_chain", "A17 J1", "SELECT time_bucket(INTERVAL '4 hours', l.datetime) AS time, p.chain, count(*) AS transfers FROM ledger_diffs l JOIN products p USING (product_id) WHERE balance_diff <> 0 GROUP BY 1, 2")
def _(t):
    return mon.transfer_counts(t.ledger_diffs, t.products, "4hour")


@query("transfer_counts_per_product", "A17", "SELECT time_bucket(INTERVAL '1 day', l.datetime) AS time, p.product_key, count(*) AS transfers FROM ledger_diffs l JOIN products p USING (product_id) WHERE balance_diff <> 0 GROUP BY 1, 2")
def _(t):
    return mon.transfer_counts(t.ledger_diffs, t.products, "1day", "product_key")


@query("error_counts", "A24", "SELECT time_bucket(INTERVAL '1 hour', datetime) AS time, chain, rpc_url, count(*) AS errors FROM errors GROUP BY 1, 2, 3")
def _(t):
    return mon.error_counts(t.errors, "1hour", ["chain", "rpc_url"])


@query("error_samples", "L2 P7 A29", "SELECT chain, datetime, rpc_url, request FROM errors WHERE rpc_url LIKE '%node1%' ORDER BY datetime DESC LIMIT 500")
def _(t):
    named = t.errors.filter(F.col("rpc_url").contains("node1"))
    return named.orderBy(F.col("datetime").desc()).limit(500).select("chain", "datetime", "rpc_url", "request")


@query("distinct_error_chains", "A29 O2", "SELECT DISTINCT chain, rpc_url FROM errors")
def _(t):
    return t.errors.select("chain", "rpc_url").distinct()


_RISING = """SELECT chain, last(errors ORDER BY h) AS last_value, CAST(last(errors ORDER BY h) > avg(errors) + 2.5 * stddev_samp(errors) AS INT) AS is_rising
   FROM (SELECT chain, time_bucket(INTERVAL '1 hour', datetime) AS h, count(*) AS errors FROM errors WHERE datetime < TIMESTAMP '2024-02-01' GROUP BY 1, 2) GROUP BY 1"""


@query("rising_errors", "A23", _RISING)
def _(t):
    return mon.rising_errors(t.errors, AS_OF)


@query(
    "rising_work", "A23 A13",
    """SELECT chain, last(w ORDER BY h) AS last_value, CAST(last(w ORDER BY h) > avg(w) + 2.5 * stddev_samp(w) AS INT) AS is_rising FROM (
       SELECT 'net' || CAST(o_custkey % 20 AS VARCHAR) AS chain, TIMESTAMP '2024-01-01' + to_hours(CAST(o_orderkey % 700 AS INT)) AS h, CAST(sum(o_custkey % 11 + o_orderkey % 13) AS BIGINT) AS w FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    metrics = t.raw("orders").select(
        F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.pmod("o_orderkey", F.lit(700)) * 3600).alias("datetime"),
        F.concat(F.lit("net"), F.pmod("o_custkey", F.lit(20)).cast("string")).alias("chain"),
        F.lit("product:investment").alias("import_type"),
        F.pmod("o_custkey", F.lit(11)).alias("errors_count"),
        F.pmod("o_orderkey", F.lit(13)).alias("not_covered_yet"),
    )
    return mon.rising_work(metrics, AS_OF)


@query(
    "rows_without_price", "A25",
    "SELECT p.chain, CAST(count(*) AS BIGINT) AS rows_without_price FROM timeline t LEFT JOIN products p USING (product_id) WHERE underlying_to_usd_price IS NULL GROUP BY 1",
)
def _(t):
    return mon.missing_prices(t.timeline, t.products)


@query(
    "products_without_state", "J4 T17",
    "SELECT chain, count(*) AS products FROM products p WHERE NOT is_eol AND NOT EXISTS (SELECT 1 FROM states s WHERE s.import_key = 'product:investment:' || CAST(p.product_id AS VARCHAR)) GROUP BY 1",
)
def _(t):
    return mon.products_without_state(t.products, t.states)


@query("unreferenced_feeds_null_safe", "J5 T16", "SELECT price_feed_id FROM feeds WHERE price_feed_id NOT IN (SELECT price_feed_1_id FROM products WHERE price_feed_1_id IS NOT NULL UNION ALL SELECT price_feed_2_id FROM products WHERE price_feed_2_id IS NOT NULL)")
def _(t):
    return mon.unreferenced_feeds(t.feeds, t.products, null_safe=True).select("price_feed_id")


@query("unreferenced_feeds_count", "J5 T16", "SELECT count(*) AS feeds FROM feeds WHERE price_feed_id NOT IN (SELECT price_feed_1_id FROM products UNION ALL SELECT price_feed_2_id FROM products)")
def _(t):
    return mon.unreferenced_feeds(t.feeds, t.products).agg(F.count("*").alias("feeds"))


@query(
    "duplicate_keys", "A16",
    "SELECT l_orderkey, l_linenumber, count(DISTINCT l_shipdate) AS datetimes, count(DISTINCT l_quantity) AS l_quantitys FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_shipdate) > 1",
)
def _(t):
    return mon.duplicates(t.raw("lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity"], "l_shipdate")


@query(
    "duplicate_alternatives", "A16 F12",
    "SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem x WHERE (SELECT count(DISTINCT l_shipdate) FROM lineitem y WHERE y.l_orderkey = x.l_orderkey AND y.l_linenumber = x.l_linenumber) > 1",
    "l_quantity",
)
def _(t):
    return mon.duplicate_rows(t.raw("lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity"], "l_shipdate")


@query(
    "row_value_not_in", "J6",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN (SELECT o_orderkey, CAST(o_orderkey % 7 + 1 AS INT) FROM orders)",
)
def _(t):
    listed = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.pmod("o_orderkey", F.lit(7)) + 1).cast("int").alias("l_linenumber"))
    return mon.not_in_rows(t.raw("lineitem"), listed, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("table_counts", "A30 O1", "SELECT 'feeds' AS name, count(*) AS n FROM feeds UNION ALL SELECT 'products', count(*) FROM products UNION ALL SELECT 'investors', count(*) FROM investors")
def _(t):
    count = lambda name, df: df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
    return count("feeds", t.feeds).unionByName(count("products", t.products)).unionByName(count("investors", t.investors))


@query("rollup_after_retention", "ST5", "SELECT price_feed_id, count(*) AS hours FROM price_1h WHERE datetime >= TIMESTAMP '2024-07-20' - INTERVAL 6 MONTH GROUP BY 1")
def _(t):
    return mon.expired(t.price_1h, datetime(2024, 7, 20), "6 MONTH").groupBy("price_feed_id").agg(F.count("*").alias("hours"))


@query("errors_after_retention", "ST5", "SELECT chain, count(*) AS n FROM errors WHERE datetime >= TIMESTAMP '2024-02-15' - INTERVAL 1 MONTH GROUP BY 1")
def _(t):
    return mon.expired(t.errors, datetime(2024, 2, 15), "1 MONTH").groupBy("chain").agg(F.count("*").alias("n"))
