"""Ledger, balances, holders, valued timelines and profit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.timegrid import cell, time_bucket
from tidemark.operators import bitmaps, fifo, ohlc, sketches
from tidemark.operators.latest import current_holders
from tidemark.plans import portfolio, repricing, valuation
from tidemark.queries.registry import query
from tidemark.session import scratch_path
from tidemark.streaming import folds

AS_OF = datetime(2024, 2, 1)
BLOCK = 10**9
AT = datetime(2024, 1, 20, 12, 30)


@query("running_balance", "W9", "SELECT product_id, investor_id, block_number, balance FROM ledger", "balance")
def _(t):
    return t.ledger.select("product_id", "investor_id", "block_number", "balance")


@query(
    "current_holders", "A2",
    """SELECT product_id, investor_id, last(balance ORDER BY datetime, block_number) AS last_balance, max(datetime) AS last_datetime,
       last(block_number ORDER BY datetime, block_number) AS last_block_number FROM ledger GROUP BY 1, 2 HAVING last(balance ORDER BY datetime, block_number) > 0""",
    "last_balance",
)
def _(t):
    return current_holders(t.ledger)


_BALANCES = """WITH b AS (
    SELECT product_id, investor_id, last(balance ORDER BY datetime, block_number) AS last_balance FROM ledger
    WHERE datetime >= TIMESTAMP '2024-01-02' AND datetime <= TIMESTAMP '2024-01-20 12:30:00'{grace} AND block_number <= 1000000000
    GROUP BY 1, 2 HAVING last(balance ORDER BY datetime, block_number) > 0),
  h AS (SELECT price_feed_id, price_avg FROM price_1h WHERE datetime = TIMESTAMP '2024-01-20 12:00:00')
  SELECT b.product_id, CASE WHEN NOT p.is_boost THEN p.display_id END AS vault_id, CASE WHEN NOT p.is_boost THEN p.contract_address END AS vault_address,
         CASE WHEN NOT p.is_boost THEN p.want_address END AS want_address, i.address AS investor_address,
         h1.price_avg AS share_to_underlying_price, h2.price_avg AS underlying_to_usd_price, b.last_balance AS share_token_balance,
         CAST(b.last_balance AS DOUBLE) * h1.price_avg AS underlying_balance, CAST(b.last_balance AS DOUBLE) * h1.price_avg * h2.price_avg AS usd_balance
  FROM b JOIN products p USING (product_id) {how} JOIN h h1 ON h1.price_feed_id = p.price_feed_1_id {how} JOIN h h2 ON h2.price_feed_id = p.price_feed_2_id
  JOIN investors i USING (investor_id) {where}"""
_BALANCE_FLOATS = "share_to_underlying_price underlying_to_usd_price share_token_balance underlying_balance usd_balance"


@query("balances_at_block", "Q1 Q23 J1 J17 P12 T3 T5 T6", _BALANCES.format(grace=" + INTERVAL 1 DAY", how="", where=""), _BALANCE_FLOATS)
def _(t):
    return portfolio.balances_at(t.ledger, t.products, t.investors, ohlc.rollup_between(t.price_ts, "1hour", AT, AT), BLOCK, AT, datetime(2024, 1, 2), grace="1day")


@query("balances_at_block_unpriced", "Q1 T6", _BALANCES.format(grace="", how="LEFT", where=""), _BALANCE_FLOATS)
def _(t):
    return portfolio.balances_at(t.ledger, t.products, t.investors, ohlc.rollup_between(t.price_ts, "1hour", AT, AT), BLOCK, AT, datetime(2024, 1, 2), require_prices=False)


@query("chain_balances_at_block", "Q2 Q23 J3", _BALANCES.format(grace="", how="", where="WHERE p.chain = 'view'"), _BALANCE_FLOATS)
def _(t):
    scope = t.products.filter(F.col("chain") == "view")
    return portfolio.balances_at(t.ledger, scope, t.investors, ohlc.rollup_between(t.price_ts, "1hour", AT, AT), BLOCK, AT, datetime(2024, 1, 2))


@query(
    "points_balances_at_block", "Q3 Q23 P2",
    _BALANCES.format(grace="", how="", where="WHERE NOT p.is_eol AND NOT p.is_boost AND p.earns_points"),
    _BALANCE_FLOATS,
)
def _(t):
    return portfolio.balances_at(t.ledger, portfolio.points_products(t.products), t.investors, ohlc.rollup_between(t.price_ts, "1hour", AT, AT), BLOCK, AT, datetime(2024, 1, 2))


# half of the highest block: where the ledger is cut depends on the data
_BOUND = """WITH x AS (SELECT max(block_number) // 2 AS b FROM blocks), z AS (SELECT min(datetime) AS at FROM blocks, x WHERE chain = 'view' AND block_number >= b),
  l AS (SELECT l.product_id, l.investor_id, last(l.balance ORDER BY l.datetime, l.block_number) AS balance FROM ledger l JOIN (SELECT product_id, min(TIMESTAMP '2024-01-01' + to_days(CAST(product_id % 7 AS INT))) AS created FROM states GROUP BY 1) s USING (product_id), x, z
        WHERE l.datetime >= s.created AND l.datetime <= z.at AND l.block_number <= x.b GROUP BY 1, 2 HAVING last(l.balance ORDER BY l.datetime, l.block_number) > 0),
  h AS (SELECT price_feed_id, price_avg FROM price_1h, z WHERE datetime = time_bucket(INTERVAL '1 hour', z.at))
  SELECT l.product_id, i.address AS investor_address, h1.price_avg AS share_to_underlying_price, h2.price_avg AS underlying_to_usd_price, l.balance AS share_token_balance,
         CAST(l.balance AS DOUBLE) * h1.price_avg * h2.price_avg AS usd_balance
  FROM l JOIN products p ON p.product_id = l.product_id AND p.chain = 'view' LEFT JOIN h h1 ON h1.price_feed_id = p.price_feed_1_id LEFT JOIN h h2 ON h2.price_feed_id = p.price_feed_2_id JOIN investors i USING (investor_id)"""


@query("balances_at_bound_block", "Q1 Q2 Q7 Q23 L4", _BOUND, "share_to_underlying_price underlying_to_usd_price share_token_balance usd_balance")
def _(t):
    block = t.blocks.agg((F.max("block_number") / 2).cast("bigint")).first()[0]
    created = F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.pmod("product_id", F.lit(7)) * 86400)
    states = t.states.withColumns(
        {"contract_creation_date": created, "contract_created_at_block": F.lit(0).cast("long"), "chain_latest_block_number": F.lit(block).cast("long")}
    )
    retries = t.coverage.withColumn("from", F.col("from") + block)  # nothing before the block waits for a retry
    held = portfolio.balances_at_block(t.ledger, t.products, t.investors, t.price_ts, t.blocks, states, retries, "view", block, require_prices=False)
    return held.select("product_id", "investor_address", "share_to_underlying_price", "underlying_to_usd_price", "share_token_balance", "usd_balance")


_TIMELINE = "investor_id product_id datetime block_number transaction_hash balance balance_diff share_to_underlying_price underlying_balance underlying_diff underlying_to_usd_price usd_balance usd_diff"
_TIMELINE_FLOATS = "balance balance_diff share_to_underlying_price underlying_balance underlying_diff underlying_to_usd_price usd_balance usd_diff"


@query("valued_timeline", "D9 J8 P12 S10", f"SELECT {', '.join(_TIMELINE.split())} FROM timeline", _TIMELINE_FLOATS)
def _(t):
    from tidemark.functions.hexbytes import to_hex_text

    return t.timeline.withColumn("transaction_hash", to_hex_text(F.col("transaction_hash"))).select(*_TIMELINE.split())


@query(
    "investor_timeline", "Q4 F1 P1",
    """SELECT t.investor_id, t.datetime, p.product_key, p.display_id AS display_name, p.chain, p.is_eol, p.is_eol AS is_dashboard_eol, t.transaction_hash,
       share_to_underlying_price, underlying_to_usd_price, balance AS share_balance, underlying_balance, usd_balance, balance_diff AS share_diff, underlying_diff, usd_diff
       FROM timeline t JOIN products p USING (product_id)""",
    "share_to_underlying_price underlying_to_usd_price share_balance underlying_balance usd_balance share_diff underlying_diff usd_diff",
)
def _(t):
    return portfolio.investor_timeline(t.timeline, t.products).orderBy("investor_id", "product_key", "datetime")


_COUNTS = ", ".join(f"count(*) FILTER (WHERE usd > {10**k}) AS investor_count_more_than_{10**k}_usd" for k in range(8))


@query(
    "investor_threshold_counts", "A6 Q5 T7",
    f"""SELECT product_id, product_key, display_id AS vault_id, investor_count, {', '.join(f'investor_count_more_than_{10**k}_usd' for k in range(8))}
       FROM (SELECT product_id, count(*) AS investor_count, {_COUNTS} FROM (SELECT product_id, investor_id, last(usd_balance ORDER BY datetime, block_number) AS usd FROM timeline GROUP BY 1, 2) GROUP BY 1)
       JOIN products USING (product_id)""",
)
def _(t):
    return portfolio.threshold_counts(t.timeline, t.products)


def _days(t):
    """The midnights after each day of the data."""
    next_day = lambda ts: F.timestamp_micros(F.unix_micros(F.date_trunc("day", ts)) + F.lit(86_400_000_000))
    ends = t.raw("events").agg(next_day(F.min("ts")).alias("lo"), next_day(F.max("ts")).alias("hi"))
    return ends.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("datetime"))


def _snapshots(t):
    return sketches.daily_snapshots(t.timeline, _days(t))


_SNAP_SQL = """(SELECT d.datetime, h.product_id, h.investor_id, h.usd_balance FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) + INTERVAL 1 DAY FROM events), (SELECT date_trunc('day', max(ts)) + INTERVAL 1 DAY FROM events), INTERVAL 1 DAY)) AS datetime) d,
  LATERAL (SELECT product_id, investor_id, last(usd_balance ORDER BY datetime, block_number) AS usd_balance FROM timeline x WHERE x.datetime <= d.datetime AND balance_diff <> 0
           GROUP BY 1, 2 HAVING last(balance ORDER BY datetime, block_number) > 0) h)"""


# sketches this small hold their members one by one, so at the checked scale their estimates are exact counts
_SEGMENT_COUNTS = ", ".join(
    f"count(DISTINCT investor_id) FILTER (WHERE usd_balance >= {low}{f' AND usd_balance < {high}' if high else ''}) AS count_{name}"
    for name, (low, high) in sketches.SEGMENTS.items()
)
_DAILY_COUNTS = f"(SELECT datetime, product_id, count(DISTINCT investor_id) AS n FROM {_SNAP_SQL} GROUP BY 1, 2)"
_HISTORY = ", ".join(
    f"max(datetime) FILTER (WHERE datetime < TIMESTAMP '2024-02-01' - INTERVAL {d} DAY) AS hist_{d}d_datetime, "
    f"arg_max(n, datetime) FILTER (WHERE datetime < TIMESTAMP '2024-02-01' - INTERVAL {d} DAY) AS hist_{d}d_approx_investor_count"
    for d in (3, 7, 15, 30)
)
_HISTORY_SQL = f"""SELECT product_id, {_HISTORY} FROM {_DAILY_COUNTS}
   WHERE datetime < TIMESTAMP '2024-01-31' AND datetime >= TIMESTAMP '2024-02-01' - INTERVAL 31 DAY GROUP BY 1"""


@query("holder_sketch_daily", "A7 A8 T8 ST6", f"SELECT datetime, product_id, {_SEGMENT_COUNTS} FROM {_SNAP_SQL} GROUP BY 1, 2")
def _(t):
    return sketches.segment_counts(_snapshots(t), ["datetime", "product_id"]).orderBy("datetime", "product_id")


@query(
    "holder_sketch_small_counts", "A7 A8 T18",
    f"""SELECT datetime, product_id, count(DISTINCT investor_id) AS approx_investor_count FROM {_SNAP_SQL} GROUP BY 1, 2""",
)
def _(t):
    return sketches.rollup_count(_snapshots(t), ["datetime", "product_id"])


@query(
    "holder_sketch_per_chain", "A8 A31",
    f"SELECT datetime AS time, p.chain, count(DISTINCT investor_id) AS approx_investor_count FROM {_SNAP_SQL} s JOIN products p USING (product_id) GROUP BY 1, 2",
)
def _(t):
    joined = _snapshots(t).join(t.products.select("product_id", "chain"), "product_id")
    return sketches.rebucketed_count(joined, ["chain"], "4hour", "1day")


@query("holder_sketch_history", "A9 Q5 F8 T20", _HISTORY_SQL)
def _(t):
    return sketches.counts_before(_snapshots(t), F.lit(AS_OF), {"hist_3d": 3, "hist_7d": 7, "hist_15d": 15, "hist_30d": 30})


@query(
    "holder_count_growth", "A21 J18",
    f"""SELECT *, recent_approx_investor_count - compare_to_approx_investor_count AS approx_investor_count_diff,
        (recent_approx_investor_count - compare_to_approx_investor_count) / compare_to_approx_investor_count AS approx_investor_count_diff_percent FROM (
        SELECT product_id, max(datetime) FILTER (WHERE datetime < TIMESTAMP '2024-01-10') AS compare_to_datetime, max(datetime) AS recent_datetime,
          CAST(arg_max(n, datetime) FILTER (WHERE datetime < TIMESTAMP '2024-01-10') AS DOUBLE) AS compare_to_approx_investor_count, CAST(arg_max(n, datetime) AS DOUBLE) AS recent_approx_investor_count
        FROM {_DAILY_COUNTS} WHERE datetime < TIMESTAMP '2024-01-30' GROUP BY 1)""",
    "compare_to_approx_investor_count recent_approx_investor_count approx_investor_count_diff approx_investor_count_diff_percent",
)
def _(t):
    return sketches.count_growth(_snapshots(t), F.lit(datetime(2024, 1, 10)), F.lit(datetime(2024, 1, 30)))


@query(
    "investor_counts_report", "Q5",
    f"""SELECT * FROM (SELECT product_id, product_key, display_id AS vault_id, investor_count, {', '.join(f'investor_count_more_than_{10**k}_usd' for k in range(8))}
        FROM (SELECT product_id, count(*) AS investor_count, {_COUNTS} FROM (SELECT product_id, investor_id, last(usd_balance ORDER BY datetime, block_number) AS usd FROM timeline GROUP BY 1, 2) GROUP BY 1)
        JOIN products USING (product_id) WHERE NOT is_eol) LEFT JOIN ({_HISTORY_SQL}) USING (product_id)""",
)
def _(t):
    return portfolio.investor_counts(t.timeline, _snapshots(t), t.products, AS_OF)


@query(
    "exact_holders_daily", "A10 W2 W3 T15",
    """WITH g AS (SELECT i.investor_id, d.datetime, last_value(b.balance IGNORE NULLS) OVER (PARTITION BY i.investor_id ORDER BY d.datetime ROWS UNBOUNDED PRECEDING) AS balance
         FROM (SELECT DISTINCT investor_id FROM ledger WHERE datetime BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28 06:00:00') i
         CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-28', INTERVAL 1 DAY)) AS datetime) d
         LEFT JOIN (SELECT investor_id, time_bucket(INTERVAL '1 day', datetime) AS datetime, last(balance ORDER BY datetime, block_number) AS balance FROM ledger
                    WHERE datetime BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28 06:00:00' GROUP BY 1, 2) b ON b.investor_id = i.investor_id AND b.datetime = d.datetime)
       SELECT datetime, count(DISTINCT investor_id) AS investor_count FROM g WHERE balance > 0 GROUP BY 1""",
)
def _(t):
    return portfolio.exact_holders(t.ledger, "1day", F.lit(datetime(2024, 1, 3)), F.lit(datetime(2024, 1, 28, 6)))


def _held_sql(keys: str, join: str = "") -> str:
    """Who holds, per day: the last balance of each day carried forward within the stretch."""
    return f"""SELECT {keys}, g.datetime, g.investor_id FROM (
         SELECT i.product_id, i.investor_id, d.datetime, last_value(b.balance IGNORE NULLS) OVER (PARTITION BY i.product_id, i.investor_id ORDER BY d.datetime ROWS UNBOUNDED PRECEDING) AS balance
         FROM (SELECT DISTINCT product_id, investor_id FROM ledger WHERE datetime BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28 06:00:00') i
         CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-28', INTERVAL 1 DAY)) AS datetime) d
         LEFT JOIN (SELECT product_id, investor_id, time_bucket(INTERVAL '1 day', datetime) AS datetime, last(balance ORDER BY datetime, block_number) AS balance FROM ledger
                    WHERE datetime BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28 06:00:00' GROUP BY 1, 2, 3) b USING (product_id, investor_id, datetime)) g {join} WHERE g.balance > 0"""


def stored_holders(t):
    """The bitmaps of each product and day as a landed table."""
    path = scratch_path(t.spark, "holders")
    bitmaps.holders(t.ledger, ["product_id"], "1day", F.lit(datetime(2024, 1, 3)), F.lit(datetime(2024, 1, 28, 6))).write.parquet(path)
    return t.spark.read.parquet(path)


@query("holders_of_products_daily", "A10 Q5", f"SELECT product_id, datetime, count(DISTINCT investor_id) AS investor_count FROM ({_held_sql('g.product_id')}) GROUP BY 1, 2")
def _(t):
    return bitmaps.counts(stored_holders(t), ["product_id", "datetime"])


@query(
    "holders_of_chains_daily", "A10 A11 Q5",
    f"SELECT chain, datetime, count(DISTINCT investor_id) AS investor_count FROM ({_held_sql('p.chain', 'JOIN products p USING (product_id)')}) GROUP BY 1, 2",
)
def _(t):
    return portfolio.holders_by(stored_holders(t), t.products, ["chain"])


@query(
    "holders_of_chains_within_weeks", "A10 A31 Q5",
    f"SELECT chain, time_bucket(INTERVAL 7 DAY, datetime, TIMESTAMP '2000-01-03') AS datetime, count(DISTINCT investor_id) AS investor_count FROM ({_held_sql('p.chain', 'JOIN products p USING (product_id)')}) GROUP BY 1, 2",
)
def _(t):
    # whoever held anything of a chain on any day of a week, once
    weekly = stored_holders(t).withColumn("datetime", time_bucket("1week", F.col("datetime")))
    return portfolio.holders_by(weekly, t.products, ["chain"])


_TOTALS = """SELECT i.address, sum(b.last_balance) AS total_balance, log10(sum(b.last_balance)) AS log_balance
  FROM (SELECT investor_id, last(balance ORDER BY datetime, block_number) AS last_balance FROM ledger GROUP BY 1) b LEFT JOIN investors i USING (investor_id)
  GROUP BY 1 HAVING sum(b.last_balance) > 10"""


@query("holders_above_minimum", "A11 F9", _TOTALS, "total_balance log_balance")
def _(t):
    return portfolio.holder_totals(t.ledger, t.investors, 10)


@query("holders_above_minimum_count", "A11", f"SELECT count(*) AS holders FROM ({_TOTALS})")
def _(t):
    return portfolio.holder_totals(t.ledger, t.investors, 10).agg(F.count("*").alias("holders"))


@query(
    "holder_size_histogram", "A12",
    f"SELECT CASE WHEN log_balance < 0 THEN 0 WHEN log_balance >= 4 THEN 9 ELSE CAST(floor(log_balance * 2) AS BIGINT) + 1 END AS bucket, count(*) AS holders FROM ({_TOTALS}) GROUP BY 1",
)
def _(t):
    return portfolio.holder_histogram(portfolio.holder_totals(t.ledger, t.investors, 10), 8, 0, 4)


@query(
    "product_holder_list", "A2 P20",
    """SELECT b.product_id, i.address AS investor_address, balance AS balance_num, CAST(CAST(CAST(balance AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS VARCHAR) AS balance_txt, last_event, last_event_block_number FROM (
       SELECT product_id, investor_id, last(balance ORDER BY datetime, block_number) AS balance, max(datetime) AS last_event, last(block_number ORDER BY datetime, block_number) AS last_event_block_number
       FROM ledger GROUP BY 1, 2) b JOIN investors i USING (investor_id) WHERE balance > 0""",
    "balance_num",
)
def _(t):
    return portfolio.product_holders(t.ledger, t.investors)


@query(
    "valued_transactions", "Q8 Q17",
    """SELECT p.chain, p.product_key, p.display_id AS product_name, t.investor_id, t.datetime, t.block_number, balance, balance_diff, share_to_underlying_price, underlying_balance, underlying_diff,
       underlying_to_usd_price, usd_balance, usd_diff, t.transaction_hash AS trx_hash FROM timeline t JOIN products p USING (product_id)""",
    _TIMELINE_FLOATS,
)
def _(t):
    return portfolio.transactions(t.timeline.drop("price_feed_1_id"), t.products, valued=True).orderBy(F.col("datetime").desc())


@query(
    "ledger_export", "Q16 J2",
    "SELECT l.datetime, l.block_number, p.chain, p.product_key, i.address AS investor_address, l.balance FROM ledger l LEFT JOIN products p USING (product_id) LEFT JOIN investors i USING (investor_id)",
    "balance",
)
def _(t):
    return portfolio.ledger_export(t.ledger, t.products, t.investors)


_FIFO = """WITH s AS (SELECT *, sum(shares) OVER w AS S, sum(CASE WHEN shares > 0 THEN shares ELSE 0 END) OVER w AS B FROM trades
     WINDOW w AS (PARTITION BY investor_id, product_id ORDER BY datetime, order_id, line, part, amount, shares ROWS UNBOUNDED PRECEDING)),
   i AS (SELECT *, S - least(0, min(S) OVER w) AS I FROM s WINDOW w AS (PARTITION BY investor_id, product_id ORDER BY datetime, order_id, line, part, amount, shares ROWS UNBOUNDED PRECEDING)),
   e AS (SELECT *, B - I AS E, coalesce(lag(B - I) OVER w, 0) AS E0, max(B - I) OVER (PARTITION BY investor_id, product_id) AS EA
         FROM i WINDOW w AS (PARTITION BY investor_id, product_id ORDER BY datetime, order_id, line, part, amount, shares)),
   u AS (SELECT *, greatest(0, least(B, EA) - (B - shares)) AS used FROM e)
 SELECT investor_id, product_id, sum(CASE WHEN shares < 0 THEN (E - E0) * price ELSE -used * price END) AS realized_pnl,
   coalesce(sum(shares - used) FILTER (WHERE shares > 0), 0) AS remaining_shares, coalesce(sum((shares - used) * price) FILTER (WHERE shares > 0), 0) AS remaining_cost,
   CASE WHEN coalesce(sum(shares - used) FILTER (WHERE shares > 0), 0) = 0 THEN 0
        ELSE sum((shares - used) * price) FILTER (WHERE shares > 0) / sum(shares - used) FILTER (WHERE shares > 0) END AS avg_entry_price,
   coalesce(sum(shares - used) FILTER (WHERE shares > 0), 0) * 1500.0 - coalesce(sum((shares - used) * price) FILTER (WHERE shares > 0), 0) AS unrealized_pnl
 FROM u GROUP BY 1, 2"""


@query("fifo_profit", "W8", _FIFO, "realized_pnl remaining_shares remaining_cost avg_entry_price unrealized_pnl")
def _(t):
    day = cell(F.col("datetime"), 24)
    return fifo.unrealized(fifo.pnl(t.trades, t.TRADE_KEYS, t.TRADE_ORDER, day), F.lit(1500.0))


@query("fifo_folded", "W8 W9 ST9", _FIFO, "realized_pnl remaining_shares remaining_cost avg_entry_price unrealized_pnl")
def _(t):
    # the trades come year by year, one in nine only after all others
    path, landing = scratch_path(t.spark, "positions"), scratch_path(t.spark, "trades")
    t.trades.withColumn("round", F.when(F.pmod("order_id", F.lit(9)) == 0, 0).otherwise(F.year("datetime"))).write.partitionBy("round").parquet(landing)
    landed = t.spark.read.parquet(landing)
    years = sorted(r[0] for r in landed.select("round").distinct().collect())
    rounds = [y for y in years if y] + [y for y in years if not y]
    for n, own in enumerate(rounds):
        come = landed.filter(F.col("round").isin(rounds[: n + 1]))
        folds.fold(t.spark, path, landed.filter(F.col("round") == own), come, n, t.TRADE_KEYS, t.TRADE_ORDER, cell(F.col("datetime"), 24))
    return fifo.unrealized(folds.positions(t.spark, path, t.TRADE_KEYS), F.lit(1500.0)).drop("balance")


@query(
    "fifo_inventory", "W8",
    """WITH s AS (SELECT *, sum(shares) OVER w AS S FROM trades WINDOW w AS (PARTITION BY investor_id, product_id ORDER BY datetime, order_id, line, part, amount, shares ROWS UNBOUNDED PRECEDING))
       SELECT investor_id, product_id, datetime, order_id, line, part, shares, S - least(0, min(S) OVER w) AS inventory
       FROM s WINDOW w AS (PARTITION BY investor_id, product_id ORDER BY datetime, order_id, line, part, amount, shares ROWS UNBOUNDED PRECEDING)""",
    "shares inventory",
)
def _(t):
    day = cell(F.col("datetime"), 24)
    tracked = fifo.inventory(t.trades, t.TRADE_KEYS, t.TRADE_ORDER, day)
    return tracked.select("investor_id", "product_id", "datetime", "order_id", "line", "part", "shares", "inventory")


def _tiers_sql(rows: str, ticks: str, green: str) -> str:
    """SQL for prices by tiers: rows without a price, ticks, and the stretches that were imported well."""
    return f"""WITH r AS ({rows}),
       ticks AS ({ticks}),
       fp AS (SELECT price_feed_id, min(datetime) AS first_datetime, first(price ORDER BY datetime, block_number) AS first_price FROM ticks GROUP BY 1),
       m AS (SELECT price_feed_id, time_bucket(INTERVAL '15 minutes', datetime) AS b, last(price ORDER BY datetime, block_number) AS price FROM ticks GROUP BY 1, 2),
       a AS (SELECT r.block_number, time_bucket(INTERVAL '15 minutes', t.datetime) AS tb, time_bucket(INTERVAL '15 minutes', r.datetime) AS b, avg(CAST(t.price AS DOUBLE)) AS v
             FROM r JOIN ticks t ON t.price_feed_id = r.f AND t.datetime BETWEEN r.datetime - INTERVAL 3 DAY AND r.datetime + INTERVAL 3 DAY GROUP BY 1, 2, 3),
       n AS (SELECT block_number, b, arg_max(v, tb) FILTER (WHERE tb <= b) AS pv, max(tb) FILTER (WHERE tb <= b) AS pt, arg_min(v, tb) FILTER (WHERE tb >= b) AS nv, min(tb) FILTER (WHERE tb >= b) AS nt FROM a GROUP BY 1, 2),
       x AS (SELECT r.*, m.price AS mp, fp.first_datetime AS fd, fp.first_price AS fpr,
                    CASE WHEN n.pt = n.b THEN n.pv WHEN n.nt > n.pt THEN n.pv + (n.nv - n.pv) * epoch_us(n.b - n.pt) / epoch_us(n.nt - n.pt) END AS ip
             FROM r LEFT JOIN m ON m.price_feed_id = r.f AND m.b = time_bucket(INTERVAL '15 minutes', r.datetime) LEFT JOIN fp ON fp.price_feed_id = r.f LEFT JOIN n ON n.block_number = r.block_number),
       y AS (SELECT *, CASE WHEN mp IS NOT NULL THEN 1 WHEN fpr IS NULL THEN 2 WHEN datetime < fd THEN 3 ELSE 4 END AS tier FROM x),
       z AS (SELECT *, CASE WHEN tier <= 3 THEN TIMESTAMP '2023-12-01' ELSE greatest(datetime - INTERVAL 1 DAY, fd) END AS need_from,
                    CASE tier WHEN 2 THEN least(datetime + INTERVAL 30 DAY, TIMESTAMP '2024-02-01') WHEN 3 THEN fd ELSE least(datetime + INTERVAL 1 DAY, TIMESTAMP '2024-02-01') END AS need_to FROM y),
       g AS ({green})
       SELECT investor_id, product_id, block_number, datetime, f AS price_feed_id, tier,
              CASE tier WHEN 1 THEN CAST(mp AS DOUBLE) WHEN 2 THEN 0.0 WHEN 3 THEN CAST(fpr AS DOUBLE) ELSE ip END AS price
       FROM z WHERE (tier = 1 OR EXISTS (SELECT 1 FROM g WHERE g.f = z.f AND g.lo <= epoch_ms(need_from) AND epoch_ms(need_to) <= g.hi))
         AND CASE tier WHEN 1 THEN CAST(mp AS DOUBLE) WHEN 2 THEN 0.0 WHEN 3 THEN CAST(fpr AS DOUBLE) ELSE ip END IS NOT NULL"""


@query(
    "missing_price_tiers", "D10 D11 W6 J8 A1",
    _tiers_sql(
        "SELECT l.investor_id, l.product_id, l.block_number, l.datetime, CAST(l.block_number % 7 + 1 AS INT) AS f FROM ledger_diffs l",
        "SELECT * FROM price_ts WHERE datetime >= TIMESTAMP '2024-01-08'",
        """SELECT 6 AS f, epoch_ms(TIMESTAMP '2023-12-01') AS lo, epoch_ms(TIMESTAMP '2024-02-01') AS hi UNION ALL
             SELECT f, epoch_ms(TIMESTAMP '2023-12-01'), epoch_ms(TIMESTAMP '2024-01-15') - 1 FROM (SELECT unnest([1,2,3,4,5]) AS f) UNION ALL
             SELECT f, epoch_ms(TIMESTAMP '2024-01-16') + 1, epoch_ms(TIMESTAMP '2024-02-01') FROM (SELECT unnest([1,2,3,4,5]) AS f)""",
    ),
    "price",
)
def _(t):
    rows = t.ledger_diffs.select(
        "investor_id", "product_id", "block_number", "datetime", (F.pmod("block_number", F.lit(7)) + 1).cast("int").alias("price_feed_id")
    )
    ticks = t.price_ts.filter(F.col("datetime") >= F.lit(datetime(2024, 1, 8)))
    # imports of feeds 1-6 began in December; those of 1-5 failed on one day in January; feeds 6 and 7 have no tick
    ids = t.products.select((F.pmod("product_id", F.lit(6)) + 1).cast("int").alias("price_feed_id")).distinct()
    feeds = ids.withColumn("first_date", F.lit(datetime(2023, 12, 1)))
    ms = lambda d: F.unix_millis(F.lit(d).cast("timestamp"))
    covered = ids.select("price_feed_id", ms("2023-12-01").alias("from"), ms("2024-02-01").alias("to"))
    retry = ids.filter("price_feed_id <= 5").select("price_feed_id", ms("2024-01-15").alias("from"), ms("2024-01-16").alias("to"))
    return valuation.resolve_missing(rows, ticks, covered, retry, feeds, AS_OF)


# feeds 2 and 3 are imported anew over ten days: feed 3 has no tick any more, feed 2 only one in five, from the 13th on
_NEW_TICKS = """SELECT datetime, price_feed_id, block_number, CAST(price AS DOUBLE) + 1 AS price FROM price_ts
       WHERE price_feed_id <> 3 AND (price_feed_id <> 2 OR block_number % 5 = 0 AND datetime >= TIMESTAMP '2024-01-13')"""
_HIT = """(product_id IN (SELECT product_id FROM products WHERE price_feed_1_id IN (2, 3) OR price_feed_2_id IN (2, 3))
         AND datetime BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-19 23:59:59')"""
_REPRICED = _tiers_sql(
    f"SELECT l.investor_id, l.product_id, l.block_number, l.datetime, p.price_feed_2_id AS f FROM (SELECT * FROM timeline WHERE {_HIT}) l JOIN products p USING (product_id)",
    _NEW_TICKS,
    """SELECT f, epoch_ms(TIMESTAMP '2023-12-01') AS lo, epoch_ms(TIMESTAMP '2024-02-01') AS hi FROM (SELECT unnest([1,3,4,5]) AS f) UNION ALL
             SELECT 2, epoch_ms(TIMESTAMP '2023-12-01'), epoch_ms(TIMESTAMP '2024-01-16') - 1 UNION ALL SELECT 2, epoch_ms(TIMESTAMP '2024-01-17') + 1, epoch_ms(TIMESTAMP '2024-02-01')""",
)


def repriced(t):
    """The stored timeline after the refresh, and what was priced by which tier."""
    path, resolved = scratch_path(t.spark, "timeline"), scratch_path(t.spark, "resolved")
    repricing.store(t.timeline, t.products, path)
    feed, at = F.col("price_feed_id"), F.col("datetime")
    thinned = (feed != 2) | (F.pmod("block_number", F.lit(5)) == 0) & (at >= F.lit("2024-01-13").cast("timestamp"))
    ticks = t.price_ts.filter((feed != 3) & thinned).withColumn("price", (F.col("price") + 1).cast("decimal(38,18)"))
    refreshed = t.price_ts.select("price_feed_id").distinct().filter("price_feed_id IN (2, 3)").withColumns(
        {"from": F.lit("2024-01-10").cast("timestamp"), "to": F.lit("2024-01-19 23:59:59").cast("timestamp")}
    )
    ids = t.products.select(F.col("price_feed_2_id").alias("price_feed_id")).distinct()
    ms = lambda d: F.unix_millis(F.lit(d).cast("timestamp"))
    covered = ids.select("price_feed_id", ms("2023-12-01").alias("from"), ms("2024-02-01").alias("to"))
    retry = ids.filter("price_feed_id = 2").select("price_feed_id", ms("2024-01-16").alias("from"), ms("2024-01-17").alias("to"))
    created = ids.withColumn("first_date", F.lit(datetime(2023, 12, 1)))
    priced = repricing.reprice(t.spark, path, t.products, refreshed, ticks, covered, retry, created, AS_OF, resolved)
    return repricing.read(t.spark, path), priced


@query(
    "repriced_partitions", "ST4 S15 S14 D10",
    f"""SELECT t.investor_id, t.product_id, t.block_number, t.datetime, CASE WHEN {_HIT} THEN x.price ELSE t.underlying_to_usd_price END AS underlying_to_usd_price,
       CASE WHEN {_HIT} THEN t.underlying_balance * x.price ELSE t.usd_balance END AS usd_balance
       FROM timeline t LEFT JOIN (SELECT investor_id AS i, product_id AS p, block_number AS b, price FROM ({_REPRICED})) x ON x.i = t.investor_id AND x.p = t.product_id AND x.b = t.block_number""",
    "underlying_to_usd_price usd_balance",
)
def _(t):
    return repriced(t)[0].select("investor_id", "product_id", "block_number", "datetime", "underlying_to_usd_price", "usd_balance")


@query("repriced_tiers", "ST4 D10 D11", f"SELECT tier, count(*) AS n FROM ({_REPRICED}) GROUP BY 1")
def _(t):
    return repriced(t)[1].groupBy("tier").agg(F.count("*").alias("n"))


@query(
    "bridged_share_rate", "D12 J9 J10",
    """WITH tr AS (SELECT event_id, CAST(event_id % 5 + 1 AS INT) AS f, ts, (['click','error','purchase','signup','view'])[CAST(user_id % 5 AS INT) + 1] AS c FROM events),
       ticks AS (SELECT * FROM price_ts WHERE datetime < TIMESTAMP '2024-01-15'),
       n AS (SELECT * FROM (SELECT tr.event_id, q.price, q.datetime, q.block_number, row_number() OVER (PARTITION BY tr.event_id ORDER BY abs(epoch_us(q.datetime) - epoch_us(tr.ts)), q.datetime, q.block_number) AS rn
             FROM tr JOIN ticks q ON q.price_feed_id = tr.f AND q.datetime BETWEEN tr.ts - INTERVAL 10 MINUTE AND tr.ts + INTERVAL 10 MINUTE) WHERE rn = 1),
       b AS (SELECT * FROM (SELECT tr.event_id, q.block_number, row_number() OVER (PARTITION BY tr.event_id ORDER BY abs(epoch_us(q.datetime) - epoch_us(tr.ts)), q.datetime, q.block_number) AS rn
             FROM tr JOIN blocks q ON q.chain = tr.c AND q.datetime BETWEEN tr.ts - INTERVAL 1 HOUR AND tr.ts + INTERVAL 1 HOUR) WHERE rn = 1)
       SELECT tr.event_id, coalesce(n.price, r.price) AS share_rate, CASE WHEN n.price IS NOT NULL THEN n.block_number ELSE b.block_number END AS share_rate_block_number,
              CASE WHEN n.price IS NOT NULL THEN 'feed' WHEN r.price IS NOT NULL THEN 'origin' END AS share_rate_source
       FROM tr LEFT JOIN n USING (event_id) LEFT JOIN b USING (event_id) LEFT JOIN price_ts r ON r.price_feed_id = tr.f AND r.block_number = b.block_number""",
    "share_rate",
)
def _(t):
    from tidemark.sources.standins import _chain_of

    transfers = t.raw("events").select(
        "event_id",
        (F.pmod("event_id", F.lit(5)) + 1).cast("int").alias("price_feed_id"),
        F.col("ts").alias("datetime"),
        _chain_of(F.col("user_id")).alias("origin_chain"),
    )
    known = t.price_ts.filter(F.col("datetime") < F.lit(datetime(2024, 1, 15)))
    return valuation.bridged_share_rates(transfers, known, t.blocks, t.price_ts).select(
        "event_id", "share_rate", "share_rate_block_number", "share_rate_source"
    )


@query(
    "preferred_block_time", "D13",
    """SELECT e.event_id, coalesce(b.d, e.ts + INTERVAL 3 SECOND) AS datetime FROM events e
       LEFT JOIN (SELECT chain, block_number, min(datetime) AS d FROM blocks WHERE datetime < TIMESTAMP '2024-01-15' GROUP BY 1, 2) b ON b.chain = e.event_type AND b.block_number = e.event_id""",
)
def _(t):
    rows = t.raw("events").select(
        "event_id", F.col("event_type").alias("chain"), F.col("event_id").alias("block_number"), (F.col("ts") + F.expr("INTERVAL 3 SECOND")).alias("fetched_datetime")
    )
    stored = t.blocks.filter(F.col("datetime") < F.lit(datetime(2024, 1, 15)))
    return valuation.preferred_block_time(rows, stored).select("event_id", "datetime")
