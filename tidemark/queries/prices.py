"""Prices and blocks: buckets, rollups, gap filling, joins on time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.timegrid import epoch_seconds_between, time_bucket
from tidemark.operators import asof, gapfill, ohlc
from tidemark.operators.latest import first_by, keep_first, last_by, top_per_key
from tidemark.plans import monitoring, portfolio, valuation
from tidemark.queries.registry import query
from tidemark.sources import bucketed

AS_OF = datetime(2024, 2, 1)
MID = datetime(2024, 1, 16, 12)
LO, HI = datetime(2024, 1, 5), datetime(2024, 1, 25)
OHLC = "price_avg price_high price_low price_open price_close"


@query(
    "time_bucket_counts", "W1 T4",
    "SELECT time_bucket(INTERVAL '7 days', datetime) AS week, time_bucket(INTERVAL '4 hours', datetime) AS quarter_day, count(*) AS n FROM price_ts GROUP BY 1, 2",
)
def _(t):
    at = F.col("datetime")
    return t.price_ts.groupBy(time_bucket("1week", at).alias("week"), time_bucket("4hour", at).alias("quarter_day")).agg(F.count("*").alias("n"))


@query("ohlc_1h", "A3", "SELECT * FROM price_1h", OHLC)
def _(t):
    return t.price_1h


@query("ohlc_1d", "A3", "SELECT * FROM price_1d", OHLC)
def _(t):
    return t.price_1d


@query(
    "ohlc_15min", "A5",
    """SELECT price_feed_id, time_bucket(INTERVAL '15 minutes', datetime) AS datetime, avg(CAST(price AS DOUBLE)) AS price_avg,
       max(price) AS price_high, min(price) AS price_low, first(price ORDER BY datetime, block_number) AS price_open,
       last(price ORDER BY datetime, block_number) AS price_close FROM price_ts GROUP BY 1, 2""",
    OHLC,
)
def _(t):
    return ohlc.rollup(t.price_ts, "15min")


_REROLL = """SELECT price_feed_id, time_bucket(INTERVAL '4 hours', datetime) AS datetime, avg(price_avg) AS price_avg, max(price_high) AS price_high,
       min(price_low) AS price_low, first(price_open ORDER BY datetime) AS price_open, last(price_close ORDER BY datetime) AS price_close
       FROM price_1h GROUP BY 1, 2"""


@query("ohlc_4h_from_1h", "A4", _REROLL, OHLC)
def _(t):
    return ohlc.reroll(t.price_1h, "4hour")


@query(
    "ohlc_4h_exact", "A4",
    """SELECT price_feed_id, time_bucket(INTERVAL '4 hours', datetime) AS datetime, avg(CAST(price AS DOUBLE)) AS price_avg,
       max(price) AS price_high, min(price) AS price_low, first(price ORDER BY datetime, block_number) AS price_open,
       last(price ORDER BY datetime, block_number) AS price_close FROM price_ts GROUP BY 1, 2""",
    OHLC,
)
def _(t):
    exact = ohlc.reroll(ohlc.rollup(t.price_ts, "1hour", exact=True), "4hour", exact=True)
    return exact.drop("price_sum", "price_count")


@query(
    "price_series_1h_week", "Q6 F11",
    "SELECT * FROM price_1h WHERE datetime > TIMESTAMP '2024-02-01' - INTERVAL 7 DAY",
    OHLC,
)
def _(t):
    return ohlc.price_series(t.price_ts, "1h_1w", AS_OF)


@query(
    "price_series_4h_quarter", "Q6",
    _REROLL.replace("GROUP BY", "WHERE datetime > TIMESTAMP '2024-02-01' - INTERVAL 90 DAY GROUP BY"),
    OHLC,
)
def _(t):
    return ohlc.price_series(t.price_ts, "4h_3M", AS_OF)


@query("price_series_1d_year", "Q6 Q14", "SELECT * FROM price_1d WHERE datetime > TIMESTAMP '2024-02-01' - INTERVAL 365 DAY", OHLC)
def _(t):
    return ohlc.price_series(t.price_ts, "1d_1Y", AS_OF)


@query(
    "ohlc_compact_rows", "S17",
    """SELECT price_feed_id, datetime, '["' || strftime(datetime, '%Y-%m-%dT%H:%M:%S.%g') || 'Z",' || CAST(price_open AS DOUBLE) || ',' || CAST(price_high AS DOUBLE) || ',' || CAST(price_low AS DOUBLE) || ',' || CAST(price_close AS DOUBLE) || ']' AS "row" FROM price_1d""",
)
def _(t):
    return ohlc.compact(t.price_1d)


@query(
    "first_last_price", "A1 T1 T2",
    """SELECT price_feed_id, first(price ORDER BY datetime, block_number) AS first_price, last(price ORDER BY datetime, block_number) AS last_price,
       last(block_number ORDER BY datetime, block_number) AS last_block FROM price_ts GROUP BY 1""",
    "first_price last_price",
)
def _(t):
    at = ("datetime", "block_number")
    return t.price_ts.groupBy("price_feed_id").agg(
        first_by("price", *at).alias("first_price"), last_by("price", *at).alias("last_price"), last_by("block_number", *at).alias("last_block")
    )


@query(
    "last_keeps_null", "A1 T1",
    """SELECT price_feed_id, last(CASE WHEN block_number % 2 = 0 THEN price END ORDER BY datetime, block_number) AS last_even_price FROM price_ts GROUP BY 1""",
    "last_even_price",
)
def _(t):
    even = t.price_ts.withColumn("price", F.when(F.pmod("block_number", F.lit(2)) == 0, F.col("price")))
    return even.groupBy("price_feed_id").agg(last_by("price", "datetime", "block_number").alias("last_even_price"))


@query(
    "first_price_per_feed", "Q9",
    """SELECT price_feed_id, min(datetime) AS first_datetime, first(block_number ORDER BY datetime, block_number) AS first_block_number,
       first(price ORDER BY datetime, block_number) AS first_price FROM price_ts GROUP BY 1""",
    "first_price",
)
def _(t):
    return valuation.first_prices(t.price_ts)


@query(
    "gapfill_hourly", "W2",
    """SELECT f.price_feed_id, g.datetime, p.price_close AS price FROM (SELECT DISTINCT price_feed_id FROM price_ts WHERE datetime BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25') f
       CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-25', INTERVAL 1 HOUR)) AS datetime) g
       LEFT JOIN (SELECT price_feed_id, time_bucket(INTERVAL '1 hour', datetime) AS datetime, last(price ORDER BY datetime, block_number) AS price_close FROM price_ts
                  WHERE datetime BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' GROUP BY 1, 2) p ON p.price_feed_id = f.price_feed_id AND p.datetime = g.datetime""",
    "price",
)
def _(t):
    return gapfill.gapfill(t.price_ts, ["price_feed_id"], "1hour", F.lit(LO), F.lit(HI), {"price": last_by("price", "datetime", "block_number")})


_GRID = """WITH g AS (
  SELECT f.price_feed_id, g.datetime, p.price FROM (SELECT DISTINCT price_feed_id FROM price_ts WHERE datetime BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25') f
  CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-25', INTERVAL 15 MINUTE)) AS datetime) g
  LEFT JOIN (SELECT price_feed_id, time_bucket(INTERVAL '15 minutes', datetime) AS datetime, last(price ORDER BY datetime, block_number) AS price FROM price_ts
             WHERE datetime BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' GROUP BY 1, 2) p ON p.price_feed_id = f.price_feed_id AND p.datetime = g.datetime)"""


def _quarter_hours(t):
    return gapfill.gapfill(t.price_ts, ["price_feed_id"], "15min", F.lit(LO), F.lit(HI), {"price": last_by("price", "datetime", "block_number")})


@query(
    "carry_forward_15min", "W3 A27",
    f"""SELECT price_feed_id, datetime, last_value(price IGNORE NULLS) OVER (PARTITION BY price_feed_id ORDER BY datetime ROWS UNBOUNDED PRECEDING) AS price
       FROM ({_GRID} SELECT * FROM g)""",
    "price",
)
def _(t):
    return gapfill.locf(_quarter_hours(t), ["price_feed_id"], ["price"])


@query(
    "interpolate_15min", "W4",
    f"""SELECT price_feed_id, datetime, CASE WHEN price IS NOT NULL THEN CAST(price AS DOUBLE) WHEN nt > pt THEN pv + (nv - pv) * epoch_us(datetime - pt) / epoch_us(nt - pt) END AS price FROM (
       SELECT *, last_value(CASE WHEN price IS NOT NULL THEN datetime END IGNORE NULLS) OVER b AS pt, last_value(CAST(price AS DOUBLE) IGNORE NULLS) OVER b AS pv,
              first_value(CASE WHEN price IS NOT NULL THEN datetime END IGNORE NULLS) OVER a AS nt, first_value(CAST(price AS DOUBLE) IGNORE NULLS) OVER a AS nv
       FROM ({_GRID} SELECT * FROM g)
       WINDOW b AS (PARTITION BY price_feed_id ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
              a AS (PARTITION BY price_feed_id ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
    "price",
)
def _(t):
    return gapfill.interpolate(_quarter_hours(t), ["price_feed_id"], "price")


_BLOCK_GRID = """
  SELECT c.chain, g.datetime, b.block_number FROM (SELECT DISTINCT chain FROM blocks WHERE datetime BETWEEN (SELECT min(datetime) FROM blocks) - INTERVAL 1 HOUR AND TIMESTAMP '2024-02-01' - INTERVAL 1 HOUR) c
  CROSS JOIN (SELECT unnest(generate_series(time_bucket(INTERVAL '1 hour', (SELECT min(datetime) FROM blocks) - INTERVAL 1 HOUR), TIMESTAMP '2024-02-01' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS datetime) g
  LEFT JOIN (SELECT chain, time_bucket(INTERVAL '1 hour', datetime) AS datetime, last(block_number ORDER BY datetime, block_number) AS block_number FROM blocks GROUP BY 1, 2) b
    ON b.chain = c.chain AND b.datetime = g.datetime"""

_BLOCK_LINE = """
   SELECT *, CASE WHEN block_number IS NOT NULL THEN CAST(block_number AS DOUBLE) WHEN nt > pt THEN pv + (nv - pv) * epoch_us(datetime - pt) / epoch_us(nt - pt) END AS interpolated_block_number
   FROM (SELECT *, last_value(CASE WHEN block_number IS NOT NULL THEN datetime END IGNORE NULLS) OVER b AS pt, last_value(CAST(block_number AS DOUBLE) IGNORE NULLS) OVER b AS pv,
           {edge_t} AS nt, {edge_v} AS nv
         FROM ({grid}) {join}
         WINDOW b AS (PARTITION BY chain ORDER BY datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                a AS (PARTITION BY chain ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
_NEXT_T = "first_value(CASE WHEN block_number IS NOT NULL THEN datetime END IGNORE NULLS) OVER a"
_NEXT_V = "first_value(CAST(block_number AS DOUBLE) IGNORE NULLS) OVER a"


@query(
    "block_list_hourly", "W7 A30",
    "SELECT chain, datetime, block_number, interpolated_block_number FROM ("
    + _BLOCK_LINE.format(edge_t=_NEXT_T, edge_v=_NEXT_V, grid=_BLOCK_GRID, join="")
    + ") WHERE interpolated_block_number IS NOT NULL",
    "interpolated_block_number",
)
def _(t):
    return valuation.block_list(t.blocks, "1hour", AS_OF)


@query(
    "block_list_with_latest", "W4b W7",
    "SELECT chain, datetime, block_number, interpolated_block_number FROM ("
    + _BLOCK_LINE.format(
        edge_t=f"coalesce({_NEXT_T}, TIMESTAMP '2024-02-01')",
        edge_v=f"coalesce({_NEXT_V}, CAST(m AS DOUBLE))",
        grid=_BLOCK_GRID,
        join="JOIN (SELECT chain, max(block_number) + 50 AS m FROM blocks GROUP BY 1) USING (chain)",
    )
    + ") WHERE interpolated_block_number IS NOT NULL AND datetime >= TIMESTAMP '2024-01-10'",
    "interpolated_block_number",
)
def _(t):
    latest = t.blocks.groupBy("chain").agg(F.lit(AS_OF).alias("latest_datetime"), (F.max("block_number") + 50).alias("latest_block_number"))
    return valuation.block_list(t.blocks, "1hour", AS_OF, latest, first_date=F.lit(datetime(2024, 1, 10)))


_PROBES = "SELECT event_id, CAST(event_id % 5 + 1 AS INT) AS price_feed_id, ts AS datetime FROM events"


def _probes(t):
    return t.raw("events").select("event_id", (F.pmod("event_id", F.lit(5)) + 1).cast("int").alias("price_feed_id"), F.col("ts").alias("datetime"))


@query(
    "same_bucket_price", "J8 T9",
    f"""SELECT e.event_id, q.price AS match_price, q.block_number AS match_block_number FROM ({_PROBES}) e
       LEFT JOIN price_15m q ON q.price_feed_id = e.price_feed_id AND q.bucket = time_bucket(INTERVAL '15 minutes', e.datetime)""",
    "match_price",
)
def _(t):
    return asof.same_bucket(_probes(t), t.price_ts).select("event_id", "match_price", "match_block_number")


@query(
    "nearest_price_10min", "J9",
    f"""SELECT event_id, near_datetime, near_price, near_block_number FROM (
         SELECT e.event_id, q.datetime AS near_datetime, q.price AS near_price, q.block_number AS near_block_number,
                row_number() OVER (PARTITION BY e.event_id ORDER BY abs(epoch_us(q.datetime) - epoch_us(e.datetime)), q.datetime, q.block_number) AS rn
         FROM ({_PROBES}) e LEFT JOIN price_ts q ON q.price_feed_id = e.price_feed_id
              AND q.datetime BETWEEN e.datetime - INTERVAL 10 MINUTE AND e.datetime + INTERVAL 10 MINUTE) WHERE rn = 1""",
    "near_price",
)
def _(t):
    near = asof.nearest(_probes(t), t.price_ts, "price_feed_id", F.expr("INTERVAL 10 MINUTE"), ["price", "block_number"])
    return near.select("event_id", "near_datetime", "near_price", "near_block_number")


@query(
    "nearest_block_1h", "J10 T22",
    """SELECT o_orderkey, chain, near_block_number FROM (
         SELECT o.o_orderkey, o.chain, b.block_number AS near_block_number,
                row_number() OVER (PARTITION BY o.o_orderkey ORDER BY abs(epoch_us(b.datetime) - epoch_us(o.datetime)), b.datetime, b.block_number) AS rn
         FROM (SELECT o_orderkey, (['click','error','purchase','signup','view'])[CAST(o_orderkey % 5 AS INT) + 1] AS chain, TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 46080) AS datetime FROM orders) o
         LEFT JOIN blocks b ON b.chain = o.chain AND b.datetime BETWEEN o.datetime - INTERVAL 1 HOUR AND o.datetime + INTERVAL 1 HOUR) WHERE rn = 1""",
)
def _(t):
    from tidemark.sources.standins import _chain_of

    asked = t.raw("orders").select(
        "o_orderkey",
        _chain_of(F.col("o_orderkey")).alias("chain"),
        F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.pmod("o_orderkey", F.lit(46080)) * 60).alias("datetime"),
    )
    near = asof.nearest(asked, t.blocks, "chain", F.expr("INTERVAL 1 HOUR"), ["block_number"])
    return near.select("o_orderkey", "chain", "near_block_number")


_AROUND = """SELECT {key}, datetime, CAST(round(epoch_us(datetime - TIMESTAMP '2024-01-16 12:00:00') / 1e6) AS INT) AS diff_sec, {value} FROM (
   SELECT *, row_number() OVER (PARTITION BY {key}, datetime > TIMESTAMP '2024-01-16 12:00:00' ORDER BY abs(epoch_us(datetime - TIMESTAMP '2024-01-16 12:00:00')), block_number) AS rn
   FROM {table} WHERE datetime BETWEEN TIMESTAMP '2024-01-16 12:00:00' - INTERVAL 1 DAY AND TIMESTAMP '2024-01-16 12:00:00' + INTERVAL 1 DAY) WHERE rn <= {k}"""


@query("blocks_around_instant", "J11 Q22 F6 L3", _AROUND.format(key="chain", value="block_number", table="blocks", k=5))
def _(t):
    found = asof.around(t.blocks, F.lit(MID), "1day", 5, ["chain"])
    return found.orderBy(F.abs("diff_sec")).select("chain", "datetime", "diff_sec", "block_number")


@query("one_block_each_side", "J12", _AROUND.format(key="chain", value="block_number", table="blocks", k=1))
def _(t):
    return asof.around(t.blocks, F.lit(MID), "1day", 1, ["chain"]).select("chain", "datetime", "diff_sec", "block_number")


@query("prices_around_instant", "J11 Q22", _AROUND.format(key="price_feed_id", value="price", table="price_ts", k=10), "price")
def _(t):
    return asof.around(t.price_ts, F.lit(MID), "1day", 10, ["price_feed_id"]).select("price_feed_id", "datetime", "diff_sec", "price")


@query(
    "first_block_at_or_above", "L4",
    """SELECT chain, min(datetime) AS datetime, first(block_number ORDER BY datetime, block_number) AS block_number FROM blocks
       WHERE block_number >= (SELECT max(block_number) // 2 FROM blocks) GROUP BY 1""",
)
def _(t):
    half = t.blocks.agg(F.floor(F.max("block_number") / 2)).scalar()
    return asof.first_at_or_above(t.blocks, half)


@query(
    "interpolated_price_at_event", "W6",
    """WITH e AS (SELECT event_id, CAST(event_id % 5 + 1 AS INT) AS f, ts, time_bucket(INTERVAL '15 minutes', ts) AS b FROM events),
       a AS (SELECT e.event_id, e.b, time_bucket(INTERVAL '15 minutes', p.datetime) AS tb, avg(CAST(p.price AS DOUBLE)) AS v
             FROM e JOIN price_ts p ON p.price_feed_id = e.f AND p.datetime BETWEEN e.ts - INTERVAL 3 DAY AND e.ts + INTERVAL 3 DAY GROUP BY 1, 2, 3),
       n AS (SELECT event_id, b, arg_max(v, tb) FILTER (WHERE tb <= b) AS pv, max(tb) FILTER (WHERE tb <= b) AS pt, arg_min(v, tb) FILTER (WHERE tb >= b) AS nv, min(tb) FILTER (WHERE tb >= b) AS nt
             FROM a GROUP BY 1, 2)
       SELECT e.event_id, CASE WHEN pt = n.b THEN pv WHEN nt > pt THEN pv + (nv - pv) * epoch_us(n.b - pt) / epoch_us(nt - pt) END AS interpolated_price FROM e LEFT JOIN n USING (event_id)""",
    "interpolated_price",
)
def _(t):
    return asof.interpolated_price(_probes(t), t.price_ts).select("event_id", "interpolated_price")


@query(
    "raw_prices_newest", "L2 L6",
    """SELECT price_feed_id, datetime, block_number, price FROM (SELECT *, row_number() OVER (PARTITION BY price_feed_id ORDER BY datetime DESC, block_number DESC) AS rn FROM price_ts) WHERE rn <= 100""",
    "price",
)
def _(t):
    return top_per_key(t.price_ts, ["price_feed_id"], [F.col("datetime").desc(), F.col("block_number").desc()], 100).select(
        "price_feed_id", "datetime", "block_number", "price"
    )


@query(
    "raw_prices_limited", "L1 L2 S4",
    """SELECT price_feed_id, datetime, block_number, price FROM price_ts WHERE datetime >= TIMESTAMP '2024-01-05' AND datetime < TIMESTAMP '2024-01-25' ORDER BY datetime, block_number LIMIT 1000""",
    "price",
)
def _(t):
    window = t.price_ts.filter((F.col("datetime") >= F.lit(LO)) & (F.col("datetime") < F.lit(HI)))
    return window.orderBy("datetime", "block_number").limit(1000).select("price_feed_id", "datetime", "block_number", "price")


@query(
    "feed_tick_listing", "Q13 J2 P20",
    """SELECT p.datetime, f.feed_key, p.block_number, p.price, CAST(CAST(CAST(p.price AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS VARCHAR) AS price_txt FROM price_ts p LEFT JOIN feeds f USING (price_feed_id) ORDER BY 1""",
    "price",
)
def _(t):
    return portfolio.feed_ticks(t.price_ts, t.feeds).orderBy("datetime")


@query(
    "share_rate_ticks_newest", "Q13",
    "SELECT l.datetime, f.feed_key, l.block_number, l.price, CAST(CAST(CAST(l.price AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS VARCHAR) AS price_txt FROM (SELECT datetime, block_number, block_number % 8 % 5 + 1 AS price_feed_id, 1.0 + block_number % 10 / 100.0::DOUBLE AS price FROM ledger_diffs) l LEFT JOIN feeds f USING (price_feed_id)",
    "price",
)
def _(t):
    return portfolio.feed_ticks(t.share_rates, t.feeds).orderBy(F.col("datetime").desc(), F.col("block_number").desc())


ASKED = f"vault:view:0x{4:040x}"  # the listing is of one product, looked up by its key


def _hops(period: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {hop} AS hop, p.product_id, r.* FROM price_1{period} r JOIN products p ON p.price_feed_{hop}_id = r.price_feed_id WHERE p.product_key = '{ASKED}'" for hop in (1, 2)
    )


def _listed(t, rolled):
    """Both feeds of the product."""
    asked = portfolio.select_products(t.products, key=ASKED)
    sides = [asked.select(F.lit(hop).alias("hop"), "product_id", F.col(f"price_feed_{hop}_id").alias("price_feed_id")) for hop in (1, 2)]
    return sides[0].unionByName(sides[1]).join(rolled, "price_feed_id").orderBy("hop", "product_id", "datetime")


@query("rollup_listing_hops", "Q14", _hops("d"), OHLC)
def _(t):
    return _listed(t, t.price_1d)


@query("rollup_listing_hops_1h", "Q14", _hops("h"), OHLC)
def _(t):
    return _listed(t, t.price_1h)


@query(
    "product_ticks_through_feeds", "Q15",
    """SELECT 1 AS hop, p.product_id, count(*) AS ticks, sum(CAST(t.price AS DOUBLE)) AS total FROM price_ts t JOIN products p ON p.price_feed_1_id = t.price_feed_id GROUP BY 2
       UNION ALL SELECT 2, p.product_id, count(*), sum(CAST(t.price AS DOUBLE)) FROM price_ts t JOIN products p ON p.price_feed_2_id = t.price_feed_id GROUP BY 2""",
    "total",
)
def _(t):
    # summed per feed before the join, as a feed's ticks would repeat for each of its products
    per_feed = t.price_ts.groupBy("price_feed_id").agg(F.count("*").alias("ticks"), F.sum(F.col("price").cast("double")).alias("total"))
    hop = lambda n: t.products.select("product_id", F.col(f"price_feed_{n}_id").alias("price_feed_id")).join(per_feed, "price_feed_id").select(
        F.lit(n).alias("hop"), "product_id", "ticks", "total"
    )
    return hop(1).unionByName(hop(2))


@query("raw_prices_per_feed", "S6 U1", "SELECT price_feed_id, count(*) AS n, min(datetime) AS lo, max(datetime) AS hi FROM price_ts GROUP BY 1")
def _(t):
    return keep_first(t.price_ts, ["price_feed_id", "block_number", "datetime"], ["price"]).groupBy("price_feed_id").agg(
        F.count("*").alias("n"), F.min("datetime").alias("lo"), F.max("datetime").alias("hi")
    )


@query(
    "ms_per_block", "A32",
    "SELECT chain, (epoch_us(last(datetime ORDER BY block_number) - first(datetime ORDER BY block_number)) / 1000.0) / (max(block_number) - min(block_number)) AS ms_per_block FROM blocks GROUP BY 1",
    "ms_per_block",
)
def _(t):
    return monitoring.ms_per_block(t.blocks)


@query(
    "chain_block_facts", "A14 A28 A29 A30 F7",
    """SELECT chain, strftime(min(datetime), '%Y-%m-%dT%H:%M:%SZ') AS first_date, max(block_number) AS latest_block, count(*) AS blocks FROM blocks GROUP BY 1""",
)
def _(t):
    return t.blocks.groupBy("chain").agg(
        F.date_format(F.min("datetime"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("first_date"),
        F.max("block_number").alias("latest_block"),
        F.count("*").alias("blocks"),
    )


@query(
    "rounded_epoch_seconds", "F6 F10",
    "SELECT event_id, CAST(round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-16 12:00:00')) / 1e6) AS INT) AS diff_sec FROM events",
)
def _(t):
    from tidemark.functions.timegrid import iso_to_timestamp

    return t.raw("events").select("event_id", epoch_seconds_between(F.col("ts"), iso_to_timestamp(F.lit("2024-01-16T14:00:00.000+02:00"))).alias("diff_sec"))


_TICK_JOIN = """SELECT p.chain, l.investor_id, l.datetime, l.block_number, l.balance, l.balance_diff, 1.0 + l.block_number % 10 / 100.0::DOUBLE AS ppfs, l.transaction_hash AS trx_hash, p.product_key, p.display_id AS product_name
       FROM ledger l JOIN products p USING (product_id)"""


@query("exact_tick_join", "J14 Q8", _TICK_JOIN, "balance balance_diff ppfs")
def _(t):
    return portfolio.transactions(t.ledger, t.products, t.share_rates).orderBy(F.col("datetime").desc())


TICK = ["price_feed_1_id", "datetime", "block_number"]


def bucketed_rows_and_ticks(t, buckets=8):
    """The ledger with its feed, and the feed's ticks, laid out by the keys on which they meet."""
    rows = t.ledger.join(t.products.select("product_id", "price_feed_1_id"), "product_id")
    ticks = t.share_rates.select(F.col("price_feed_id").alias("price_feed_1_id"), "datetime", "block_number", F.col("price").alias("ppfs"))
    return bucketed.write(rows, "ledger", TICK, buckets), bucketed.write(ticks, "ticks", TICK, buckets)


def bucketed_tick_join(t):
    rows, ticks = bucketed_rows_and_ticks(t)
    return rows.join(ticks.hint("merge"), TICK, "left")


@query("exact_tick_join_bucketed", "J14 J8", "SELECT investor_id, product_id, datetime, block_number, balance, 1.0 + block_number % 10 / 100.0::DOUBLE AS ppfs FROM ledger JOIN products USING (product_id)", "balance ppfs")
def _(t):
    return bucketed_tick_join(t).select("investor_id", "product_id", "datetime", "block_number", "balance", "ppfs")
