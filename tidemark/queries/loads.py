"""Landing, decoding, netting and upserting."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import evm, wide
from tidemark.functions.hexbytes import to_hex_text
from tidemark.operators import transfers as tr
from tidemark.operators import upsert as up
from tidemark.operators.latest import keep_first
from tidemark.plans import coverage as cov
from tidemark.plans import valuation
from tidemark.queries.registry import query
from tidemark.session import scratch_path
from tidemark.sources import readers
from tidemark.sources.standins import _address, _sql_addr

AS_OF = datetime(2024, 2, 1)
LINE = ["l_orderkey", "l_linenumber"]


def event_logs(t):
    """Events as a landed log: purchases and views are transfers, signups stakes, the rest withdrawals."""
    kind = F.col("event_type")
    topic0 = (
        F.when(kind.isin("purchase", "view"), F.lit(evm.TRANSFER_TOPIC))
        .when(kind == "signup", F.lit(evm.STAKED_TOPIC))
        .when(kind == "click", F.lit(evm.WITHDRAWN_TOPIC))
        .otherwise(F.lit("0x" + "ab" * 32))
    )
    owner = evm.address_topic(_address(F.pmod("user_id", F.lit(25))))
    other = evm.address_topic(_address(F.pmod(F.col("user_id") + F.col("event_id"), F.lit(25))))
    amount = F.round(F.col("value") * 100).cast("bigint") * F.lit(10**12)
    return t.raw("events").select(
        kind.alias("chain"),
        F.concat(F.lit("0x"), F.upper(F.substring(_address(F.pmod("event_id", F.lit(4)) + 1000), 3, 40))).alias("address"),
        F.floor(F.col("event_id") / 8).cast("bigint").alias("block_number"),
        (F.pmod("event_id", F.lit(50)) == 49).alias("removed"),
        F.md5(F.col("event_id").cast("string")).alias("transaction_hash"),
        F.col("event_id").alias("log_index"),
        F.when(kind.isin("purchase", "view"), F.array(topic0, owner, other)).otherwise(F.array(topic0, owner)).alias("topics"),
        evm.uint256_word(amount).alias("data"),
    )


def log_products(t):
    """Four contracts per chain; the odd ones are staking contracts."""
    key = F.col("k")
    return (
        t.blocks.select("chain").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .select("chain", _address(key + 1000).alias("contract_address"), key.alias("product_id"), F.lit(14).alias("decimals"), (F.pmod(key, F.lit(2)) == 1).alias("stakes"))
    )


_LOGS = f"""SELECT event_type AS chain, {_sql_addr('(event_id % 4 + 1000)')} AS token_address, event_id % 4 AS product_id, event_id // 8 AS block_number, event_id % 50 = 49 AS removed,
   md5(CAST(event_id AS VARCHAR)) AS transaction_hash, event_id AS log_index, {_sql_addr('(user_id % 25)')} AS owner, {_sql_addr('((user_id + event_id) % 25)')} AS other,
   CASE WHEN event_type IN ('purchase','view') THEN 'Transfer' WHEN event_type = 'signup' THEN 'Staked' WHEN event_type = 'click' THEN 'Withdrawn' END AS event_name,
   CAST(round(value * 100) AS DECIMAL(38,0)) AS cents FROM events"""
_KEPT = f"SELECT * FROM ({_LOGS}) WHERE NOT removed AND CASE WHEN product_id % 2 = 1 THEN event_name IN ('Staked','Withdrawn') ELSE event_name = 'Transfer' END"
_LEGS = f"""SELECT chain, token_address, product_id, owner AS owner_address, block_number, transaction_hash, log_index, CAST(CASE event_name WHEN 'Staked' THEN cents ELSE -cents END AS DECIMAL(38,18)) / 100 AS amount FROM ({_KEPT})
   UNION ALL SELECT chain, token_address, product_id, other, block_number, transaction_hash, log_index, CAST(cents AS DECIMAL(38,18)) / 100 FROM ({_KEPT}) WHERE event_name = 'Transfer'"""


def landed_logs(t):
    """The event log as a landed table, read back with its fixed schema."""
    path = scratch_path(t.spark, "logs")
    event_logs(t).write.parquet(path)
    return readers.event_log(t.spark, path)


def usable_events(t):
    good, _ = tr.split_decodable(tr.decode(landed_logs(t)))
    fit, _ = tr.split_scalable(tr.relevant(good, log_products(t)))
    return fit


def oversized_logs(t):
    """The event log with amounts that are too large: every 17th event for token units, every 19th for any number."""
    nth = lambda k: F.pmod("log_index", F.lit(k)) == 0
    huge = F.when(nth(19), F.lit("0x" + "f" * 64)).when(nth(17), F.lit("0x" + f"{10**34:064x}"))
    return event_logs(t).withColumn("data", F.coalesce(huge, F.col("data")))


DECODED_LOGS = f"""SELECT log_index, event_name, owner AS first_party, CASE WHEN event_name = 'Transfer' THEN other END AS second_party, CAST(cents * 1000000000000 AS BIGINT) AS amount FROM ({_LOGS}) WHERE event_name IS NOT NULL"""


@query("decoded_logs", "D1 S1", DECODED_LOGS)
def _(t):
    good, _ = tr.split_decodable(tr.decode(landed_logs(t)))
    return good.select("log_index", "event_name", "first_party", "second_party", "amount")


@query("undecodable_logs", "D1 ST10", f"SELECT chain, count(*) AS n FROM ({_LOGS}) WHERE event_name IS NULL GROUP BY 1")
def _(t):
    _, bad = tr.split_decodable(tr.decode(landed_logs(t)))
    return bad.groupBy("chain").agg(F.count("*").alias("n"))


_SIZE = "CASE WHEN event_name IS NULL THEN 'unknown event' WHEN log_index % 19 = 0 OR log_index % 17 = 0 AND kept THEN 'amount out of range' END"
_OVERSIZED = f"SELECT *, {_SIZE} AS reason FROM (SELECT *, NOT removed AND CASE WHEN product_id % 2 = 1 THEN event_name IN ('Staked','Withdrawn') ELSE event_name = 'Transfer' END AS kept FROM ({_LOGS}))"


def split_oversized(t):
    good, bad = tr.split_decodable(tr.decode(oversized_logs(t)))
    fit, unfit = tr.split_scalable(tr.relevant(good, log_products(t)))
    return fit, bad.select("chain", "reason", "block_number").unionByName(unfit.select("chain", "reason", "block_number"))


@query(
    "quarantined_events", "D1 D3 P13 ST10",
    f"SELECT chain, reason, count(*) AS n, min(block_number) AS first_block FROM ({_OVERSIZED}) WHERE reason IS NOT NULL GROUP BY 1, 2",
)
def _(t):
    _, bad = split_oversized(t)
    return bad.groupBy("chain", "reason").agg(F.count("*").alias("n"), F.min("block_number").alias("first_block"))


@query(
    "quarantine_to_retries", "ST10 I12 I13",
    f"""WITH p AS (SELECT DISTINCT chain AS import_key, block_number AS d FROM ({_OVERSIZED}) WHERE reason IS NOT NULL)
        SELECT import_key, 'covered' AS kind, 0 AS "from", max(event_id // 8) AS "to" FROM (SELECT event_type AS import_key, event_id FROM events) GROUP BY 1
        UNION ALL SELECT import_key, 'retry', min(d), max(d) FROM (SELECT *, d - row_number() OVER (PARTITION BY import_key ORDER BY d) AS g FROM p) GROUP BY import_key, g""",
)
def _(t):
    # a chain's log is imported up to its last block; blocks with an event in quarantine count as failed and wait for a retry
    _, bad = split_oversized(t)
    latest = event_logs(t).groupBy(F.col("chain").alias("import_key")).agg(F.max("block_number").alias("to"))
    good = latest.select("import_key", F.lit(0).cast("long").alias("from"), "to", F.lit(True).alias("success"), F.col("to").alias("latest"))
    block = F.col("block_number")
    failed = bad.select(F.col("chain").alias("import_key"), block.alias("from"), block.alias("to"), F.lit(False).alias("success"), block.alias("latest"))
    _, ranges = cov.fold_results(t.states.limit(0), t.coverage.limit(0), good.unionByName(failed.distinct()), AS_OF, 1024)
    return ranges


@query(
    "net_beside_quarantine", "D3 P13 A26",
    f"""SELECT owner_address, sum(amount) AS amount_transferred FROM (
       SELECT owner AS owner_address, CAST(CASE event_name WHEN 'Staked' THEN cents ELSE -cents END AS DECIMAL(38,18)) / 100 AS amount FROM ({_OVERSIZED}) WHERE kept AND reason IS NULL
       UNION ALL SELECT other, CAST(cents AS DECIMAL(38,18)) / 100 FROM ({_OVERSIZED}) WHERE kept AND reason IS NULL AND event_name = 'Transfer') GROUP BY 1 HAVING sum(amount) <> 0""",
    "amount_transferred",
)
def _(t):
    fit, _ = split_oversized(t)
    return tr.net(tr.to_legs(fit), ["owner_address"]).select("owner_address", "amount_transferred")


# --- amounts of any size: 77 digits, one event in 19 moves exactly 2^255, one in 23 has a word that is none ------------

_THIRDS = (57896044618658097, 711785492504343953926634992332, 820282019728792003956564819968)  # 2^255 by 30 digits


def wide_logs(t):
    """The event log with 256-bit amounts, and words that are cut off."""
    nth, wide_text = lambda k: F.pmod("log_index", F.lit(k)) == 0, lambda x, n: F.lpad(x.cast("string"), n, "0")
    key = F.col("event_id")
    thirds = [
        (key * 7919 + 13) % F.lit(50_000_000_000_000_000),
        F.round(F.col("value") * 100).cast("decimal(20,0)") * F.lit(10**15).cast("decimal(16,0)") + key,
        (key * 104_729) % 1_000_000_007,
    ]
    made = F.concat(*(wide_text(x, 30) for x in thirds))
    amounts = t.raw("events").select(F.col("event_id").alias("log_index"), made.alias("made"))
    whole = F.when(nth(19), F.lit(str(2**255))).otherwise(F.col("made"))
    word = F.when(nth(23), F.lit("0x12")).otherwise(wide.to_word(wide.from_text(whole)))
    return event_logs(t).join(amounts, "log_index").withColumn("data", word).drop("made")


_WIDE = f"""SELECT *, CASE WHEN log_index % 19 = 0 THEN {_THIRDS[0]}::HUGEINT ELSE (log_index * 7919 + 13) % 50000000000000000 END AS p2,
   CASE WHEN log_index % 19 = 0 THEN {_THIRDS[1]}::HUGEINT ELSE CAST(cents AS HUGEINT) * 1000000000000000 + log_index END AS p1,
   CASE WHEN log_index % 19 = 0 THEN {_THIRDS[2]}::HUGEINT ELSE (log_index * 104729) % 1000000007 END AS p0 FROM ({_LOGS})"""
_WIDE_KEPT = f"SELECT * FROM ({_WIDE}) WHERE NOT removed AND log_index % 23 <> 0 AND CASE WHEN product_id % 2 = 1 THEN event_name IN ('Staked','Withdrawn') ELSE event_name = 'Transfer' END"
_WIDE_LEGS = f"""SELECT chain, token_address, product_id, owner AS owner_address, block_number, transaction_hash, log_index, s * p2 AS p2, s * p1 AS p1, s * p0 AS p0, s AS side
   FROM (SELECT *, CASE event_name WHEN 'Staked' THEN 1 ELSE -1 END AS s FROM ({_WIDE_KEPT}))
   UNION ALL SELECT chain, token_address, product_id, other, block_number, transaction_hash, log_index, p2, p1, p0, 1 FROM ({_WIDE_KEPT}) WHERE event_name = 'Transfer'"""


def _wide_text(rows: str, decimals: str, shown: str, out: str) -> str:
    """SQL for the text of p2 * 10^60 + p1 * 10^30 + p0, sums of any sign: carries, the sign, the digits."""
    m = f"{10**30}::HUGEINT"
    rest, carry = (lambda x: f"((({x}) % {m} + {m}) % {m})"), lambda x: f"((({x}) - ((({x}) % {m} + {m}) % {m})) // {m})"
    return f"""SELECT {shown}, CASE WHEN neg THEN '-' ELSE '' END || CASE WHEN ltrim(left(d, 90 - k), '0') = '' THEN '0' ELSE ltrim(left(d, 90 - k), '0') END || CASE WHEN k > 0 THEN '.' || right(d, k) ELSE '' END AS {out}
       FROM (SELECT *, lpad(CAST(t2 + {carry('t1 + ' + carry('t0'))} AS VARCHAR), 30, '0') || lpad(CAST({rest('t1 + ' + carry('t0'))} AS VARCHAR), 30, '0') || lpad(CAST({rest('t0')} AS VARCHAR), 30, '0') AS d
       FROM (SELECT *, CASE WHEN neg THEN -p2 ELSE p2 END AS t2, CASE WHEN neg THEN -p1 ELSE p1 END AS t1, CASE WHEN neg THEN -p0 ELSE p0 END AS t0
       FROM (SELECT *, CAST({decimals} AS INT) AS k, p2 + {carry('p1 + ' + carry('p0'))} < 0 AS neg FROM ({rows}))))"""


def wide_events(t):
    good, _ = tr.split_decodable(tr.decode_wide(wide_logs(t)))
    return tr.relevant(good, log_products(t))


@query("wide_signed_legs", "D1 D3 P13 T3", _wide_text(_WIDE_LEGS, "14", "chain, owner_address, block_number, log_index, side", "amount"))
def _(t):
    legs = tr.to_wide_legs(wide_events(t))
    text = wide.text(F.col("amount_transferred"), F.col("token_decimals"))
    side = F.when(text.startswith("-"), -1).otherwise(1).cast("int")
    return legs.select("chain", "owner_address", "block_number", "log_index", side.alias("side"), text.alias("amount"))


_WIDE_SUMS = "sum(p2) AS p2, sum(p1) AS p1, sum(p0) AS p0"
_NOT_ZERO = "HAVING sum(p2) <> 0 OR sum(p1) <> 0 OR sum(p0) <> 0"


@query(
    "wide_net_transfers", "D1 D2 D3 P13 A26 T3 T19",
    _wide_text(
        f"""SELECT chain, token_address, owner_address, block_number, max(log_index) AS log_index, {_WIDE_SUMS},
            coalesce(last(transaction_hash ORDER BY log_index) FILTER (WHERE p2 <> 0 OR p1 <> 0 OR p0 <> 0), last(transaction_hash ORDER BY log_index)) AS transaction_hash
            FROM ({_WIDE_LEGS}) GROUP BY 1, 2, 3, 4 {_NOT_ZERO}""",
        "14", "chain, token_address, owner_address, block_number, log_index, transaction_hash", "amount_transferred",
    ),
)
def _(t):
    netted = tr.net_wide(tr.to_wide_legs(wide_events(t)))
    return netted.withColumn("amount_transferred", wide.text(F.col("amount_transferred"), 14))


@query(
    "wide_net_by_owner", "D3 P13 A26 T3",
    _wide_text(f"SELECT owner_address, {_WIDE_SUMS} FROM ({_WIDE_LEGS}) GROUP BY 1 {_NOT_ZERO}", "14", "owner_address", "amount_transferred"),
)
def _(t):
    netted = tr.net_wide(tr.to_wide_legs(wide_events(t)), ["owner_address"])
    return netted.select("owner_address", wide.text(F.col("amount_transferred"), 14).alias("amount_transferred"))


@query(
    "wide_balances", "W9 D3 A26 T3",
    _wide_text(
        f"""SELECT owner_address, log_index, side, sum(p2) OVER w AS p2, sum(p1) OVER w AS p1, sum(p0) OVER w AS p0 FROM ({_WIDE_LEGS})
            WINDOW w AS (PARTITION BY owner_address ORDER BY log_index, side ROWS UNBOUNDED PRECEDING)""",
        "14", "owner_address, log_index, side", "balance",
    ),
)
def _(t):
    # an owner's balance over all tokens after each leg; of a transfer to oneself the giving comes first
    legs = tr.to_wide_legs(wide_events(t))
    side = F.when(wide.to_double(F.col("amount_transferred")) < 0, -1).otherwise(1).cast("int")
    held = tr.wide_running_balance(legs.withColumn("side", side), ["owner_address"], ["log_index", "side"], F.floor(F.col("log_index") / 4096))
    return held.select("owner_address", "log_index", "side", wide.text(F.col("balance"), 14).alias("balance"))


@query(
    "wide_quarantine", "D1 ST10",
    f"SELECT chain, CASE WHEN event_name IS NULL THEN 'unknown event' ELSE 'no amount' END AS reason, count(*) AS n FROM ({_LOGS}) WHERE event_name IS NULL OR log_index % 23 = 0 GROUP BY 1, 2",
)
def _(t):
    # nothing is in quarantine for its size
    _, bad = tr.split_decodable(tr.decode_wide(wide_logs(t)))
    return bad.groupBy("chain", "reason").agg(F.count("*").alias("n"))


@query("wide_scaled_amounts", "P13 T3", _wide_text(f"SELECT log_index, p2, p1, p0 FROM ({_WIDE}) WHERE log_index % 23 <> 0", "log_index % 31", "log_index", "amount"))
def _(t):
    read = wide.from_word(F.col("data"))
    amounts = wide_logs(t).select("log_index", read.alias("n")).filter(wide.known(F.col("n")))
    return amounts.select("log_index", wide.text(F.col("n"), F.pmod("log_index", F.lit(31)).cast("int")).alias("amount"))


@query(
    "wide_vault_statistics", "D15 P13 P14 P15 T3",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(round(l_quantity * 100) AS BIGINT) AS VARCHAR) || repeat('0', 46) || '.' || repeat('0', 24) AS staked_underlying,
       CASE WHEN l_partkey % 10 <> 9 THEN 0.5 END AS underlying_capture_percentage, round(1 + l_tax, 2) AS share_to_underlying_price FROM lineitem""",
    "underlying_capture_percentage share_to_underlying_price",
)
def _(t):
    # supplies of 70 digits and more, of tokens with 24 decimals
    cents = F.round(F.col("l_quantity") * 100).cast("bigint")
    raw = lambda c: wide.from_text(F.concat(c.cast("string"), F.lit("0" * 70)))
    price = wide.from_text(F.concat(F.round((1 + F.col("l_tax")) * 100).cast("bigint").cast("string"), F.lit("0" * 40)))
    read = t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", raw(cents).alias("staked"), price.alias("price"),
        raw(F.when(F.pmod("l_partkey", F.lit(10)) == 9, F.lit(0)).otherwise(cents * 2)).alias("whole"),
    )
    staked, whole = F.col("staked"), F.col("whole")
    return read.select(
        "l_orderkey", "l_linenumber", wide.text(staked, 24).alias("staked_underlying"),
        F.when(~wide.is_zero(whole), wide.to_double(staked) / wide.to_double(whole)).alias("underlying_capture_percentage"),
        F.round(wide.to_double(F.col("price"), 42), 2).alias("share_to_underlying_price"),
    )


@query("relevant_events", "D2", f"SELECT log_index, product_id, event_name FROM ({_KEPT})")
def _(t):
    return usable_events(t).select("log_index", F.col("product_id").cast("bigint").alias("product_id"), "event_name")


@query("signed_legs", "D3 P13", f"SELECT chain, token_address, owner_address, block_number, log_index, amount AS amount_transferred FROM ({_LEGS})", "amount_transferred")
def _(t):
    return tr.to_legs(usable_events(t)).select("chain", "token_address", "owner_address", "block_number", "log_index", "amount_transferred")


_NET = """SELECT chain, token_address, owner_address, block_number, sum(amount) AS amount_transferred,
   coalesce(last(transaction_hash ORDER BY log_index) FILTER (WHERE amount <> 0), last(transaction_hash ORDER BY log_index)) AS transaction_hash, max(log_index) AS log_index
   FROM ({legs}) GROUP BY 1, 2, 3, 4 HAVING sum(amount) <> 0"""


@query("net_transfers_from_logs", "D1 D2 D3 A26", _NET.format(legs=_LEGS), "amount_transferred")
def _(t):
    return tr.net(tr.to_legs(usable_events(t)))


@query("net_transfers", "A26 T13 T19", _NET.format(legs="SELECT *, amount_transferred AS amount FROM legs"), "amount_transferred")
def _(t):
    return tr.net(t.legs)


@query("staking_view", "D4", "SELECT log_index, owner_address, -amount_transferred AS amount_transferred, '0xstake' AS token_address FROM legs", "amount_transferred")
def _(t):
    return tr.as_stakes(t.legs, F.lit("0xstake")).select("log_index", "owner_address", "amount_transferred", "token_address")


@query("transfers_without_ignored", "J19", "SELECT log_index, owner_address, amount_transferred FROM legs l WHERE NOT EXISTS (SELECT 1 FROM ignored i WHERE i.chain = l.chain AND i.address = l.owner_address)", "amount_transferred")
def _(t):
    shouting = t.legs.withColumn("owner_address", F.concat(F.lit("0x"), F.upper(F.substring("owner_address", 3, 40))))
    kept = tr.drop_ignored(shouting, t.ignored)
    return kept.select("log_index", F.lower("owner_address").alias("owner_address"), "amount_transferred")


@query(
    "transfers_in_requested_blocks", "I21",
    """WITH r AS (SELECT event_type AS chain, min(event_id // 8) AS lo, max(event_id // 8) AS hi, list_position(['click','error','purchase','signup','view'], event_type) AS n FROM events GROUP BY event_type)
       SELECT l.log_index, l.owner_address FROM legs l JOIN r USING (chain) WHERE l.block_number BETWEEN r.lo + (r.hi - r.lo) * (n - 1) // 10 AND r.lo + (r.hi - r.lo) * (n + 4) // 10""",
)
def _(t):
    # each chain asks for another half of its blocks; one scan serves them all
    n = F.array_position(F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")]), F.col("chain"))
    ends = t.legs.groupBy("chain").agg(F.min("block_number").alias("lo"), F.max("block_number").alias("hi"))
    part = lambda tenths: F.col("lo") + F.floor((F.col("hi") - F.col("lo")) * tenths / 10)
    asked = ends.select("chain", part(n - 1).alias("from"), part(n + 4).alias("to"))
    return tr.inside_requested(t.legs, asked, ["chain"], cell_width=16).select("log_index", "owner_address")


@query(
    "scaled_amounts", "P13",
    "SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) / pow(10.0, o_orderkey % 7) AS amount FROM orders",
    "amount",
)
def _(t):
    chain_amount = F.round(F.col("o_totalprice") * 100).cast("decimal(38,0)")
    return t.raw("orders").select("o_orderkey", evm.scaled(chain_amount, F.pmod("o_orderkey", F.lit(7)).cast("int")).alias("amount"))


@query(
    "share_rates", "P14",
    "SELECT o_orderkey, round(round(o_totalprice * 100) / pow(10.0, 6) * pow(10.0, 3)) / pow(10.0, 3) AS rate FROM orders",
    "rate",
)
def _(t):
    return t.raw("orders").select("o_orderkey", evm.share_rate(F.round(F.col("o_totalprice") * 100), F.lit(3), F.lit(6)).alias("rate"))


def readings(t):
    """Contract readings: amounts in chain integers of 6 or 8 decimals; one in ten vaults is empty."""
    empty = F.pmod("l_partkey", F.lit(10)) == 9
    chain_units = lambda c, d: F.round(c * F.lit(10**d)).cast("decimal(38,0)")
    return t.raw("lineitem").select(
        (F.col("l_partkey") + 1).cast("int").alias("product_id"),
        F.col("l_shipdate").alias("datetime"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("block_number"),
        chain_units(F.col("l_quantity"), 8).alias("raw_vault_supply"),
        chain_units(F.col("l_quantity"), 6).alias("raw_staked"),
        F.when(empty, F.lit(0).cast("decimal(38,0)")).otherwise(chain_units(F.col("l_quantity") * 2, 6)).alias("raw_underlying_supply"),
        chain_units(F.lit(1) + F.col("l_tax"), 6).alias("ppfs"),
        F.lit(8).alias("share_decimals"),
        F.lit(6).alias("underlying_decimals"),
    )


@query(
    "vault_statistics", "D15 P13 P14 P15",
    """SELECT CAST(l_partkey + 1 AS INT) AS product_id, l_shipdate AS datetime, l_orderkey * 8 + l_linenumber AS block_number, l_quantity AS vault_total_supply, 1 + l_tax AS share_to_underlying_price,
       l_quantity AS staked_underlying, CASE WHEN l_partkey % 10 = 9 THEN 0 ELSE l_quantity * 2 END AS underlying_total_supply, CASE WHEN l_partkey % 10 <> 9 THEN 0.5 END AS underlying_capture_percentage FROM lineitem""",
    "vault_total_supply share_to_underlying_price staked_underlying underlying_total_supply underlying_capture_percentage",
)
def _(t):
    good, _ = valuation.split_readings(readings(t))
    return valuation.vault_stats(good)


@query(
    "share_rate_ticks", "D14 O2",
    "SELECT l_partkey AS price_feed_id, l_orderkey AS block_number, min(l_shipdate) AS datetime, min(1 + l_tax) AS price FROM lineitem GROUP BY 1, 2",
    "price",
)
def _(t):
    # many readings of one feed in one block: one tick
    rows = t.raw("lineitem").select(
        F.col("l_partkey").alias("price_feed_id"), F.col("l_orderkey").alias("block_number"), F.col("l_shipdate").alias("datetime"),
        F.round((F.lit(1) + F.col("l_tax")) * 10**6).alias("ppfs"), F.lit(8).alias("share_decimals"), F.lit(6).alias("underlying_decimals"),
    )
    return valuation.share_rate_series(rows)


_ASKED = 'SELECT o_orderkey AS product_id, o_orderkey % 50 + 1 AS "from", o_orderkey % 50 + 7 AS "to", o_orderkey % 50 + 4 AS snapshot_block FROM orders'
_READ = "SELECT l_orderkey AS product_id, l_orderkey % 50 + l_linenumber AS block_number, l_quantity FROM lineitem"


@query(
    "matched_readings", "D16",
    f"""SELECT a.product_id, a.snapshot_block, r.n AS answers FROM ({_ASKED}) a LEFT JOIN (SELECT product_id, block_number, count(*) AS n FROM ({_READ}) GROUP BY 1, 2) r ON r.product_id = a.product_id AND r.block_number = a.snapshot_block""",
)
def _(t):
    start = F.pmod("o_orderkey", F.lit(50))
    asked = t.raw("orders").select(F.col("o_orderkey").alias("product_id"), (start + 1).alias("from"), (start + 7).alias("to"), (start + 4).alias("snapshot_block"))
    read = t.raw("lineitem").select(F.col("l_orderkey").alias("product_id"), (F.pmod("l_orderkey", F.lit(50)) + F.col("l_linenumber")).alias("block_number"), "l_quantity")
    good, bad = valuation.match_readings(asked, read, ["product_id"])
    return good.select("product_id", "snapshot_block", F.lit(1).cast("bigint").alias("answers")).unionByName(
        bad.select("product_id", "snapshot_block", F.col("_answers").alias("answers"))
    )


# --- upserts ---------------------------------------------------------------------------------------------------

def lines(t):
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_tax", "l_discount", "l_shipdate")


_FIRST_LINE = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_extendedprice, l_shipdate, l_quantity, l_tax, l_discount) AS rn FROM lineitem) WHERE rn = 1"


def first_lines(t):
    return keep_first(lines(t), LINE, ["l_partkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_tax", "l_discount"])


@query("batch_first_wins", "U1 O2 T21", f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM ({_FIRST_LINE})", "l_extendedprice")
def _(t):
    return first_lines(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(
    "batch_conflicts", "U2",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING min(l_discount) <> max(l_discount) OR min(l_tax) <> max(l_tax)",
)
def _(t):
    return up.find_conflicts(lines(t), LINE, ["l_discount", "l_tax"])


@query(
    "batch_without_conflicts", "U2",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem x WHERE NOT EXISTS (SELECT 1 FROM lineitem y WHERE y.l_orderkey = x.l_orderkey AND y.l_linenumber = x.l_linenumber
       GROUP BY y.l_orderkey HAVING min(l_discount) <> max(l_discount) OR min(l_tax) <> max(l_tax))""",
)
def _(t):
    good, _ = up.quarantine_conflicts(lines(t), LINE, ["l_discount", "l_tax"])
    return good.select("l_orderkey", "l_linenumber", "l_partkey")


def price_batches(t):
    """Stored prices and a later batch that overlaps them."""
    stored = t.price_ts.filter(F.col("datetime") < F.lit(datetime(2024, 1, 20)))
    batch = t.price_ts.filter(F.col("datetime") >= F.lit(datetime(2024, 1, 10))).withColumn("price", (F.col("price") + 1).cast("decimal(38,18)"))
    return stored, batch


_UPSERT_PRICES = "SELECT price_feed_id, block_number, datetime, CASE WHEN datetime >= TIMESTAMP '2024-01-10' THEN price + 1 ELSE price END AS price FROM price_ts"


@query("upsert_prices", "S6 U3", _UPSERT_PRICES, "price")
def _(t):
    stored, batch = price_batches(t)
    return up.upsert(stored, batch, ["price_feed_id", "block_number", "datetime"]).select("price_feed_id", "block_number", "datetime", "price")


@query("merge_prices_by_day", "U3 S6 ST8", _UPSERT_PRICES, "price")
def _(t):
    stored, batch = price_batches(t)
    day = lambda df: df.withColumn("day", F.to_date("datetime"))
    path = scratch_path(t.spark, "prices")
    up.overwrite_partitions(day(stored), path, "day")
    keys = ["price_feed_id", "block_number", "datetime", "day"]
    for _ in range(2):  # delivering a batch twice changes nothing
        up.merge_into_partitions(t.spark, path, day(batch), keys, "day")
    return t.spark.read.parquet(path).select("price_feed_id", "block_number", "datetime", "price")


@query(
    "upsert_vault_stats", "S7",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN l_quantity * 2 ELSE l_quantity END AS staked, CASE WHEN l_discount > 0.05 THEN NULL ELSE l_tax END AS rate FROM ({_FIRST_LINE})""",
    "staked rate",
)
def _(t):
    stored = first_lines(t).select(*LINE, F.col("l_quantity").alias("staked"), F.col("l_tax").alias("rate"))
    discounted = first_lines(t).filter(F.col("l_discount") > 0.05)
    batch = discounted.select(*LINE, (F.col("l_quantity") * 2).alias("staked"), F.lit(None).cast("double").alias("rate"))
    return up.upsert(stored, batch, LINE)


@query("insert_absent_blocks", "S8", "SELECT chain, block_number, datetime FROM blocks WHERE datetime >= TIMESTAMP '2024-01-12'")
def _(t):
    stored = t.blocks.filter(F.col("datetime") < F.lit(datetime(2024, 1, 12)))
    return up.insert_if_absent(stored, t.blocks, ["chain", "block_number", "datetime"]).select("chain", "block_number", "datetime")


@query(
    "upsert_ledger_rewards", "S9",
    """SELECT product_id, investor_id, block_number, datetime, CASE WHEN datetime >= TIMESTAMP '2024-01-12' THEN balance_diff * 2 ELSE balance_diff END AS balance_diff,
       CASE WHEN block_number % 3 = 0 THEN 7 WHEN datetime >= TIMESTAMP '2024-01-12' THEN 9 END AS pending_rewards FROM ledger_diffs""",
    "balance_diff pending_rewards",
)
def _(t):
    keys = ["product_id", "investor_id", "block_number", "datetime"]
    rewards = F.when(F.pmod("block_number", F.lit(3)) == 0, F.lit(7)).cast("decimal(38,18)")
    stored = t.ledger_diffs.select(*keys, "balance_diff", rewards.alias("pending_rewards"))
    batch = stored.filter(F.col("datetime") >= F.lit(datetime(2024, 1, 12))).select(
        *keys, (F.col("balance_diff") * 2).cast("decimal(38,18)").alias("balance_diff"), F.lit(9).cast("decimal(38,18)").alias("pending_rewards")
    )
    return up.upsert(stored, batch, keys, up.POLICIES["investment_balance_ts"])


@query(
    "upsert_timeline", "S10 T14",
    """SELECT investor_id, product_id, block_number, balance, CASE WHEN datetime < TIMESTAMP '2024-01-12' THEN usd_balance END AS usd_balance FROM timeline""",
    "balance usd_balance",
)
def _(t):
    keys = ["investor_id", "product_id", "block_number", "datetime"]
    stored = t.timeline.select(*keys, "balance", "usd_balance")
    batch = stored.filter(F.col("datetime") >= F.lit(datetime(2024, 1, 12))).select(*keys, F.lit(None).cast("double").alias("balance"), F.lit(None).cast("double").alias("usd_balance"))
    return up.upsert(stored, batch, keys, up.POLICIES["investor_timeline_ts"]).drop("datetime")


@query(
    "upsert_feeds", "S11 J7",
    "SELECT price_feed_id, feed_key, CASE WHEN to_asset_key = 'fiat:USD' THEN 'false' ELSE 'true' END AS active, external_id FROM feeds",
)
def _(t):
    stored = t.feeds
    batch = stored.filter(F.col("to_asset_key") == "fiat:USD").withColumn("price_feed_data", F.lit('{"active":false}'))
    merged = up.upsert(stored, batch, ["price_feed_id"], up.POLICIES["price_feed"])
    data = lambda path: F.get_json_object("price_feed_data", path)
    return merged.select("price_feed_id", "feed_key", data("$.active").alias("active"), data("$.externalId").alias("external_id"))


@query("append_errors", "S13", "SELECT chain, count(*) * 2 AS n, count(DISTINCT request) AS requests FROM errors GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "errors")
    for _ in range(2):
        t.errors.write.mode("append").parquet(path)
    return t.spark.read.parquet(path).groupBy("chain").agg(F.count("*").alias("n"), F.countDistinct("request").alias("requests"))


@query(
    "update_prices_of_rows", "S14 D10",
    """SELECT investor_id, product_id, block_number, CASE WHEN balance_diff < 0 THEN 2.5 ELSE underlying_to_usd_price END AS underlying_to_usd_price,
       CASE WHEN balance_diff < 0 THEN underlying_balance * 2.5 ELSE usd_balance END AS usd_balance, CASE WHEN balance_diff < 0 THEN underlying_diff * 2.5 ELSE usd_diff END AS usd_diff FROM timeline""",
    "underlying_to_usd_price usd_balance usd_diff",
)
def _(t):
    keys = ["investor_id", "product_id", "datetime", "block_number"]
    resolved = t.ledger_diffs.filter(F.col("balance_diff") < 0).select(*keys, F.lit(2.5).alias("price"))
    updated = valuation.apply_prices(t.timeline, resolved)
    return updated.select("investor_id", "product_id", "block_number", "underlying_to_usd_price", "usd_balance", "usd_diff")


@query(
    "invalidated_prices", "S15 ST4 T10",
    """SELECT investor_id, product_id, block_number, CASE WHEN NOT (product_id IN (SELECT product_id FROM products WHERE price_feed_1_id IN (2, 3) OR price_feed_2_id IN (2, 3))
         AND datetime BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20') THEN usd_balance END AS usd_balance, underlying_balance FROM timeline""",
    "usd_balance underlying_balance",
)
def _(t):
    ids = t.products.select((F.pmod("product_id", F.lit(2)) + 2).cast("int").alias("price_feed_id")).distinct()
    at = lambda n: F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-10").cast("timestamp")) + n * 86400)
    refreshed = ids.select("price_feed_id", at((F.col("price_feed_id") - 2) * 3).alias("from"), at((F.col("price_feed_id") - 2) * 5 + 5).alias("to"))
    return valuation.invalidate(t.timeline, t.products, refreshed).select("investor_id", "product_id", "block_number", "usd_balance", "underlying_balance")


@query(
    "reprice_after_refresh", "ST4 D10 S14 S15",
    """SELECT investor_id, product_id, block_number, CASE WHEN hit THEN underlying_to_usd_price + 1 ELSE underlying_to_usd_price END AS underlying_to_usd_price,
       CASE WHEN hit THEN underlying_balance * (underlying_to_usd_price + 1) ELSE usd_balance END AS usd_balance FROM (
       SELECT *, product_id IN (SELECT product_id FROM products WHERE price_feed_1_id IN (2, 3) OR price_feed_2_id IN (2, 3))
         AND datetime BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-19 23:59:59' AS hit FROM timeline)""",
    "underlying_to_usd_price usd_balance",
)
def _(t):
    # feeds 2 and 3 are imported anew over ten days, with other prices: what was valued by them is cleared, resolved and written back
    at = F.col("datetime")
    lo, hi = F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-19 23:59:59").cast("timestamp")
    raised = F.when(at.between(lo, F.lit("2024-01-19 23:59:59.999999").cast("timestamp")), F.col("price") + 1).otherwise(F.col("price"))
    ticks = t.price_ts.withColumn("price", raised.cast("decimal(38,18)"))
    refreshed = t.price_ts.select("price_feed_id").distinct().filter("price_feed_id IN (2, 3)").withColumns({"from": lo, "to": hi})
    cleared = valuation.invalidate(t.timeline, t.products, refreshed)
    feeds = t.products.select("product_id", F.col("price_feed_2_id").alias("price_feed_id"))
    keys = ["investor_id", "product_id", "datetime", "block_number"]
    missing = cleared.filter(F.col("underlying_to_usd_price").isNull()).select(*keys).join(feeds, "product_id")
    none = missing.select("price_feed_id", F.lit(0).cast("long").alias("from"), F.lit(0).cast("long").alias("to")).limit(0)
    created = missing.select("price_feed_id").distinct().withColumn("first_date", lo)
    resolved = valuation.resolve_missing(missing, ticks, none, none, created, AS_OF)
    written = valuation.apply_prices(cleared, resolved)
    return written.select("investor_id", "product_id", "block_number", "underlying_to_usd_price", "usd_balance")


@query("delete_feed_prices", "S16", "SELECT price_feed_id, count(*) AS n FROM price_ts WHERE price_feed_id NOT IN (SELECT price_feed_1_id FROM products WHERE price_feed_1_id IS NOT NULL AND chain IN ('view', 'purchase')) GROUP BY 1")
def _(t):
    two_chains = t.products.filter(F.col("chain").isin("view", "purchase"))
    kept = up.delete_where_in(t.price_ts, two_chains.select(F.col("price_feed_1_id").alias("price_feed_id")), ["price_feed_id"])
    return kept.groupBy("price_feed_id").agg(F.count("*").alias("n"))


@query(
    "landed_price_ticks", "S2",
    """SELECT CAST(list_position(['click','error','purchase','signup','view'], event_type) AS INT) AS price_feed_id, epoch_us(ts) // 1000000 AS block_number, value AS price,
       make_timestamp(epoch_us(ts) // 1000 * 1000) AS datetime FROM events WHERE make_timestamp(epoch_us(ts) // 1000 * 1000) BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'""",
    "price",
)
def _(t):
    path = scratch_path(t.spark, "ticks")
    t.raw("events").select(
        (F.floor(F.unix_micros("ts") / 1000) / 1000).alias("t"), F.col("value").alias("v"), F.col("event_type").alias("feed")
    ).write.json(path)
    feed = F.array_position(F.array(*[F.lit(x) for x in ("click", "error", "purchase", "signup", "view")]), F.col("feed"))
    ticks = readers.price_ticks(t.spark, path, feed, F.lit(datetime(2024, 1, 5)), F.lit(datetime(2024, 1, 25)))
    return ticks.select("price_feed_id", "block_number", "price", "datetime")


@query("landed_event_log", "S1", f"SELECT chain, count(*) AS n, min(block_number) AS lo, max(log_index) AS hi FROM ({_LOGS}) GROUP BY 1")
def _(t):
    return landed_logs(t).groupBy("chain").agg(F.count("*").alias("n"), F.min("block_number").alias("lo"), F.max("log_index").alias("hi"))


@query("time_bounded_scan", "S4", "SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'")
def _(t):
    return readers.between_times(t.raw("events"), F.lit(datetime(2024, 1, 5)), F.lit(datetime(2024, 1, 25)), "ts").select("event_id", "ts")


@query("ledger_by_transaction", "F1 Q17", "SELECT product_id, investor_id, block_number, transaction_hash AS trx_hash, balance FROM ledger ORDER BY datetime DESC", "balance")
def _(t):
    return t.ledger.orderBy(F.col("datetime").desc()).select("product_id", "investor_id", "block_number", to_hex_text(F.col("transaction_hash")).alias("trx_hash"), "balance")
