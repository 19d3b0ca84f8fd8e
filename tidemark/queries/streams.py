"""Streams over the given files, run to the end of what has landed; the tables they keep are read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.timegrid import cell
from tidemark.operators import sketches
from tidemark.operators import transfers as tr
from tidemark.plans import coverage as cov
from tidemark.queries.loads import _LOGS, DECODED_LOGS, event_logs
from tidemark.queries.ranges import COVERAGE_METRICS
from tidemark.queries.registry import query
from tidemark.schema import AMOUNT
from tidemark.session import scratch_path
from tidemark.sources import readers
from tidemark.sources.standins import PRODUCTS, SCHEMAS, _type_index
from tidemark.streaming import positions, rollups, sealed

OHLC = "price_avg price_high price_low price_open price_close"


def event_stream(t):
    # one file or a folder of files; only as a pattern may the path be a file
    return t.spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 8).parquet(f"{t.dir}/events.parque[t]")


def tick_stream(t):
    return event_stream(t).select(
        F.col("ts").alias("datetime"), _type_index().alias("price_feed_id"), F.col("event_id").alias("block_number"), F.col("value").cast(AMOUNT).alias("price")
    )


def _whole(t):
    """First and last instant of the ticks."""
    return tuple(t.price_ts.agg(F.min("datetime"), F.max("datetime")).first())


def finish(stream) -> None:
    stream.awaitTermination()


@query("stream_rollup_1h", "ST1 ST2", "SELECT * FROM price_1h", OHLC)
def _(t):
    path = scratch_path(t.spark, "rollup")
    finish(rollups.write_partials(tick_stream(t), "1hour", path, scratch_path(t.spark, "rollup-checkpoint")))
    return rollups.read_partials(t.spark, path)


@query("stream_rollup_1d", "ST2", "SELECT * FROM price_1d", OHLC)
def _(t):
    path = scratch_path(t.spark, "rollup")
    finish(rollups.write_partials(tick_stream(t), "1day", path, scratch_path(t.spark, "rollup-checkpoint")))
    return rollups.read_partials(t.spark, path)


def sealed_rollup(t):
    """Ticks landing five days at a time; one in 37 comes last of all, whenever it was made."""
    landing, path = scratch_path(t.spark, "ticks"), scratch_path(t.spark, "sealed")
    ticks = t.price_ts.withColumn("late", F.pmod("block_number", F.lit(37)) == 0)
    for first in range(1, 32, 5):
        on_time = ~F.col("late") & F.dayofmonth("datetime").between(first, first + 4)
        ticks.filter(on_time | F.col("late") if first == 31 else on_time).drop("late").coalesce(1).write.mode("append").parquet(landing)
    stream = t.spark.readStream.schema(t.price_ts.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    finish(sealed.write(stream, path, scratch_path(t.spark, "sealed-checkpoint"), "1hour", "1day", every=2))
    return path


@query("sealed_rollup_1h", "ST2 ST3 A3", "SELECT * FROM price_1h", OHLC)
def _(t):
    return sealed.read(t.spark, sealed_rollup(t), with_late=True)


@query(
    "late_ticks_of_sealed_rollup", "ST2 ST3",
    """WITH x AS (SELECT time_bucket(INTERVAL '1 hour', max(datetime) - INTERVAL 1 DAY) AS mark FROM price_ts WHERE block_number % 37 <> 0 AND day(datetime) <= 30)
       SELECT price_feed_id, count(*) AS late_ticks FROM price_ts, x WHERE block_number % 37 = 0 AND time_bucket(INTERVAL '1 hour', datetime) < mark GROUP BY 1""",
)
def _(t):
    return sealed.late_counts(t.spark, sealed_rollup(t))


_REFRESHED = """SELECT price_feed_id, time_bucket(INTERVAL '1 day', datetime) AS datetime, avg(CAST(price AS DOUBLE)) AS price_avg, max(price) AS price_high, min(price) AS price_low,
       first(price ORDER BY datetime, block_number) AS price_open, last(price ORDER BY datetime, block_number) AS price_close FROM price_ts
       WHERE datetime >= TIMESTAMP '2024-01-10' AND datetime < TIMESTAMP '2024-01-13' OR hour(datetime) < 12 GROUP BY 1, 2"""


@query("rollup_after_range_refresh", "ST3", _REFRESHED, OHLC)
def _(t):
    # a rollup that missed all afternoons, repaired for three days
    path = scratch_path(t.spark, "rollup")
    known = t.price_ts.filter(F.hour("datetime") < 12)
    rollups.refresh_range(t.spark, known, path, "1day", *_whole(t))
    rollups.refresh_range(t.spark, t.price_ts, path, "1day", datetime(2024, 1, 10, 5), datetime(2024, 1, 12, 7))
    return t.spark.read.parquet(path).drop("day")


@query("stream_load_prices", "ST1 ST8 S6 U1", "SELECT price_feed_id, block_number, datetime, price FROM price_ts", "price")
def _(t):
    path = scratch_path(t.spark, "prices")
    for _ in range(2):  # everything is delivered twice, by two streams
        stream = rollups.write_upserts(
            tick_stream(t), path, scratch_path(t.spark, "prices-checkpoint"), ["price_feed_id", "block_number", "datetime"], ["price"]
        )
        finish(stream)
    return t.spark.read.parquet(path).select("price_feed_id", "block_number", "datetime", "price")


@query("stream_blocks_once", "ST8", "SELECT DISTINCT event_type AS chain, event_id // 4 AS block_group FROM events")
def _(t):
    path = scratch_path(t.spark, "blocks")
    blocks = event_stream(t).select(F.col("event_type").alias("chain"), F.floor(F.col("event_id") / 4).alias("block_group"), F.col("ts").alias("datetime"))
    slot = F.floor(F.col("block_group") / 100_000)
    finish(rollups.write_once(blocks, path, scratch_path(t.spark, "blocks-checkpoint"), ["chain", "block_group"], slot))
    return t.spark.read.parquet(path).select("chain", "block_group")


def decoded_stream(t):
    """The landed log as a stream of files: decoded on the way, what cannot be read goes beside it with the reason."""
    landing, good, bad = (scratch_path(t.spark, name) for name in ("logs", "decoded", "quarantine"))
    event_logs(t).write.parquet(landing)

    def save(batch, number):
        usable, unusable = tr.split_decodable(batch)
        rollups.overwrite_partitions(usable.select(*DECODED, F.lit(number).alias("batch")), good, "batch")
        rollups.overwrite_partitions(unusable.select("chain", "block_number", "log_index", "reason", F.lit(number).alias("batch")), bad, "batch")

    stream = tr.decode(readers.event_log(t.spark, landing, streaming=True)).writeStream.foreachBatch(save)
    finish(stream.option("checkpointLocation", scratch_path(t.spark, "logs-checkpoint")).trigger(availableNow=True).start())
    return good, bad


DECODED = ["log_index", "event_name", "first_party", "second_party", "amount"]


@query("stream_decoded_logs", "S1 D1 ST8", DECODED_LOGS)
def _(t):
    return t.spark.read.parquet(decoded_stream(t)[0]).select(*DECODED)


@query("stream_quarantine", "S1 D1 ST8 ST10", f"SELECT chain, block_number, log_index, 'unknown event' AS reason FROM ({_LOGS}) WHERE event_name IS NULL")
def _(t):
    return t.spark.read.parquet(decoded_stream(t)[1]).select("chain", "block_number", "log_index", "reason")


_LOTS = """WITH d AS (SELECT product_id, investor_id, datetime, block_number, CAST(balance_diff AS DOUBLE) AS shares, 1.0 + block_number % 10 / 100.0::DOUBLE AS price FROM ledger_diffs),
   s AS (SELECT *, sum(shares) OVER w AS S, sum(greatest(shares, 0)) OVER w AS B FROM d WINDOW w AS (PARTITION BY investor_id, product_id ORDER BY datetime, block_number ROWS UNBOUNDED PRECEDING)),
   i AS (SELECT *, S - least(0, min(S) OVER w) AS I FROM s WINDOW w AS (PARTITION BY investor_id, product_id ORDER BY datetime, block_number ROWS UNBOUNDED PRECEDING)),
   e AS (SELECT *, B - I AS E, coalesce(lag(B - I) OVER w, 0) AS E0, max(B - I) OVER (PARTITION BY investor_id, product_id) AS EA FROM i WINDOW w AS (PARTITION BY investor_id, product_id ORDER BY datetime, block_number)),
   u AS (SELECT *, greatest(0, least(B, EA) - (B - shares)) AS used FROM e)
 SELECT investor_id, product_id, sum(shares) AS balance, sum(CASE WHEN shares < 0 THEN (E - E0) * price ELSE -used * price END) AS realized_pnl, coalesce(sum(shares - used) FILTER (WHERE shares > 0), 0) AS remaining_shares,
   coalesce(sum((shares - used) * price) FILTER (WHERE shares > 0), 0) AS remaining_cost FROM u GROUP BY 1, 2"""


@query("stream_positions", "ST9 W8 W9", _LOTS, "balance realized_pnl remaining_shares remaining_cost")
def _(t):
    path = scratch_path(t.spark, "positions")
    amount = F.when(F.col("event_type").isin("click", "error"), -F.col("value")).otherwise(F.col("value"))
    trades = lambda events: events.select(
        F.col("user_id").cast("int").alias("investor_id"),
        (F.pmod("event_id", F.lit(PRODUCTS)) + 1).cast("int").alias("product_id"),
        F.col("ts").alias("datetime"),
        F.col("event_id").alias("block_number"),
        amount.alias("shares"),
        (F.lit(1.0) + F.pmod("event_id", F.lit(10)) / F.lit(100.0)).alias("price"),
    )
    stream = positions.positions(trades(event_stream(t)), "0 seconds").writeStream.format("parquet").option("path", path)
    with positions.rocksdb(t.spark):
        finish(stream.option("checkpointLocation", scratch_path(t.spark, "positions-checkpoint")).trigger(availableNow=True).start())
    return positions.complete(t.spark.read.schema(positions.OUTPUT).parquet(path), trades(t.raw("events")), cell(F.col("datetime"), 1))


@query("snapshot_rerun", "ST6 A13", COVERAGE_METRICS)
def _(t):
    path = scratch_path(t.spark, "metrics")
    snapshot = cov.metrics(t.products, t.states, t.coverage, datetime(2024, 2, 1))
    for _ in range(2):
        rollups.append_snapshot(snapshot, path)
    return t.spark.read.parquet(path).withColumn("datetime", F.col("datetime").cast("timestamp"))


@query(
    "sketch_snapshot_of_day", "A7 ST6 T8",
    """SELECT TIMESTAMP '2024-01-20' AS datetime, product_id, count(*) AS approx_investor_count FROM (
       SELECT product_id, investor_id FROM timeline WHERE datetime <= TIMESTAMP '2024-01-20' AND balance_diff <> 0 GROUP BY 1, 2 HAVING last(balance ORDER BY datetime, block_number) > 0) GROUP BY 2""",
)
def _(t):
    path = scratch_path(t.spark, "sketches")
    for _ in range(2):
        rollups.append_snapshot(sketches.daily_snapshot(t.timeline, F.lit(datetime(2024, 1, 20, 7))), path)
    stored = t.spark.read.parquet(path).withColumn("datetime", F.col("datetime").cast("timestamp"))
    return sketches.rollup_count(stored, ["datetime", "product_id"])


@query("rollup_partitions_expired", "ST5", "SELECT price_feed_id, datetime FROM price_1d WHERE datetime >= TIMESTAMP '2024-01-11'")
def _(t):
    path = scratch_path(t.spark, "rollup")
    rollups.refresh_range(t.spark, t.price_ts, path, "1day", *_whole(t))
    rollups.expire_partitions(t.spark, path, "2024-01-11")
    return t.spark.read.parquet(path).select("price_feed_id", "datetime")
