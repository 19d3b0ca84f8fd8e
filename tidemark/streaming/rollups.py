"""Incremental rollups and loads on Structured Streaming.

Every sink is a keyed merge or keeps what each micro-batch gave under the batch's number, so a micro-batch delivered
twice leaves the table as it was. ``write_partials`` and ``write_once`` need no watermark: their tables do not depend on
the number and order of files. ``stream_rollup`` lets go of windows behind its watermark; ticks that come later reach
its table by ``refresh_range``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timegrid import ORIGIN_MICROS, SAMPLING_MS, interval, micros, time_bucket
from tidemark.operators.latest import first_by, last_by
from tidemark.operators.ohlc import rollup
from tidemark.operators.upsert import LISTED_PARTITIONS, merge_into_partitions, one_of, overwrite_partitions, table_exists

# how late a tick may be and still reach a rollup by itself; older ones need refresh_range
LATENESS = {"1hour": "1 day", "1day": "3 days"}
DAY = "day"
SLOT = "slot"
BATCH = "batch"


def stream_rollup(ticks: DataFrame, period: str, lateness: str | None = None) -> DataFrame:
    """OHLC per feed and tumbling window over a stream of ticks."""
    width = f"{SAMPLING_MS[period]} milliseconds"
    offset = f"{ORIGIN_MICROS % micros(period) // 1000} milliseconds"
    return (
        ticks.withWatermark("datetime", lateness or LATENESS.get(period, "1 day"))
        .groupBy("price_feed_id", F.window("datetime", width, width, offset).alias("_window"))
        .agg(
            F.avg(F.col("price").cast("double")).alias("price_avg"),
            F.max("price").alias("price_high"),
            F.min("price").alias("price_low"),
            first_by("price", "datetime", "block_number").alias("price_open"),
            last_by("price", "datetime", "block_number").alias("price_close"),
        )
        .select("price_feed_id", F.col("_window.start").alias("datetime"), "price_avg", "price_high", "price_low", "price_open", "price_close")
    )


def write_rollup(rolled: DataFrame, path: str, checkpoint: str, available_now: bool = True, every: str = "4 hours") -> StreamingQuery:
    """Keep a rollup table up to date: each micro-batch merges the windows it changed."""

    def merge(batch: DataFrame, _: int) -> None:
        merge_into_partitions(
            batch.sparkSession, path, batch.withColumn(DAY, F.to_date("datetime")), ["price_feed_id", "datetime", DAY], DAY
        )

    return _start(rolled.writeStream.outputMode("update").foreachBatch(merge), checkpoint, available_now, every)


def write_upserts(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    arrival: Sequence[str],
    policies: Mapping[str, str] | None = None,
    partition_of: str = "datetime",
    available_now: bool = True,
    every: str = "5 seconds",
) -> StreamingQuery:
    """Load a stream into a keyed table; the first row of a key in a batch wins. Partitions are hours, so a batch of
    recent rows rewrites an hour at most."""

    def merge(batch: DataFrame, _: int) -> None:
        dated = batch.withColumn(SLOT, F.date_format(partition_of, "yyyy-MM-dd-HH"))
        merge_into_partitions(batch.sparkSession, path, dated, [*keys, SLOT], SLOT, policies, arrival)

    return _start(rows.writeStream.outputMode("append").foreachBatch(merge), checkpoint, available_now, every)


def _start(writer, checkpoint: str, available_now: bool, every: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def write_partials(ticks: DataFrame, period: str, path: str, checkpoint: str, available_now: bool = True, every: str = "1 minute") -> StreamingQuery:
    """OHLC parts of each micro-batch: sums, counts and extremes that ``read_partials`` puts together. Late ticks are parts
    like any others. A batch that runs again replaces its own parts; nothing stored before is read or rewritten."""

    def save(batch: DataFrame, number: int) -> None:
        at = F.struct(F.col("datetime").alias("at"), "block_number", "price")
        parts = batch.groupBy("price_feed_id", time_bucket(period, F.col("datetime")).alias("bucket")).agg(
            F.sum(F.col("price").cast("double")).alias("price_sum"),
            F.count("price").alias("price_count"),
            F.max("price").alias("price_high"),
            F.min("price").alias("price_low"),
            F.min(at).alias("first"),
            F.max(at).alias("last"),
        )
        overwrite_partitions(parts.withColumn(BATCH, F.lit(number)), path, BATCH)

    return _start(ticks.writeStream.outputMode("append").foreachBatch(save), checkpoint, available_now, every)


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The rollup that the parts of all micro-batches make."""
    return (
        spark.read.parquet(path)
        .groupBy("price_feed_id", F.col("bucket").alias("datetime"))
        .agg(
            (F.sum("price_sum") / F.sum("price_count")).alias("price_avg"),
            F.max("price_high").alias("price_high"),
            F.min("price_low").alias("price_low"),
            F.min("first")["price"].alias("price_open"),
            F.max("last")["price"].alias("price_close"),
        )
    )


def write_once(rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partition: Column, available_now: bool = True, every: str = "1 minute") -> StreamingQuery:
    """Keep the first row of each key, whenever it comes. ``partition`` must follow from the keys; a batch looks only into
    the partitions it touches, and leaves out what it has written itself if it runs again."""

    def save(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.withColumn(SLOT, partition.cast("string")).dropDuplicates([*keys, SLOT])
        if table_exists(spark, path):
            slots = [r[0] for r in fresh.select(SLOT).distinct().limit(LISTED_PARTITIONS + 1).collect()]
            known = spark.read.schema(f"{SLOT} string, {BATCH} bigint, {_ddl(fresh, keys)}").parquet(path).filter(F.col(BATCH) != number)
            if len(slots) <= LISTED_PARTITIONS:
                known = known.filter(one_of(F.col(SLOT), slots))
            fresh = fresh.join(known.select(*keys, SLOT), [*keys, SLOT], "left_anti")
        (
            fresh.withColumn(BATCH, F.lit(number).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH, SLOT)
            .parquet(path)
        )

    return _start(rows.writeStream.outputMode("append").foreachBatch(save), checkpoint, available_now, every)


def _ddl(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def refresh_range(spark: SparkSession, ticks: DataFrame, path: str, period: str, lo: datetime, hi: datetime) -> None:
    """Recompute the buckets of [lo, hi] from the ticks, late ones included, and merge them into the table."""
    start = time_bucket(period, F.lit(lo))
    end = time_bucket(period, F.lit(hi)) + interval(period)
    window = ticks.filter((F.col("datetime") >= start) & (F.col("datetime") < end))
    fresh = rollup(window, period).withColumn(DAY, F.to_date("datetime"))
    merge_into_partitions(spark, path, fresh, ["price_feed_id", "datetime", DAY], DAY)


def append_snapshot(snapshot: DataFrame, path: str, partition: str = "datetime") -> None:
    """Scheduled snapshot: running it again for the same instant replaces that instant's rows."""
    overwrite_partitions(snapshot, path, partition)


def expire_partitions(spark: SparkSession, path: str, before: str, partition: str = DAY) -> int:
    """Retention: drop whole partitions older than a date; returns how many."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{partition}=") and name.split("=", 1)[1] < before:
            dropped += int(fs.delete(status.getPath(), True))
    return dropped
