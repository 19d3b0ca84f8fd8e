"""Rollups whose old buckets are closed for good, so that what a stream keeps stays small.

A micro-batch leaves its parts (sums, counts, extremes) under its number. Every so many batches a *seal* puts the parts
together: buckets that end ``lateness`` before the newest tick become final rows, written once; the others are carried on
as one part each. Ticks that come behind the mark never touch a final row. They are kept beside the rollup by batch, can
be counted, and are brought in when the rollup is read with them.

``marks`` says which seal counts. It is written last, so a seal that dies, or a batch that runs again, replaces what it had
written and nothing else; parts that a seal has taken up are removed by the one after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timegrid import interval, time_bucket
from tidemark.operators.upsert import overwrite_partitions, table_exists

PARTS, OPEN, SEALED, LATE, MARKS = "parts", "open", "sealed", "late", "marks"
BATCH = "batch"
_AT = "struct<at: timestamp, block_number: bigint, price: decimal(38,18)>"
_PART = (
    "price_feed_id int, bucket timestamp, price_sum double, price_count bigint, price_high decimal(38,18), "
    f"price_low decimal(38,18), first {_AT}, last {_AT}, batch bigint"
)
KEYS = ["price_feed_id", "bucket"]


def _parts(ticks: DataFrame, period: str) -> DataFrame:
    at = F.struct(F.col("datetime").alias("at"), F.col("block_number").cast("bigint").alias("block_number"), F.col("price").cast("decimal(38,18)").alias("price"))
    return ticks.groupBy("price_feed_id", time_bucket(period, F.col("datetime")).alias("bucket")).agg(
        F.sum(F.col("price").cast("double")).alias("price_sum"),
        F.count("price").alias("price_count"),
        F.max("price").alias("price_high"),
        F.min("price").alias("price_low"),
        F.min(at).alias("first"),
        F.max(at).alias("last"),
    )


def _together(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*KEYS).agg(
        *(F.sum(c).alias(c) for c in ("price_sum", "price_count")),
        *(F.max(c).alias(c) for c in ("price_high", "last")),
        *(F.min(c).alias(c) for c in ("price_low", "first")),
    )


def _table(spark: SparkSession, path: str, name: str, schema: str = _PART) -> DataFrame:
    where = f"{path}/{name}"
    return spark.read.schema(schema).parquet(where) if table_exists(spark, where) else spark.createDataFrame([], schema)


def _mark(spark: SparkSession, path: str, before: Column | None = None) -> tuple[int, object]:
    """The number of the seal that counts, and the start of the first bucket that it left open."""
    marks = _table(spark, path, MARKS, "mark timestamp, batch bigint")
    marks = marks if before is None else marks.filter(F.col(BATCH) < before)
    found = marks.agg(F.max(F.struct(BATCH, "mark")).alias("m")).first()["m"]
    return (-1, None) if found is None else (found[BATCH], found["mark"])


def _not_sealed(spark: SparkSession, path: str, seal: int) -> DataFrame:
    """The open parts that a seal carried on, and those of the batches after it."""
    carried = _table(spark, path, OPEN).filter(F.col(BATCH) == seal)
    return carried.unionByName(_table(spark, path, PARTS).filter(F.col(BATCH) > seal))


def write(
    ticks: DataFrame, path: str, checkpoint: str, period: str, lateness: str, every: int = 16, available_now: bool = True
) -> StreamingQuery:
    """Keep a rollup of a stream of ticks (price_feed_id, datetime, block_number, price), sealed every so many batches."""

    def save(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # what counted before this batch, also if it runs again
        seal_number, mark = _mark(spark, path, F.lit(number))
        made = _parts(batch, period).withColumn(BATCH, F.lit(number).cast("bigint")).persist()
        is_late = F.lit(False) if mark is None else F.col("bucket") < F.lit(mark)
        try:
            overwrite_partitions(made.filter(~is_late), f"{path}/{PARTS}", BATCH)
            overwrite_partitions(made.filter(is_late), f"{path}/{LATE}", BATCH)
        finally:
            made.unpersist()
        if number - seal_number >= every:
            _seal(spark, path, number, seal_number, mark, period, lateness)

    writer = ticks.writeStream.outputMode("append").foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def _seal(spark: SparkSession, path: str, number: int, last_seal: int, mark: object, period: str, lateness: str) -> None:
    for name in (PARTS, OPEN):
        _drop_before(spark, f"{path}/{name}", last_seal if name == OPEN else last_seal + 1)
    whole = _together(_not_sealed(spark, path, last_seal).filter(F.col(BATCH) <= number))
    newest = whole.agg(F.max("last.at")).first()[0]
    if newest is None:
        return
    final = time_bucket(period, F.lit(newest) - interval(lateness))
    final = final if mark is None else F.greatest(final, F.lit(mark))
    numbered = whole.withColumn(BATCH, F.lit(number).cast("bigint"))
    overwrite_partitions(numbered.filter(F.col("bucket") < final), f"{path}/{SEALED}", BATCH)
    overwrite_partitions(numbered.filter(F.col("bucket") >= final), f"{path}/{OPEN}", BATCH)
    marked = spark.range(1).select(final.alias("mark"), F.lit(number).cast("bigint").alias(BATCH))
    overwrite_partitions(marked, f"{path}/{MARKS}", BATCH)


def _drop_before(spark: SparkSession, path: str, number: int) -> None:
    """Remove the partitions of batches below a number."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        if name.startswith(f"{BATCH}=") and int(name.split("=", 1)[1]) < number:
            fs.delete(status.getPath(), True)


def read(spark: SparkSession, path: str, with_late: bool = False) -> DataFrame:
    """The rollup as it stands; ``with_late`` brings in the ticks that came behind the mark."""
    number, _ = _mark(spark, path)
    final = _table(spark, path, SEALED).filter(F.col(BATCH) <= number)
    rows = final.unionByName(_not_sealed(spark, path, number))
    if with_late:
        rows = rows.unionByName(_table(spark, path, LATE))
    return _together(rows).select(
        "price_feed_id",
        F.col("bucket").alias("datetime"),
        (F.col("price_sum") / F.col("price_count")).alias("price_avg"),
        "price_high",
        "price_low",
        F.col("first.price").alias("price_open"),
        F.col("last.price").alias("price_close"),
    )


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """How many ticks of each feed came behind the mark."""
    return _table(spark, path, LATE).groupBy("price_feed_id").agg(F.sum("price_count").alias("late_ticks"))
