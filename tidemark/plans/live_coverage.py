"""Coverage that is kept up to date while results stream in.

The axis of blocks is cut into cells, and a stored range never leaves its cell: a longer one is stored as its parts. Two
flags say whether a part touches the start or the end of its cell, so that it may go on in the next one. A micro-batch
of results reads and rewrites only the cells that its ranges touch; parts are put together when they are read, and only
those at an edge take part in that.

Stored are unions alone: what was covered and queued before, and which results succeeded or failed. Unions do not depend on
the order or number of deliveries, so neither does the table. Reading derives, cell by cell, what is covered (before, or by
any result) and what must be retried, (queued - succeeded) + failed; ``settle`` makes that the new beginning, so that later
successes can clear what has failed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import intervals
from tidemark.operators.upsert import finish_merge, rewrite_partitions
from tidemark.plans.coverage import COVERED, RETRY
from tidemark.session import dealt

SUCCEEDED, FAILED = "succeeded", "failed"
CELL = "cell"
_COLUMNS = ["import_key", "kind", "from", "to", "at_start", "at_end", CELL]


def in_cells(ranges: DataFrame, width: int) -> DataFrame:
    """Ranges (import_key, kind, from, to) as their parts in cells."""
    first, last = (F.floor(F.col(c) / width).cast("long") for c in ("from", "to"))
    parts = ranges.filter(F.col("from") <= F.col("to")).withColumn(CELL, F.explode(F.sequence(first, last)))
    lo, hi = F.col(CELL) * width, (F.col(CELL) + 1) * width - 1
    return parts.select("import_key", "kind", F.greatest("from", lo).alias("from"), F.least("to", hi).alias("to"), CELL)


def _flagged(parts: DataFrame, width: int) -> DataFrame:
    at_start, at_end = F.col("from") == F.col(CELL) * width, F.col("to") == (F.col(CELL) + 1) * width - 1
    return parts.withColumns({"at_start": at_start, "at_end": at_end}).select(*_COLUMNS)


def _merged(parts: DataFrame, width: int) -> DataFrame:
    """Parts of a key, kind and cell as disjoint ones."""
    keys = ["import_key", "kind", CELL]
    by_cell = Window.partitionBy(*keys).orderBy("from")
    earlier = by_cell.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_cell.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # copies meet on the map side; what is left of a cell is bounded by its width
    single = parts.groupBy(*keys, "from").agg(F.max("to").alias("to"))
    single = single.withColumns({"_reach": F.max("to").over(earlier), "_farthest": F.max("to").over(whole)})
    begins = single.filter(F.col("_reach").isNull() | (F.col("from") > F.col("_reach") + 1))
    # a part ends where all those before the next beginning do
    return _flagged(begins.withColumn("to", F.coalesce(F.lead("_reach").over(by_cell), "_farthest")), width)


def kinds_of(results: DataFrame) -> DataFrame:
    """Results (import_key, from, to, success) as ranges that succeeded or failed; either kind is covered on reading."""
    return results.select("import_key", F.when(F.col("success"), SUCCEEDED).otherwise(FAILED).alias("kind"), "from", "to")


def add(spark: SparkSession, path: str, ranges: DataFrame, width: int) -> None:
    """Add ranges (import_key, kind, from, to) to the table; adding them again changes nothing."""
    # a batch is read by as many tasks as it has files, so its rows are dealt out before they are put together
    parts = in_cells(dealt(ranges, "import_key", "from", "to"), width)
    columns = ["import_key", "kind", "from", "to", CELL]
    rewrite_partitions(
        spark, path, in_cells(ranges, width), CELL,
        lambda stored: _merged(stored.select(*columns).unionByName(parts.select(*columns)), width),
        first=_merged(parts, width),
    )


def write_results(results: DataFrame, path: str, checkpoint: str, width: int) -> StreamingQuery:
    """Keep the table up to date with a stream of results."""

    def save(batch: DataFrame, _: int) -> None:
        add(batch.sparkSession, path, kinds_of(batch), width)

    writer = results.writeStream.outputMode("append").foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def parts_of(spark: SparkSession, path: str, width: int) -> DataFrame:
    """What is covered and what must be retried, in cells."""
    finish_merge(spark, path, CELL)
    stored = spark.read.parquet(path).withColumn(CELL, F.col(CELL).cast("long"))
    outcomes = {
        COVERED: lambda on: on[COVERED] | on[SUCCEEDED] | on[FAILED],
        RETRY: lambda on: on[FAILED] | (on[RETRY] & ~on[SUCCEEDED]),
    }
    # the parts of a cell are disjoint in each kind, so its width bounds them
    kinds = [COVERED, RETRY, SUCCEEDED, FAILED]
    return _flagged(intervals.combine_bounded(stored, ["import_key", CELL], "kind", kinds, outcomes), width)


def ranges_of(parts: DataFrame) -> DataFrame:
    """Parts put together: those inside their cell stand as they are, those at an edge go on where the next one begins."""
    # those inside spread over their cells, those at an edge meet by key, all in one exchange
    parts = parts.withColumn("_inside", F.when(~(F.col("at_start") | F.col("at_end")), F.col(CELL)))
    keys = ["import_key", "kind", "_inside"]
    along = Window.partitionBy(*keys).orderBy("from")
    goes_on = F.col("at_start") & (F.lag("to").over(along) == F.col("from") - 1)
    parts = parts.withColumn("_first", F.when(~F.coalesce(goes_on, F.lit(False)), F.col("from")))
    island = F.last("_first", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = parts.withColumn("_island", island).groupBy(*keys, F.col("_island").alias("from")).agg(F.max("to").alias("to"))
    return whole.select("import_key", "kind", "from", "to")


def settle(spark: SparkSession, path: str, settled: str, width: int) -> None:
    """Write what is covered and must be retried now as a table of its own, on which the next run's results build."""
    parts_of(spark, path, width).write.mode("overwrite").partitionBy(CELL).parquet(settled)
