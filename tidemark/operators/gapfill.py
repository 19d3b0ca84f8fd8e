"""Dense time grids, carry-forward and interpolation.

Inputs are reduced to one row per (key, bucket) before anything is ordered, so the per-key windows below see at
most as many rows as the grid has buckets, whatever the number of raw rows behind them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timegrid import interval, time_bucket


def grid(keys_df: DataFrame, keys: Sequence[str], lo: Column, hi: Column, period: str, out: str = "datetime") -> DataFrame:
    """One row per key and bucket from the bucket of ``lo`` to the bucket of ``hi``."""
    steps = F.sequence(time_bucket(period, lo), time_bucket(period, hi), interval(period))
    return keys_df.select(*keys).distinct().withColumn(out, F.explode(steps))


def gapfill(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    lo: Column,
    hi: Column,
    aggs: Mapping[str, Column],
    ts: str = "datetime",
) -> DataFrame:
    """Aggregate per (key, bucket) inside [lo, hi] and add the empty buckets with NULL values."""
    filled = (
        df.filter(F.col(ts).between(lo, hi))
        .withColumn("_bucket", time_bucket(period, F.col(ts)))
        .groupBy(*keys, "_bucket")
        .agg(*[agg.alias(name) for name, agg in aggs.items()])
    )
    dense = grid(filled, keys, lo, hi, period, "_bucket")
    return dense.join(filled, [*keys, "_bucket"], "left").withColumnRenamed("_bucket", ts)


def locf(df: DataFrame, keys: Sequence[str], columns: Sequence[str], ts: str = "datetime") -> DataFrame:
    """Carry the last known value forward; values before the first known one stay NULL."""
    w = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def interpolate(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    out: str | None = None,
    ts: str = "datetime",
    next_at: Column | None = None,
    next_value: Column | None = None,
) -> DataFrame:
    """Linear interpolation between known points; NULL outside them.

    ``next_at`` and ``next_value`` give a known point to the right of the grid.
    """
    known = F.when(F.col(column).isNotNull(), F.struct(F.unix_micros(ts).alias("t"), F.col(column).cast("double").alias("v")))
    back = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    after = F.first(F.col("_known"), ignorenulls=True).over(ahead)
    if next_at is not None:
        edge = F.struct(F.unix_micros(next_at).alias("t"), next_value.cast("double").alias("v"))
        after = F.coalesce(after, edge)
    spanned = df.withColumn("_known", known).withColumns(
        {"_prev": F.last("_known", ignorenulls=True).over(back), "_next": after}
    )
    t = F.unix_micros(ts)
    p, n = F.col("_prev"), F.col("_next")
    line = p["v"] + (n["v"] - p["v"]) * (t - p["t"]) / (n["t"] - p["t"])
    value = F.when(F.col(column).isNotNull(), F.col(column).cast("double")).when(n["t"] > p["t"], line)
    return spanned.withColumn(out or column, value).drop("_known", "_prev", "_next")
