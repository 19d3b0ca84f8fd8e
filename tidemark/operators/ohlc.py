"""Price rollups: average, high, low, open and close per feed and time bucket."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timegrid import TIME_BUCKETS, interval, time_bucket
from tidemark.operators.latest import first_by, last_by

PRICE_COLUMNS = ("price_avg", "price_high", "price_low", "price_open", "price_close")


def rollup(ticks: DataFrame, period: str, keys: Sequence[str] = ("price_feed_id",), exact: bool = False) -> DataFrame:
    """OHLC and average per bucket; ``exact`` also keeps sum and count, so that averages can be re-rolled."""
    extra = [F.sum(F.col("price").cast("double")).alias("price_sum"), F.count("price").alias("price_count")] if exact else []
    return (
        ticks.groupBy(*keys, time_bucket(period, F.col("datetime")).alias("_bucket"))
        .agg(
            F.avg(F.col("price").cast("double")).alias("price_avg"),
            F.max("price").alias("price_high"),
            F.min("price").alias("price_low"),
            first_by("price", "datetime", "block_number").alias("price_open"),
            last_by("price", "datetime", "block_number").alias("price_close"),
            *extra,
        )
        .withColumnRenamed("_bucket", "datetime")
    )


def rollup_between(
    ticks: DataFrame,
    period: str,
    lo: datetime | Column | None = None,
    hi: datetime | Column | None = None,
    keys: Sequence[str] = ("price_feed_id",),
) -> DataFrame:
    """The buckets from the one that holds ``lo`` to the one that holds ``hi``, whole ones, read off no other ticks: the
    bounds stand on the tick column itself, so they reach the files."""
    at = F.col("datetime")
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    if lo is not None:
        ticks = ticks.filter(at >= time_bucket(period, as_column(lo)))
    if hi is not None:
        ticks = ticks.filter(at < time_bucket(period, as_column(hi)) + interval(period))
    return rollup(ticks, period, keys)


def reroll(rolled: DataFrame, period: str, keys: Sequence[str] = ("price_feed_id",), exact: bool = False) -> DataFrame:
    """Coarser rollup of a rollup. The default averages the averages (approximate, by definition of that report);
    ``exact`` weighs them by their tick counts and needs an ``exact`` rollup below."""
    if exact:
        average = [
            (F.sum("price_sum") / F.sum("price_count")).alias("price_avg"),
            F.sum("price_sum").alias("price_sum"),
            F.sum("price_count").alias("price_count"),
        ]
    else:
        average = [F.avg("price_avg").alias("price_avg")]
    return (
        rolled.groupBy(*keys, time_bucket(period, F.col("datetime")).alias("_bucket"))
        .agg(
            *average,
            F.max("price_high").alias("price_high"),
            F.min("price_low").alias("price_low"),
            first_by("price_open", "datetime").alias("price_open"),
            last_by("price_close", "datetime").alias("price_close"),
        )
        .withColumnRenamed("_bucket", "datetime")
    )


def price_series(ticks: DataFrame, named_bucket: str, as_of: datetime, price_feed_id: int | None = None) -> DataFrame:
    """Rollup rows of a named bucket and range (``4h_3M``, ``1d_all``, ...) up to ``as_of``, from the ticks of the range."""
    size, reach = TIME_BUCKETS[named_bucket]
    if price_feed_id is not None:
        ticks = ticks.filter(F.col("price_feed_id") == price_feed_id)
    since = F.lit(as_of) - interval(reach)
    source = rollup_between(ticks, "1day" if size == "1day" else "1hour", since)
    recent = source.filter(F.col("datetime") > since)
    if size not in ("1hour", "1day"):
        recent = reroll(recent, size)
    return recent.select("price_feed_id", "datetime", *PRICE_COLUMNS)


def compact(series: DataFrame, columns: Sequence[str] = ("price_open", "price_high", "price_low", "price_close")) -> DataFrame:
    """Rows as JSON arrays ``[datetime, open, high, low, close]``."""
    cells = [F.to_json(F.struct(F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("v"))).substr(6, 26)]
    cells += [F.col(c).cast("double").cast("string") for c in columns]
    row = F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]"))
    return series.select("price_feed_id", "datetime", row.alias("row"))
