"""First / last value by time, and keep-first dedupe. All are aggregates with a map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_by(value: Column | str, *order: str) -> Column:
    """Value at the greatest ``order``; a NULL at that row stays NULL."""
    return F.max_by(value, F.struct(*order))


def first_by(value: Column | str, *order: str) -> Column:
    return F.min_by(value, F.struct(*order))


def last_per_key(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str] = ("datetime", "block_number")
) -> DataFrame:
    return df.groupBy(*keys).agg(*[last_by(v, *order).alias(v) for v in values])


def current_holders(
    ledger: DataFrame,
    keys: Sequence[str] = ("product_id", "investor_id"),
    order: Sequence[str] = ("datetime", "block_number"),
    balance: str = "balance",
) -> DataFrame:
    """Keys whose last balance is above zero."""
    last = ledger.groupBy(*keys).agg(
        last_by(balance, *order).alias("last_balance"),
        F.max(F.struct(*order)).alias("_at"),
    )
    return last.filter(F.col("last_balance") > 0).select(
        *keys, "last_balance", *[F.col("_at")[c].alias(f"last_{c}") for c in order]
    )


def keep_first(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One row per key: the earliest to arrive (``dropDuplicates`` would keep any of them)."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*arrival)).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
        .select(*df.columns)
    )


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key; Spark limits each task's groups to ``n`` rows before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
