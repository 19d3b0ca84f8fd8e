"""Exact distinct counts that can be rolled up: bitmaps of ids.

Ids fall into buckets of 32,768, and a group has one bitmap of 4 KB for each bucket that it meets. Bitmaps of any
groups can be joined by OR without counting an id twice, so a count per chain comes from those per product, and one over
a week from those per day, as with sketches, but exactly. They are built with partial aggregation: what is shuffled is
bitmaps, never ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timegrid import interval, time_bucket
from tidemark.operators.latest import last_by

BUCKET, IDS = "id_bucket", "ids"


def build(rows: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """One bitmap per ``keys`` and bucket of the ids; NULL ids are in none."""
    known = rows.filter(F.col(id_col).isNotNull())
    place = F.col(id_col).cast("bigint")
    return known.groupBy(*keys, F.bitmap_bucket_number(place).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(IDS)
    )


def roll_up(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(IDS).alias(IDS))


def counts(bitmaps: DataFrame, keys: Sequence[str], out: str = "investor_count") -> DataFrame:
    """How many distinct ids each group has."""
    return roll_up(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count(IDS)).alias(out))


def holders(ledger: DataFrame, keys: Sequence[str], period: str, lo: Column, hi: Column, id_col: str = "investor_id") -> DataFrame:
    """Per ``keys`` and time bucket (``datetime``) the bitmaps of those whose balance, carried forward, is positive.

    A NULL last balance keeps the state before it; what was held before ``lo`` is not looked up. Everyone's stretch of
    holding is spread over its time buckets inside the task that knows it and meets the others as a bitmap.
    """
    last = (
        ledger.filter(F.col("datetime").between(lo, hi))
        .groupBy(*keys, id_col, time_bucket(period, F.col("datetime")).alias("_from"))
        .agg(last_by("balance", "datetime", "block_number").alias("balance"))
        .filter(F.col("balance").isNotNull())
    )
    after = F.lead("_from").over(Window.partitionBy(*keys, id_col).orderBy("_from"))
    held = last.withColumn("_until", F.coalesce(after - interval(period), time_bucket(period, hi))).filter(F.col("balance") > 0)
    dense = held.select(*keys, id_col, F.explode(F.sequence("_from", "_until", interval(period))).alias("datetime"))
    return build(dense, [*keys, "datetime"], id_col)
