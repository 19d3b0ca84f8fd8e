"""Approximate holder counts kept as mergeable HLL sketches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timegrid import time_bucket
from tidemark.operators.latest import last_by

LG_K_ALL = 15
LG_K_SEGMENT = 13

# fixed values: USD segment name -> (at least, below); the last one is open-ended whatever its name says
SEGMENTS = {
    "0_10": (0, 10),
    "10_100": (10, 100),
    "100_1000": (100, 1_000),
    "1000_10000": (1_000, 10_000),
    "10000_100000": (10_000, 100_000),
    "100000_1000000": (100_000, None),
}
ALL = "approx_count_investor_hll_all"
SEGMENT_COLUMNS = {name: f"approx_count_investor_hll_{name}" for name in SEGMENTS}


def _in_segment(value: Column, low: int, high: int | None) -> Column:
    inside = value >= low
    return inside if high is None else inside & (value < high)


def holders_as_of(timeline: DataFrame, as_of: Column) -> DataFrame:
    """Last valued balance of each (product, investor) up to ``as_of``, positive balances only.

    Rows that did not move the balance (reward snapshots) are left out.
    """
    at = ("datetime", "block_number")
    return (
        timeline.filter((F.col("datetime") <= as_of) & (F.col("balance_diff") != 0))
        .groupBy("product_id", "investor_id")
        .agg(last_by("balance", *at).alias("share_balance"), last_by("usd_balance", *at).alias("usd_balance"))
        .filter(F.col("share_balance") > 0)
    )


def daily_snapshot(timeline: DataFrame, day: Column) -> DataFrame:
    """One row per product: a sketch of all holders and one per USD segment."""
    holders = holders_as_of(timeline, F.date_trunc("day", day))
    segments = [
        F.hll_sketch_agg(F.when(_in_segment(F.col("usd_balance"), *SEGMENTS[name]), F.col("investor_id")), LG_K_SEGMENT).alias(c)
        for name, c in SEGMENT_COLUMNS.items()
    ]
    return (
        holders.groupBy("product_id")
        .agg(F.hll_sketch_agg("investor_id", LG_K_ALL).alias(ALL), *segments)
        .select(time_bucket("1day", F.date_trunc("day", day)).alias("datetime"), "*")
    )


def daily_snapshots(timeline: DataFrame, days: DataFrame) -> DataFrame:
    """Snapshots for many days at once from per-day last balances.

    ``days`` has one ``datetime`` per day. Each holder's balance is turned into validity ranges, which only
    expand to the days they cover.
    """
    from pyspark.sql import Window

    at = ("datetime", "block_number")
    # a midnight row belongs to the snapshot of that very day, any later one to the next day's
    day_of = F.date_trunc("day", F.timestamp_micros(F.unix_micros("datetime") + F.lit(86_400_000_000 - 1)))
    per_day = (
        timeline.filter(F.col("balance_diff") != 0)
        .groupBy("product_id", "investor_id", day_of.alias("day"))
        .agg(last_by("balance", *at).alias("share_balance"), last_by("usd_balance", *at).alias("usd_balance"))
    )
    w = Window.partitionBy("product_id", "investor_id").orderBy("day")
    first, last = days.agg(F.min("datetime")), days.agg(F.max("datetime"))
    valid = (
        per_day.withColumn("_until", F.lead("day").over(w))
        .filter(F.col("share_balance") > 0)
        .withColumn("_last", F.coalesce(F.col("_until") - F.expr("INTERVAL 1 DAY"), last.scalar()))
        .withColumn("_first", F.greatest("day", first.scalar()))
        .withColumn("_last", F.least("_last", last.scalar()))
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn("datetime", F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 DAY"))))
    )
    segments = [
        F.hll_sketch_agg(F.when(_in_segment(F.col("usd_balance"), *SEGMENTS[name]), F.col("investor_id")), LG_K_SEGMENT).alias(c)
        for name, c in SEGMENT_COLUMNS.items()
    ]
    return (
        valid.join(days.select("datetime").distinct(), "datetime", "left_semi")
        .groupBy("datetime", "product_id")
        .agg(F.hll_sketch_agg("investor_id", LG_K_ALL).alias(ALL), *segments)
    )


def rollup_count(snapshots: DataFrame, group: Sequence[Column | str], column: str = ALL, out: str = "approx_investor_count") -> DataFrame:
    return snapshots.groupBy(*group).agg(F.hll_sketch_estimate(F.hll_union_agg(column, True)).alias(out))


def rebucketed_count(snapshots: DataFrame, keys: Sequence[str], inner: str, outer: str) -> DataFrame:
    """Estimate per inner bucket, then the last estimate per outer bucket."""
    fine = rollup_count(snapshots, [time_bucket(inner, F.col("datetime")).alias("datetime"), *keys])
    return (
        fine.groupBy(time_bucket(outer, F.col("datetime")).alias("time"), *keys)
        .agg(last_by("approx_investor_count", "datetime").alias("approx_investor_count"))
    )


def segment_counts(snapshots: DataFrame, group: Sequence[str] = ("datetime",)) -> DataFrame:
    return snapshots.groupBy(*group).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(c, True)).alias(f"count_{n}") for n, c in SEGMENT_COLUMNS.items()]
    )


def counts_before(snapshots: DataFrame, as_of: Column, days: Mapping[str, int]) -> DataFrame:
    """Per product, the last estimate (and its date) before ``as_of`` minus each number of days."""
    window = snapshots.filter(
        (F.col("datetime") < as_of - F.expr("INTERVAL 1 DAY")) & (F.col("datetime") >= as_of - F.expr("INTERVAL 31 DAY"))
    ).withColumn("_estimate", F.hll_sketch_estimate(ALL))
    outputs = []
    for name, n in days.items():
        before = F.col("datetime") < as_of - F.expr(f"INTERVAL {n} DAY")
        outputs.append(F.max(F.when(before, F.col("datetime"))).alias(f"{name}_datetime"))
        outputs.append(F.max_by("_estimate", F.when(before, F.col("datetime"))).alias(f"{name}_approx_investor_count"))
    return window.groupBy("product_id").agg(*outputs)


def count_growth(snapshots: DataFrame, start: Column, end: Column) -> DataFrame:
    """Per product, the last estimate before ``end`` against the last one before ``start``."""
    seen = snapshots.filter(F.col("datetime") < end).withColumn("_estimate", F.hll_sketch_estimate(ALL).cast("double"))
    earlier = F.when(F.col("datetime") < start, F.col("datetime"))
    compared = seen.groupBy("product_id").agg(
        F.max(earlier).alias("compare_to_datetime"),
        F.max("datetime").alias("recent_datetime"),
        F.max_by("_estimate", earlier).alias("compare_to_approx_investor_count"),
        F.max_by("_estimate", "datetime").alias("recent_approx_investor_count"),
    )
    diff = F.col("recent_approx_investor_count") - F.col("compare_to_approx_investor_count")
    return compared.withColumns(
        {
            "approx_investor_count_diff": diff,
            "approx_investor_count_diff_percent": F.try_divide(diff, F.col("compare_to_approx_investor_count")),
        }
    )
