"""Joins on time: same bucket, nearest within a tolerance, and the k rows on each side of an instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timegrid import cell, epoch_seconds_between, interval, micros, time_bucket
from tidemark.operators.latest import last_by
from tidemark.operators.scan import Run, running


def same_bucket(
    probes: DataFrame,
    ticks: DataFrame,
    period: str = "15min",
    key: str = "price_feed_id",
    ts: str = "datetime",
    values: Sequence[str] = ("price", "block_number"),
    prefix: str = "match_",
) -> DataFrame:
    """Each probe with the last tick of its own bucket (which may be later than the probe), else NULLs.

    Ticks shrink to one row per (key, bucket) first, so a hot bucket never multiplies rows in the join.
    """
    order = (ts, "block_number")
    per_bucket = (
        ticks.groupBy(F.col(key), time_bucket(period, F.col(ts)).alias("_bucket"))
        .agg(
            *[last_by(v, *order).alias(prefix + v) for v in values],
            F.max(ts).alias(prefix + ts),
        )
    )
    return (
        probes.withColumn("_bucket", time_bucket(period, F.col(ts)))
        .join(per_bucket, [key, "_bucket"], "left")
        .drop("_bucket")
    )


def nearest(
    probes: DataFrame,
    ticks: DataFrame,
    key: str,
    tolerance: Column,
    values: Sequence[str],
    ts: str = "datetime",
    tie: str = "block_number",
    prefix: str = "near_",
    cell_hours: float = 1.0,
) -> DataFrame:
    """Each probe with the closest tick of its key at most ``tolerance`` away, on either side, else NULLs.

    Ticks and probes are merged into one ordered stream per (key, time cell): the tick before and the tick
    after are running values, so no probe-tick pairs are formed. Equal distances go to the earlier tick, equal
    times to the lower ``tie``.
    """
    kept = [tie, *[v for v in values if v != tie]]
    tick = F.struct(F.col(ts).alias("t"), *[F.col(v) for v in kept])
    per_instant = ticks.groupBy(F.col(key), F.col(ts)).agg(F.min(tick).alias("_tick"))
    stream = (
        probes.withColumn("_is_probe", F.lit(1))
        .unionByName(per_instant.withColumn("_is_probe", F.lit(0)), allowMissingColumns=True)
    )
    at = cell(F.col(ts), cell_hours)
    order = [ts, "_is_probe"]
    tick_around = {"_before": Run("last", F.col("_tick")), "_after": Run("last", F.col("_tick"), reverse=True)}
    stream = running(stream, [key], order, at, tick_around)
    limit = F.unix_micros(F.lit(0).cast("timestamp") + tolerance)
    now = F.unix_micros(ts)
    gap_before = now - F.unix_micros(F.col("_before.t"))
    gap_after = F.unix_micros(F.col("_after.t")) - now
    before = F.when(gap_before <= limit, F.col("_before"))
    after = F.when(gap_after <= limit, F.col("_after"))
    best = F.when(before.isNull(), after).when(after.isNull(), before).when(gap_after < gap_before, after).otherwise(before)
    return (
        stream.filter(F.col("_is_probe") == 1)
        .withColumn("_best", best)
        .withColumns(
            {prefix + ts: F.col("_best.t"), **{prefix + v: F.col(f"_best.{v}") for v in values}}
        )
        .drop("_is_probe", "_tick", "_before", "_after", "_best")
    )


def around(
    rows: DataFrame,
    instant: Column,
    look_around: str,
    half_limit: int,
    keys: Sequence[str] = (),
    ts: str = "datetime",
    tie: str = "block_number",
) -> DataFrame:
    """Up to ``half_limit`` rows on each side of an instant, per key, with their rounded distance in seconds."""
    window = rows.filter(F.col(ts).between(instant - interval(look_around), instant + interval(look_around)))
    later = F.col(ts) > instant
    side = window.withColumn("_later", later).withColumn("_gap", F.abs(F.unix_micros(ts) - F.unix_micros(instant)))
    rank = F.row_number().over(Window.partitionBy(*keys, "_later").orderBy("_gap", tie))
    return (
        side.withColumn("_rank", rank)
        .filter(F.col("_rank") <= half_limit)
        .withColumn("diff_sec", epoch_seconds_between(F.col(ts), instant))
        .drop("_later", "_gap", "_rank")
    )


def first_at_or_above(rows: DataFrame, block: Column, keys: Sequence[str] = ("chain",), ts: str = "datetime") -> DataFrame:
    """Per key, the earliest row whose block number is at least ``block``."""
    return (
        rows.filter(F.col("block_number") >= block)
        .groupBy(*keys)
        .agg(F.min(F.struct(ts, "block_number")).alias("_row"))
        .select(*keys, F.col(f"_row.{ts}").alias(ts), F.col("_row.block_number").alias("block_number"))
    )


def interpolated_price(
    probes: DataFrame,
    ticks: DataFrame,
    bucket: str = "15min",
    window: str = "3days",
    key: str = "price_feed_id",
    ts: str = "datetime",
    out: str = "interpolated_price",
    cell_hours: float = 1.0,
) -> DataFrame:
    """Price of the probe's bucket read off a gap-filled, linearly interpolated bucket-average series.

    Only ticks within ``window`` of the probe count. Bucket averages are shared by all probes; just the two end
    buckets of a probe's span are cut by it, and a neighbour found there is averaged again over its inner part.
    """
    b, w = micros(bucket), micros(window)
    number = {"v": F.col("price").cast("double"), "b": F.col("block_number").cast("double")}
    averages = (
        ticks.groupBy(F.col(key), F.unix_micros(time_bucket(bucket, F.col(ts))).alias("_at"))
        .agg(*[F.avg(column).alias(f"_{name}") for name, column in number.items()])
        .select(key, "_at", F.struct(F.col("_at").alias("t"), F.col("_v").alias("v"), F.col("_b").alias("b")).alias("_tick"))
    )
    asked = probes.withColumn("_at", F.unix_micros(time_bucket(bucket, F.col(ts)))).withColumn("_is_probe", F.lit(1))
    stream = asked.unionByName(averages.withColumn("_is_probe", F.lit(0)), allowMissingColumns=True)
    at = F.floor(F.col("_at") / F.lit(int(cell_hours * 3_600_000_000))).cast("long")
    order = ["_at", "_is_probe"]
    tick_around = {"_prev": Run("last", F.col("_tick")), "_next": Run("last", F.col("_tick"), reverse=True)}
    stream = running(stream, [key], order, at, tick_around)

    start = lambda us: F.unix_micros(time_bucket(bucket, F.timestamp_micros(us)))
    span = {"_low": F.unix_micros(ts) - F.lit(w), "_high": F.unix_micros(ts) + F.lit(w)}
    found = stream.filter(F.col("_is_probe") == 1).withColumns(span)
    found = found.withColumns(
        {
            "_prev": F.when(F.col("_prev.t") >= start(F.col("_low")), F.col("_prev")),
            "_next": F.when(F.col("_next.t") <= start(F.col("_high")), F.col("_next")),
        }
    )
    cut_prev = F.col("_prev.t") == start(F.col("_low"))
    cut_next = F.col("_next.t") == start(F.col("_high"))
    inner = _cut_buckets(probes.select(key, ts).distinct().select(key, *[c.alias(n) for n, c in span.items()]), ticks, bucket, key, ts, number)
    for side in ("_low", "_high"):
        one_side = inner.filter(F.col("_side") == side).select(key, F.col("_edge").alias(side), F.col("_inner").alias(f"_inner{side}"))
        found = found.join(one_side, [key, side], "left")
    p = F.when(cut_prev, F.col("_inner_low")).otherwise(F.col("_prev"))
    n = F.when(cut_next, F.col("_inner_high")).otherwise(F.col("_next"))
    t = F.col("_at")

    def value(field: str) -> Column:
        line = p[field] + (n[field] - p[field]) * (t - p["t"]) / (n["t"] - p["t"])
        return F.when(p["t"] == t, p[field]).when(n["t"] > p["t"], line)

    return found.withColumns({out: value("v"), f"{out}_block": value("b")}).drop(
        "_is_probe", "_at", "_tick", "_prev", "_next", "_low", "_high", "_inner_low", "_inner_high"
    )


def _cut_buckets(
    spans: DataFrame, ticks: DataFrame, bucket: str, key: str, ts: str, number: dict[str, Column]
) -> DataFrame:
    """Averages of a span's first bucket from its low end on, and of its last bucket up to its high end."""
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("at")) for side in ("_low", "_high")])
    edges = spans.select(key, F.explode(sides).alias("_end")).select(
        key, F.col("_end.side").alias("_side"), F.col("_end.at").alias("_edge"), F.lit(1).alias("_is_edge")
    )
    bucket_of = lambda at: F.unix_micros(time_bucket(bucket, at))
    edges = edges.withColumn("_bucket", bucket_of(F.timestamp_micros("_edge")))
    rows = ticks.select(
        key,
        F.unix_micros(ts).alias("_edge"),
        F.lit(0).alias("_is_edge"),
        *[c.alias(f"_{n}") for n, c in number.items()],
        bucket_of(F.col(ts)).alias("_bucket"),
    ).join(edges.select(key, "_bucket").distinct(), [key, "_bucket"], "left_semi")  # only buckets that an edge cuts
    stream = edges.unionByName(rows, allowMissingColumns=True).withColumns(
        {
            # at equal times a low end comes before the ticks and a high end after them, so both include them
            "_turn": F.when(F.col("_side") == "_low", -1).when(F.col("_side") == "_high", 1).otherwise(0),
        }
    )
    summed = {"_count": F.when(F.col("_is_edge") == 0, 1), **{f"_sum_{n}": F.col(f"_{n}") for n in number}}
    outputs = {f"{n}_up": Run("sum", c) for n, c in summed.items()}
    outputs |= {f"{n}_down": Run("sum", c, reverse=True) for n, c in summed.items()}
    minute = F.floor(F.col("_edge") / F.lit(60_000_000)).cast("long")
    counted = running(stream, [key, "_bucket"], ["_edge", "_turn"], minute, outputs).filter(F.col("_is_edge") == 1)

    def chosen(name: str) -> Column:
        return F.when(F.col("_side") == "_low", F.col(f"{name}_down")).otherwise(F.col(f"{name}_up"))

    inner = F.struct(F.col("_bucket").alias("t"), *[(chosen(f"_sum_{n}") / chosen("_count")).alias(n) for n in number])
    return counted.select(key, "_side", "_edge", F.when(chosen("_count") > 0, inner).alias("_inner"))
