"""A dyadic index of ranges, so that "which range holds this point" is an equality join.

Every range is cut into aligned blocks of a power of two, at most two of each size; a point lies in a range if one of the
blocks around it, one for each size, is among them. Only sizes that occur are looked up, and there are as many as the
longest range has bits. The join needs no sort and no order along the key; a key with most of the points spreads over
its blocks, and adaptive execution can split what is left.

The blocks of a key are told by their size (``_level``: 2^level places) and number (``_block``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

WORD = 6  # 2^6 places to a word

def _floor(value: Column, level: Column) -> Column:
    """The block of a size that holds a place; also for places below zero."""
    return F.call_function("shiftright", value.cast("bigint"), level.cast("int"))


def _blocks(lo: Column, hi: Column) -> Column:
    """The aligned blocks that make up [lo, hi], at most two of each size."""
    lo, after = lo.cast("bigint"), hi.cast("bigint") + 1
    levels = F.sequence(F.lit(0), F.floor(F.log2((after - lo).cast("double"))).cast("int"))

    def at(level: Column) -> Column:
        first, end = -_floor(-lo, level), _floor(after, level)
        left = F.when((first < end) & (first.bitwiseAND(F.lit(1)) == 1), first)
        right = F.when((first + first.bitwiseAND(F.lit(1)) < end) & (end.bitwiseAND(F.lit(1)) == 1), end - 1)
        block = lambda b: F.when(b.isNotNull(), F.struct(level.alias("_level"), b.alias("_block")))
        return F.array(block(left), block(right))

    return F.when(lo < after, F.filter(F.flatten(F.transform(levels, at)), lambda b: b.isNotNull()))


def index(ranges: DataFrame, keys: Sequence[str], value: Column | None = None) -> DataFrame:
    """The distinct blocks of each key's ranges; with ``value`` the largest of them for each block, as ``_value``."""
    kept = [value.alias("_value")] if value is not None else []
    blocks = ranges.select(*keys, F.explode(_blocks(F.col("from"), F.col("to"))).alias("_b"), *kept)
    blocks = blocks.select(*keys, "_b._level", "_b._block", *(["_value"] if kept else [])).groupBy(*keys, "_level", "_block")
    return blocks.agg((F.max("_value") if kept else F.lit(True)).alias("_value"))


def _landed(indexed: DataFrame) -> DataFrame:
    """An index as a written table: its sizes are asked for first, then it is joined."""
    path = scratch_path(indexed.sparkSession, "dyadic")
    indexed.write.parquet(path)
    return indexed.sparkSession.read.parquet(path)


def levels_of(indexed: DataFrame) -> list[int]:
    """The sizes that occur: 63 at most."""
    return sorted(r[0] for r in indexed.select("_level").distinct().collect())


def _around(position: Column, levels: Sequence[int]) -> Column:
    """The blocks around a place, one for each size."""
    blocks = [F.struct(F.lit(k).alias("_level"), _floor(position, F.lit(k)).alias("_block")) for k in levels]
    return F.array(*blocks)


def _asked(points: DataFrame, position: str, levels: Sequence[int]) -> DataFrame:
    around = points.withColumn("_b", F.explode(_around(F.col(position), levels)))
    return around.withColumns({"_level": F.col("_b._level"), "_block": F.col("_b._block")}).drop("_b")


def without_inner(indexed: DataFrame, keys: Sequence[str], levels: Sequence[int]) -> DataFrame:
    """Blocks that no larger block of their key holds, so that a place lies in one of them at most."""
    larger = [k for k in levels if k > levels[0]]
    if not larger:
        return indexed
    above = F.array(*(F.when(F.col("_level") < k, F.struct(F.lit(k).alias("_level"), F.call_function("shiftright", F.col("_block"), F.lit(k) - F.col("_level")).alias("_block"))) for k in larger))
    up = indexed.select(*keys, F.col("_level").alias("_own"), F.col("_block").alias("_own_block"), F.explode(F.filter(above, lambda b: b.isNotNull())).alias("_b"))
    up = up.select(*keys, "_own", "_own_block", "_b._level", "_b._block")
    inner = up.join(indexed.select(*keys, "_level", "_block"), [*keys, "_level", "_block"], "left_semi")
    inner = inner.select(*keys, F.col("_own").alias("_level"), F.col("_own_block").alias("_block")).distinct()
    return indexed.join(inner, [*keys, "_level", "_block"], "left_anti")


def word_index(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An index with all blocks of up to 64 places as bits: a row per key and aligned word of 64 places, ``_value`` telling
    which of them are held. Larger blocks are rows as before, of which every bit is set."""
    lo, hi = F.col("from").cast("bigint"), F.col("to").cast("bigint")
    first, last = _floor(lo, F.lit(WORD)), _floor(hi, F.lit(WORD))
    in_word = lambda c: c.bitwiseAND(F.lit((1 << WORD) - 1)).cast("int")
    row = lambda level, block, bits: F.struct(level.cast("int").alias("_level"), block.alias("_block"), bits.alias("_value"))
    every = F.lit(-1).cast("bigint")

    def bits(a: Column, b: Column) -> Column:
        return F.call_function("shiftleft", F.call_function("shiftrightunsigned", every, F.lit(63) - (b - a)), a)

    ends = F.when(first == last, F.array(row(F.lit(WORD), first, bits(in_word(lo), in_word(hi))))).otherwise(
        F.array(row(F.lit(WORD), first, bits(in_word(lo), F.lit(63))), row(F.lit(WORD), last, bits(F.lit(0), in_word(hi))))
    )
    # whole words between the two ends
    between = F.coalesce(_blocks(first + 1, last - 1), F.array().cast("array<struct<_level: int, _block: bigint>>"))
    larger = F.transform(between, lambda b: row(b["_level"] + WORD, b["_block"], every))
    blocks = ranges.filter(lo <= hi).select(*keys, F.explode(F.concat(ends, larger)).alias("_b"))
    blocks = blocks.select(*keys, "_b._level", "_b._block", "_b._value").groupBy(*keys, "_level", "_block")
    return blocks.agg(F.bit_or("_value").alias("_value"))


def points_inside(points: DataFrame, ranges: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Points lying in at least one range of their key; each row once, however many ranges hold it.

    A point is asked for once for its word of 64 places, and once for each size of larger blocks that occurs."""
    indexed = _landed(word_index(ranges, keys))
    levels = levels_of(indexed)
    if not levels:
        return points.limit(0)
    alone = without_inner(indexed, keys, levels)
    place = F.col(position).cast("bigint").bitwiseAND(F.lit((1 << WORD) - 1)).cast("int")
    held = F.call_function("shiftright", F.col("_value"), place).bitwiseAND(F.lit(1)) == 1
    return _asked(points, position, levels).join(alone, [*keys, "_level", "_block"]).filter(held).select(*points.columns)


def largest_at(points: DataFrame, ranges: DataFrame, keys: Sequence[str], position: str, value: Column, out: str) -> DataFrame:
    """Distinct points with the largest ``value`` of the ranges of their key that hold them; points in no range are left out."""
    indexed = _landed(index(ranges, keys, value))
    levels = levels_of(indexed)
    if not levels:
        return points.limit(0).withColumn(out, F.lit(None).cast("int"))
    found = _asked(points, position, levels).join(indexed, [*keys, "_level", "_block"])
    return found.groupBy(*points.columns).agg(F.max("_value").alias(out))
