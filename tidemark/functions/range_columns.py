"""Column functions on one closed range, or on a short ARRAY<STRUCT<from,to>> held in one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGES_JSON = "array<struct<from:bigint,to:bigint>>"
DATE_RANGES_JSON = "array<struct<from:timestamp,to:timestamp>>"


def is_valid(lo: Column, hi: Column) -> Column:
    return lo <= hi


def size(lo: Column, hi: Column) -> Column:
    """Members of a closed integer range; an inverted one is empty."""
    return F.greatest(F.lit(0).cast("bigint"), hi - lo + F.lit(1))


def contains_value(lo: Column, hi: Column, value: Column) -> Column:
    return value.between(lo, hi)


def includes(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    return (lo_a <= lo_b) & (hi_b <= hi_a)


def overlaps(lo_a: Column, hi_a: Column, lo_b: Column, hi_b: Column) -> Column:
    return (lo_a <= hi_b) & (lo_b <= hi_a)


def midpoint(lo: Column, hi: Column) -> Column:
    return F.floor((lo + hi + F.lit(1)) / F.lit(2)).cast("bigint")


def ranges_size_sum(ranges: Column) -> Column:
    """Sum of ``to - from + 1``; 0 for an empty array, NULL for NULL."""
    return F.aggregate(
        ranges, F.lit(0).cast("bigint"), lambda acc, r: acc + (r["to"] - r["from"] + F.lit(1))
    )


def date_range_size_ms(lo: Column, hi: Column) -> Column:
    return F.unix_millis(hi) - F.unix_millis(lo) + F.lit(1)


def date_ranges_size_sum_ms(ranges: Column) -> Column:
    return F.aggregate(
        ranges, F.lit(0).cast("bigint"), lambda acc, r: acc + date_range_size_ms(r["from"], r["to"])
    )


def any_range_contains(ranges: Column, value: Column) -> Column:
    return F.exists(ranges, lambda r: value.between(r["from"], r["to"]))


def any_range_includes(ranges: Column, lo: Column, hi: Column) -> Column:
    return F.exists(ranges, lambda r: (r["from"] <= lo) & (hi <= r["to"]))
