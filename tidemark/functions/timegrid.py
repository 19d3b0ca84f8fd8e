"""Fixed-length sampling periods and time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEC, _MIN, _HOUR, _DAY = 1_000, 60_000, 3_600_000, 86_400_000

# fixed values: sampling period names and their length in milliseconds (a month is 30 days, a year 365)
SAMPLING_MS = {
    "1sec": 1 * _SEC,
    "5sec": 5 * _SEC,
    "10sec": 10 * _SEC,
    "15sec": 15 * _SEC,
    "30sec": 30 * _SEC,
    "1min": 1 * _MIN,
    "5min": 5 * _MIN,
    "15min": 15 * _MIN,
    "30min": 30 * _MIN,
    "1hour": 1 * _HOUR,
    "2hour": 2 * _HOUR,
    "4hour": 4 * _HOUR,
    "1day": 1 * _DAY,
    "3days": 3 * _DAY,
    "1week": 7 * _DAY,
    "1month": 30 * _DAY,
    "3months": 90 * _DAY,
    "1year": 365 * _DAY,
    "100year": 36_500 * _DAY,
}

# fixed values: time-bucket request names -> (bucket size, time range)
TIME_BUCKETS = {
    "1h_1d": ("1hour", "1day"),
    "1h_1w": ("1hour", "1week"),
    "1h_1M": ("1hour", "1month"),
    "4h_3M": ("4hour", "3months"),
    "1d_1M": ("1day", "1month"),
    "1d_1Y": ("1day", "1year"),
    "1d_all": ("1day", "100year"),
}

# Monday 2000-01-03 00:00 UTC: multi-day buckets count from here, not from 1970-01-01 as window() does
ORIGIN_MICROS = 946_857_600_000_000


def micros(period: str) -> int:
    return SAMPLING_MS[period] * 1_000


def interval(period: str) -> Column:
    return F.expr(f"INTERVAL '{SAMPLING_MS[period] // 1000}' SECOND")


def bucket_index(ts: Column, period: str) -> Column:
    """Number of whole periods since the origin; monotone in ``ts``."""
    return F.floor((F.unix_micros(ts) - F.lit(ORIGIN_MICROS)) / F.lit(micros(period))).cast("long")


def time_bucket(period: str, ts: Column) -> Column:
    """Start of the bucket ``ts`` falls in."""
    width = F.lit(micros(period))
    at = F.unix_micros(ts)
    return F.timestamp_micros(at - F.pmod(at - F.lit(ORIGIN_MICROS), width))


def cell(ts: Column, hours: float = 1.0) -> Column:
    """Coarse time cell used to split one key's history over many tasks."""
    return F.floor(F.unix_micros(ts) / F.lit(int(hours * 3_600_000_000))).cast("long")


def epoch_seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds, rounded half away from zero (a plain cast would truncate)."""
    return F.round((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)).cast("int")


def iso_to_timestamp(text: Column) -> Column:
    """ISO-8601 text with ``Z`` or an hour offset."""
    return F.to_timestamp(text)
