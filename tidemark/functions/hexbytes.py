"""Addresses and hashes: BINARY in storage, lower-case ``0x`` text on display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_ADDRESS = "0x" + "0" * 40


def to_hex_text(value: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(value)))


def from_hex_text(text: Column) -> Column:
    return F.unhex(F.substring(text, 3, 2**31 - 1))


def is_address(text: Column) -> Column:
    return F.coalesce(text.rlike("^0x[0-9a-fA-F]{40}$"), F.lit(False))
