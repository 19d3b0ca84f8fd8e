"""Decoding of event-log words."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: first topic of the three event kinds (keccak-256 of the event signature)
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
STAKED_TOPIC = "0x9e71bc8eea02a63969f509818f2dafb9254532904319f9dbda79b67bd34a5f3d"
WITHDRAWN_TOPIC = "0x7084f5476618d8e60b11ef0d7d3f06914655adb8793e28ff7f018d4c76d505d5"

EVENT_BY_TOPIC = {TRANSFER_TOPIC: "Transfer", STAKED_TOPIC: "Staked", WITHDRAWN_TOPIC: "Withdrawn"}


def event_name(topic: Column) -> Column:
    name = F.lit(None).cast("string")
    for known, label in EVENT_BY_TOPIC.items():
        name = F.when(F.lower(topic) == known, F.lit(label)).otherwise(name)
    return name


def topic_address(topic: Column) -> Column:
    """Indexed address: the last 20 bytes of a 32-byte topic."""
    return F.concat(F.lit("0x"), F.lower(F.substring(topic, 27, 40)))


def address_topic(address: Column) -> Column:
    return F.concat(F.lit("0x"), F.lit("0" * 24), F.lower(F.substring(address, 3, 40)))


def fits_decimal(word: Column) -> Column:
    """Whether a 32-byte hex word is below 75 * 2^120, just under 10^38; cheap, as it only compares text."""
    return (F.length(word) == 66) & (F.substring(word, 3, 32) == "0" * 32) & (F.lower(F.substring(word, 35, 2)) < "4b")


def uint256(word: Column) -> Column:
    """32-byte hex word as DECIMAL(38,0); NULL where it does not fit.

    Hex digits are read in limbs of 15 (60 bits each, exact in a BIGINT) and summed in DECIMAL.
    """

    def limb(start: int, length: int) -> Column:
        return F.conv(F.substring(word, start, length), 16, 10).cast("decimal(20,0)")

    base = F.lit(2**60).cast("decimal(20,0)")
    low = (limb(37, 15) * base).cast("decimal(38,0)") + limb(52, 15)
    high = ((limb(35, 2) * base).cast("decimal(38,0)") * base).cast("decimal(38,0)")
    return F.when(fits_decimal(word), (high + low).cast("decimal(38,0)"))


def uint256_word(value: Column) -> Column:
    """Non-negative BIGINT as a 32-byte hex word."""
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(value)), 64, "0"))


def scaled(amount: Column, decimals: Column) -> Column:
    """Chain integer to token units: ``amount / 10^decimals``, exact in DECIMAL(38,18) up to 18 decimals.

    The shift is made on the digits, because dividing two decimals would round. Fails on what ``fits_scaled`` rejects.
    """
    return _shifted(amount, decimals).cast("decimal(38,18)")


def fits_scaled(amount: Column, decimals: Column) -> Column:
    """Whether ``scaled`` can hold the amount: below 10^20 units either way."""
    at = (F.greatest(F.least(decimals, F.lit(17)), F.lit(0)) + 1).cast("int")
    # both ends are listed: the negative of a DECIMAL is rounded to 34 digits
    limit = lambda sign: F.element_at(F.array(*(F.lit(Decimal(sign * 10**d)).cast("decimal(38,0)") for d in range(20, 38))), at)
    inside = (amount > limit(-1)) & (amount < limit(1))
    return amount.isNull() | decimals.isNull() | (decimals > 17) | inside


def _shifted(amount: Column, decimals: Column) -> Column:
    digits = F.lpad(F.ltrim(amount.cast("string"), F.lit("-")), 58, "0")
    sign = F.when(amount < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(
        sign, digits.substr(F.lit(1), F.lit(58) - decimals), F.lit("."), digits.substr(F.lit(59) - decimals, decimals)
    )


def share_rate(price_per_full_share: Column, share_decimals: Column, underlying_decimals: Column) -> Column:
    """``round(10^m * ppfs / 10^(m+u), m)``: how many underlying tokens one share is worth."""
    ratio = price_per_full_share.cast("double") / F.pow(F.lit(10.0), underlying_decimals)
    scale = F.pow(F.lit(10.0), share_decimals)
    return F.round(ratio * scale) / scale
