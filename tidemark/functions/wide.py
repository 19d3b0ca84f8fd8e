"""Whole numbers of up to 93 digits, for amounts that no DECIMAL holds.

A number is a struct of ``LIMBS`` signed BIGINT limbs, each worth 2^24 times the one before. A 256-bit word is read limb by
limb; sums are plain sums of limbs, with room for 2^39 rows before a limb is full, so they combine on the map side and
need no carry. Carries are made once, where a number is shown, compared or taken to a DOUBLE. Text has all digits, shifted
by a number of decimals; nothing is ever rounded.

Carries and digits are worked out on whole Arrow batches: a number in range is 39 bytes, three for each limb, which Python
reads and writes as one integer. Everything else is plain column arithmetic.

A NULL number has NULL limbs. What doesn't fit 2^312 gives NULL where it is read and fails the job (by overflow of a limb)
where it is summed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

BITS, LIMBS, WORD_LIMBS = 24, 13, 11
WIDTH = 99  # digits, which hold 2^312
_MASK, _TOP, _SIZE = (1 << BITS) - 1, 1 << BITS * LIMBS, BITS // 8 * LIMBS

FIELDS = [f"n{i}" for i in range(LIMBS)]
TYPE = "struct<" + ", ".join(f"{f}: bigint" for f in FIELDS) + ">"


def _number(limbs: Sequence[Column]) -> Column:
    return F.struct(*(limb.cast("bigint").alias(f) for f, limb in zip(FIELDS, limbs)))


def limbs(number: Column) -> list[Column]:
    return [number[f] for f in FIELDS]


def known(number: Column) -> Column:
    return number[FIELDS[0]].isNotNull()


def is_word(word: Column) -> Column:
    return F.coalesce(word.rlike("^0x[0-9a-fA-F]{64}$"), F.lit(False))


def from_word(word: Column) -> Column:
    """A 32-byte hex word; NULL if it is none."""
    digits = BITS // 4
    starts = [67 - digits * (i + 1) for i in range(WORD_LIMBS - 1)]
    texts = [F.substring(word, s, digits) for s in starts] + [F.substring(word, 3, 64 - digits * (WORD_LIMBS - 1))]
    read = [F.conv(t, 16, 10).cast("bigint") for t in texts]
    return F.when(is_word(word), _number(read + [F.lit(0)] * (LIMBS - WORD_LIMBS)))


def negated(number: Column) -> Column:
    return _number([-x for x in limbs(number)])


def add(a: Column, b: Column) -> Column:
    return _number([x + y for x, y in zip(limbs(a), limbs(b))])


def total(number: Column) -> Column:
    """Aggregate: the sum; NULL if any number of the group is missing, as a wrong sum would not show."""
    whole = F.count(number[FIELDS[0]]) == F.count(F.lit(1))
    return F.when(whole, _number([F.sum(x) for x in limbs(number)]))


_NUMBER = StructType([StructField(f, LongType()) for f in FIELDS])


def _carried(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Limbs (one row each) brought into their range, and what is left beyond the last."""
    out, carry = np.empty_like(values), np.zeros(values.shape[1], np.int64)
    for i, limb in enumerate(values):
        whole = limb + carry
        if (((limb ^ whole) & (carry ^ whole)) < 0).any():
            raise OverflowError("a limb of a wide number is full")
        out[i], carry = whole & _MASK, whole >> BITS
    return out, carry


def _magnitude(numbers: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known, negative, limbs): the sign, and the limbs of the absolute value, each in its range."""
    columns = numbers.flatten()  # a NULL number has NULL limbs
    known = columns[0].is_valid().to_numpy(zero_copy_only=False)
    values, carry = _carried(np.stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in columns]).astype(np.int64))
    negative = carry < 0
    return known, negative, _carried(np.where(negative, -values, values))[0]


def _whole(magnitude: np.ndarray) -> list[int]:
    """Limbs in their range as integers."""
    parts = np.ascontiguousarray(magnitude.T).astype("<i8").view(np.uint8).reshape(-1, LIMBS, 8)[:, :, : BITS // 8]
    held = parts.tobytes()
    return [int.from_bytes(held[n : n + _SIZE], "little") for n in range(0, len(held), _SIZE)]


def _objects(values: pa.Array) -> list:
    """As ``to_pylist``, which is slow, of texts or whole numbers."""
    if pa.types.is_integer(values.type):
        return values.to_pylist() if values.null_count else values.to_numpy().tolist()
    return values.to_numpy(zero_copy_only=False).tolist()  # objects: texts and None


def _struct(known: np.ndarray, values: np.ndarray) -> pa.StructArray:
    columns = [pa.array(limb, pa.int64(), mask=~known) for limb in values]
    return pa.StructArray.from_arrays(columns, names=FIELDS, mask=pa.array(~known))


@F.arrow_udf(returnType=_NUMBER)
def _normalised(numbers: pa.Array) -> pa.Array:
    known, negative, limbs_ = _magnitude(numbers)
    return _struct(known, np.where(negative, -limbs_, limbs_))


@F.arrow_udf(returnType=StringType())
def _text(numbers: pa.Array, places: pa.Array) -> pa.Array:
    known, negative, limbs_ = _magnitude(numbers)

    def shown(n: int, minus: bool, p: int) -> str:
        digits, sign = str(n), "-" if minus else ""
        if p <= 0:
            return sign + digits
        digits = digits.zfill(p + 1)
        return f"{sign}{digits[:-p]}.{digits[-p:]}"

    rows = zip(known.tolist(), _whole(limbs_), negative.tolist(), _objects(places))
    return pa.array([shown(n, minus, p) if k and p is not None else None for k, n, minus, p in rows], pa.string())


@F.arrow_udf(returnType=StringType())
def _word(numbers: pa.Array) -> pa.Array:
    known, negative, limbs_ = _magnitude(numbers)
    rows = zip((known & ~negative).tolist(), _whole(limbs_))
    return pa.array([f"0x{n:064x}" if k and not n >> 256 else None for k, n in rows], pa.string())


@F.arrow_udf(returnType=DoubleType())
def _double(numbers: pa.Array) -> pa.Array:
    known, negative, limbs_ = _magnitude(numbers)
    size = np.zeros(len(known))
    for i in reversed(range(LIMBS)):
        size = size + limbs_[i] * float(1 << BITS * i)
    return pa.array(np.where(negative, -size, size), pa.float64(), mask=~known)


# a line break at the end of a text is passed over
_PLAIN = re.compile(r"(-?)0*([0-9]*)(?:\.([0-9]*?)0*)?(?:\r\n|[\n\r\x85\u2028\u2029])?")
_ANY_DIGIT = re.compile(r"-?[0-9]")


@F.arrow_udf(returnType=_NUMBER)
def _read(texts: pa.Array, places: pa.Array) -> pa.Array:
    def number(text: str | None, p: int | None) -> int | None:
        if text is None or p is None:
            return None
        minus, whole, after = "", text, ""
        if not (text.isascii() and text.isdigit()):
            found = _PLAIN.fullmatch(text) if _ANY_DIGIT.match(text) else None
            if found is None:
                return None
            minus, whole, after = found[1], found[2], found[3] or ""
        if len(after) > p or len(whole) + p > WIDTH and len(whole.lstrip("0")) + p > WIDTH:
            return None
        n = int(whole + after.ljust(p, "0") or "0")
        return None if n >= _TOP else -n if minus else n

    rows = list(map(number, _objects(texts), _objects(places)))
    held = b"".join([abs(n or 0).to_bytes(_SIZE, "little") for n in rows])
    parts = np.zeros((len(rows), LIMBS, 8), np.uint8)
    parts[:, :, : BITS // 8] = np.frombuffer(held, np.uint8).reshape(len(rows), LIMBS, BITS // 8)
    values = parts.view("<i8").reshape(-1, LIMBS).T
    known = np.array([n is not None for n in rows], bool)
    negative = np.array([n is not None and n < 0 for n in rows], bool)
    return _struct(known, np.where(negative, -values, values))


def _places(decimals: Column | int) -> Column:
    return F.lit(decimals) if isinstance(decimals, int) else decimals


def normalised(number: Column) -> Column:
    """The same number with every limb in its range and of its sign, so that equal numbers have equal limbs."""
    return _normalised(number)


def is_zero(number: Column) -> Column:
    """Of a number whose limbs are in range (read, negated or normalised)."""
    out = F.lit(True)
    for limb in limbs(number):
        out = out & (limb == 0)
    return out


def text(number: Column, decimals: Column | int = 0) -> Column:
    """All digits of ``number / 10^decimals``, with that many after the point."""
    return _text(number, _places(decimals).cast("int"))


def from_text(value: Column, decimals: Column | int = 0) -> Column:
    """``value * 10^decimals``; NULL if that is no whole number, or the text none at all."""
    return _read(value, _places(decimals).cast("int"))


def to_word(number: Column) -> Column:
    """A 32-byte hex word; NULL for what is negative or does not fit."""
    return _word(number)


def to_double(number: Column, decimals: Column | int = 0) -> Column:
    """``number / 10^decimals`` as the DOUBLE near it, for ratios and ranks."""
    return _double(number) / F.pow(F.lit(10.0), _places(decimals))
