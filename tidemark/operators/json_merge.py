"""Deep merge of JSON texts of any depth, by path.

Two objects are merged field by field. Where a field is an object on both sides and they differ, the walk goes on inside;
every other field is a leaf of the result: what one side alone has, what both share, an array with the other side
appended, or the new value. A worker reads each text once and walks it down to the end, so the work grows with the length
of the texts, however deep they are. The leaves of a row, in the order of their paths, then give its text, each by the path
before it.

Texts are normalised (fields in order, no blanks). An absent side leaves the other as it is. What is no JSON fails the job.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache, reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidemark.functions.json_fields import append_json
from tidemark.session import dealt, scratch_path

#: Levels that one round goes down: the most that Spark's JSON parser takes (its recursion may need a larger thread stack for them).
LEVELS = 1000

_LEAVES = ArrayType(StructType([StructField("_path", ArrayType(StringType())), StructField("_value", StringType())]))

Leaf = tuple[tuple[str, ...], str]

# numbers stay the digits of their text, as bytes: 1 is neither "1" nor true
_DECODER = json.JSONDecoder(parse_int=str.encode, parse_float=str.encode, strict=False)
_ESCAPED = re.compile(r'[\x00-\x1f"\\]')
_ESCAPES = {c: f"\\u{ord(c):04X}" for c in map(chr, range(32))} | dict(zip('"\\\b\f\n\r\t', [f"\\{c}" for c in '"\\bfnrt'], strict=True))
_WORDS = {None: "null", True: "true", False: "false"}


def _leaf(a: Column, b: Column) -> Column:
    """What a place of the result holds; NULL where two different objects meet, so that the walk goes on."""
    return (
        F.when(b.isNull(), a)
        .when(a.isNull(), b)
        .when(a == b, a)
        .when(a.startswith("{") & b.startswith("{"), F.lit(None))
        .when(a.startswith("["), append_json(a, b))
        .otherwise(b)
    )


def _quoted(text: str) -> str:
    if _ESCAPED.search(text) is None:
        return f'"{text}"'
    return f'"{_ESCAPED.sub(lambda m: _ESCAPES[m[0]], text)}"'


@lru_cache(1024)
def _short_name(key: str) -> str:
    return f"{_quoted(key)}:"


def _name(key: str) -> str:
    return _short_name(key) if len(key) <= 64 else f"{_quoted(key)}:"


def _scalar(value: Any) -> str:
    return _quoted(value) if isinstance(value, str) else value.decode() if isinstance(value, bytes) else _WORDS[value]


def _as_text(value: Any) -> str:
    """JSON text of a decoded value, as it was read; without recursion, as values may be nested deeply."""
    if not isinstance(value, dict | list):
        return _scalar(value)
    out: list[str] = []
    todo = [(value, "")]  # a value and what stands behind it
    while todo:
        value, behind = todo.pop()
        if isinstance(value, dict):
            out.append("{")
            todo.append((b"}", behind))
            for n, (key, inner) in enumerate(reversed(value.items())):
                todo += [(inner, "," if n else ""), (_name(key).encode(), "")]
        elif isinstance(value, list):
            out.append("[")
            todo.append((b"]", behind))
            todo += [(inner, "," if n else "") for n, inner in enumerate(reversed(value))]
        else:
            out += [_scalar(value), behind]
    return "".join(out)


def _walk(current: str, new: str) -> list[Leaf]:
    """The leaves of the merge of two different objects, in the order of their paths."""
    a, b = _DECODER.raw_decode(current)[0], _DECODER.raw_decode(new)[0]
    found: list[tuple[tuple[str, ...], Any]] = []
    path: list[str] = []
    above: list[tuple] = []
    top, start, same, fields = a, 0, True, None
    while True:
        while fields is None:  # as long as both have one field alone, and it is an object, there is nothing to come back to
            if len(a) == 1 == len(b):
                [(key, value)] = a.items()
                other = b.get(key)
                if type(value) is dict and type(other) is dict:
                    path.append(key)
                    a, b = value, other
                    continue
            fields = iter(sorted(a.keys() | b.keys()))
        for key in fields:
            if key not in b:
                value, same = a[key], False
            elif key not in a:
                value, same = b[key], False
            else:
                value, other = a[key], b[key]
                if type(value) is dict and type(other) is dict:
                    above.append((a, b, top, start, same, fields, len(path)))
                    path.append(key)
                    a, b, top, start, same, fields = value, other, value, len(found), True, None
                    break
                if value != other:
                    same = False
                    value = other if type(value) is not list else value + (other if type(other) is list else [other])
            found.append(((*path, key), value))
        else:
            if not above:
                return [(p, _as_text(v)) for p, v in found]
            alike, whole, first = same, top, start
            a, b, top, start, same, fields, depth = above.pop()
            if alike:  # nothing differs inside: the object is the leaf
                found[first:] = [(tuple(path[: depth + 1]), whole)]
            del path[depth:]
            same = same and alike


def _joined(found: Sequence[Leaf]) -> str:
    """The JSON text of leaves in the order of their paths: before each, the objects that end and those that begin."""
    before, value = found[0]
    if not before:
        return value
    out = ["{", "{".join(map(_name, before)), value]
    for path, value in found[1:]:
        shared = min(len(before), len(path)) - 1  # most often all but the last name of one of them
        if before[:shared] != path[:shared] or before[shared] == path[shared]:
            shared = next((n for n, (x, y) in enumerate(zip(before, path)) if x != y), shared + 1)
        out += ["}" * (len(before) - shared - 1), ",", "{".join(map(_name, path[shared:])), value]
        before = path
    out.append("}" * len(before))
    return "".join(out)


@F.arrow_udf(returnType=_LEAVES)
def _leaves_of(whole: pa.Array, current: pa.Array, new: pa.Array) -> pa.Array:
    rows = zip(whole.to_pylist(), current.to_pylist(), new.to_pylist(), strict=True)
    found = [_walk(a, b) if w is None else [((), w)] for w, a, b in rows]
    ends, flat = [0], [leaf for leaves in found for leaf in leaves]
    for leaves in found:
        ends.append(ends[-1] + len(leaves))
    paths = pa.array([path for path, _ in flat], pa.list_(pa.string()))
    both = pa.StructArray.from_arrays([paths, pa.array([value for _, value in flat], pa.string())], ["_path", "_value"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), both)


@F.arrow_udf(returnType=StringType())
def _text_of(pairs: pa.Array) -> pa.Array:
    """The text of each key, from the leaves of all its rows."""
    columns = [c.to_pylist() for c in pairs.flatten().flatten()]
    out, at = [], 0
    for n in pairs.value_lengths().to_pylist():
        found: list[Leaf] = []
        for w, a, b in zip(*(c[at : at + n] for c in columns), strict=True):
            found += _walk(a, b) if w is None else [((), w)]
        out.append(_joined(found if n == 1 else sorted(found)))
        at += n
    return pa.array(out, pa.string())


def _pairs(rows: DataFrame, keys: Sequence[str], current: str, new: str) -> DataFrame:
    """``keys``, and ``_whole``, the merge of two texts that are not both objects, or else the two objects ``_a`` and ``_b``."""
    plain = lambda c: F.to_json(F.parse_json(F.col(c)))
    texts = dealt(rows.select(*keys, current, new).filter(F.col(current).isNotNull() | F.col(new).isNotNull()), *keys)
    texts = texts.select(*keys, plain(current).alias("_a"), plain(new).alias("_b"))
    texts = texts.withColumn("_whole", _leaf(F.col("_a"), F.col("_b")))
    # a field is read again by itself, which gives 100.0 and -0.0 as 100 and 0; nothing else changes
    inside = lambda c: F.when(F.col("_whole").isNull(), F.when(F.col(c).contains("."), plain(c)).otherwise(F.col(c)))
    return texts.select(*keys, "_whole", inside("_a").alias("_a"), inside("_b").alias("_b"))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def leaves(rows: DataFrame, keys: Sequence[str], current: str, new: str) -> DataFrame:
    """The leaves of each row's merge: ``keys``, ``_path`` (from the top, empty for the text itself) and ``_value``."""
    found = _pairs(rows, keys, current, new).select(*keys, F.explode(_leaves_of("_whole", "_a", "_b")).alias("_leaf"))
    return _written(found.select(*keys, "_leaf._path", "_leaf._value"), "json-leaves")


def merged_texts(rows: DataFrame, keys: Sequence[str], current: str, new: str, out: str) -> DataFrame:
    """``keys`` and the merged text of every row that has one; ``keys`` must tell rows apart."""
    pairs = _pairs(rows, keys, current, new).groupBy(*keys).agg(F.collect_list(F.struct("_whole", "_a", "_b")).alias("_pairs"))
    return _written(pairs.select(*keys, _text_of("_pairs").alias(out)), "json-texts")


def merge_column(rows: DataFrame, keys: Sequence[str], current: str, new: str, out: str) -> DataFrame:
    """All rows, ``current`` and ``new`` replaced by their merge ``out``."""
    texts = merged_texts(rows, keys, current, new, "_merged").withColumnsRenamed({k: f"_m_{k}" for k in keys})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys])
    joined = rows.join(texts, same, "left").withColumn(out, F.col("_merged"))
    return joined.drop("_merged", *(f"_m_{k}" for k in keys), *({current, new} - {out}))
