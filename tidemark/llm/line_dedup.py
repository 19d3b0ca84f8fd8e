"""Line dedup by winnowing over line hashes.

A document is a sequence of lines that hold a word (white space made single blanks). A run of lines is *repeated* when
the same lines, at least ``run_words`` words in all, stand somewhere earlier: in a document before it or further up in
the same one. Every line of every repeated run is deleted; the first occurrence stays.

* Grams: from each line, the fewest lines that hold ``gram_words`` words. Windows: from each line, the fewest lines that
  hold ``run_words`` words. Each window selects its smallest gram hash: equal windows select the same gram, so any repeated
  run has a fingerprint in common with its first occurrence, and a fingerprint found once rules its windows out.
* Positions that share a fingerprint are joined on the content of their windows, and a window that stands earlier
  somewhere is deleted. Windows grow both ways: those counted forward from a line carry a match to where it begins,
  those counted back from a line to where it ends. Together they are the whole run, neither more nor less, without
  pairing any two positions: a window needs only its first occurrence.

Documents are ordered by id (nulls last), then by the hash of their text. Defined cases: rows that agree in id and text
are one document, and all stay alike; null and empty texts have no lines and stay as they are; lines without a word
stay, unless they stand between two deleted lines of one run. All other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import SLICE, map_slices, texts, written


@dataclass(frozen=True)
class Runs:
    run_words: int = 50
    gram_words: int = 25


def lines_of(raw: bytes) -> tuple[list[int], list[bytes], np.ndarray]:
    """Of the lines that hold a word: their places among all lines, their content, their words before (one more entry)."""
    places, content, words = [], [], [0]
    for at, line in enumerate(raw.split(b"\n")):
        parts = line.split()
        if parts:
            places.append(at)
            content.append(b" ".join(parts))
            words.append(words[-1] + len(parts))
    return places, content, np.array(words)


def windows(content: list[bytes], words: np.ndarray, runs: Runs) -> list[tuple[int, int, int, int, int]]:
    """(fingerprint, its line, content hash, first line, lines) of each window, forward ones and those counted back."""
    n = len(content)
    if not n or words[-1] < runs.run_words:
        return []
    keys = [xxhash.xxh3_128_digest(line) for line in content]

    def spans(need: int) -> np.ndarray:
        """For each line, the end of the fewest lines from it that hold so many words; n + 1 if there are none."""
        ends = np.searchsorted(words, words[:-1] + need)
        return np.where(ends <= n, ends, n + 1)

    gram_ends, ends = spans(runs.gram_words), spans(runs.run_words)
    found = {(i, int(e)) for i, e in enumerate(ends) if e <= n}
    begins = np.searchsorted(words, words[1:] - runs.run_words, side="right") - 1
    found.update((int(b), e + 1) for e, b in enumerate(begins) if b >= 0)
    grams = [xxhash.xxh3_64_intdigest(b"".join(keys[i : gram_ends[i]]), 1) if gram_ends[i] <= n else None for i in range(n)]
    out = []
    for i, e in sorted(found):
        inside = [(grams[s], -s) for s in range(i, e) if gram_ends[s] <= e]
        fp, at = min(inside)
        whole = xxhash.xxh3_64_intdigest(b"".join(keys[i:e]), 2)
        out.append((_signed(fp), -at, _signed(whole), i, e - i))
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


_WINDOW = "fp bigint, anchor bigint, window bigint, id {kind}, version bigint, first int, size int"


def window_rows(docs: DataFrame, runs: Runs) -> DataFrame:
    """One row per window of each document."""
    kind = docs.schema["id"].dataType.simpleString()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        at, rows = [], []
        doc_keys = batch.column(2).to_pylist()
        for i, raw in enumerate(texts(batch, "text")):
            if not raw:
                continue
            _, content, words = lines_of(raw)
            # a posting is told from another by one number, made of its document and its line
            for fp, anchor, whole, first, size in windows(content, words, runs):
                at.append(i)
                rows.append((fp, _signed(xxhash.xxh3_64_intdigest(b"%d %d" % (doc_keys[i], anchor))), whole, first, size))
        if not rows:
            return None
        fp, anchor, whole, first, size = zip(*rows)
        take = pa.array(at)
        arrays = [pa.array(fp, pa.int64()), pa.array(anchor, pa.int64()), pa.array(whole, pa.int64())]
        arrays += [batch.column(0).take(take), batch.column(1).take(take), pa.array(first, pa.int32()), pa.array(size, pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, ["fp", "anchor", "window", "id", "version", "first", "size"])

    return map_slices(docs, step, _WINDOW.format(kind=kind))


def repeated_windows(docs: DataFrame, runs: Runs = Runs(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``version`` (hash of the text), ``first`` and ``size`` (in lines that hold a word) of each window that stands
    earlier somewhere."""
    keyed = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), F.xxhash64(id_col, text).alias("key"), F.col(text).alias("text")
    ).where(F.col("text").isNotNull())
    rows = written(window_rows(keyed, runs), "windows")
    postings = rows.groupBy("fp").agg(F.min("anchor").alias("lo"), F.max("anchor").alias("hi"))
    # both lists are written, so that each join stands between two plain shuffles and a hot key can be split
    shared = written(postings.where("lo != hi").select("fp"), "fingerprints")
    joined = rows.join(shared, "fp", "left_semi").drop("fp", "anchor")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "version", "first")
    sources = joined.groupBy("window").agg(F.min(place).alias("source"), F.max(place).alias("latest"))
    sources = written(sources.where("source != latest").select("window", "source"), "sources")
    return joined.join(sources, "window").where(place > F.col("source")).select("id", "version", "first", "size").distinct()


def dedup(docs: DataFrame, runs: Runs = Runs(), id_col: str = "doc_id", text: str = "text", report: str | None = None) -> DataFrame:
    """All rows with all their columns, later repeated runs deleted from the text. With ``report``, a column of that name
    holds how many lines went."""
    found = repeated_windows(docs, runs, id_col, text)
    spans = found.groupBy("id", "version").agg(F.collect_list(F.struct("first", "size")).alias("spans"))  # of one document
    body = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("version"),
    )
    both = body.join(
        spans.select(F.col("id").alias("span_id"), F.col("version").alias("span_version"), "spans").hint("shuffle_hash"),
        F.col("id").eqNullSafe(F.col("span_id")) & (F.col("version") == F.col("span_version")),
        "left",
    ).select("row.*", F.col("spans.first").alias("__first"), F.col("spans.size").alias("__size"))
    at, names = docs.columns.index(text), docs.columns
    schema = StructType([*docs.schema.fields, *([StructField(report, LongType())] if report else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                raws = part.column(at).cast(pa.binary()).to_pylist()
                first, size = part.column(len(names)).to_pylist(), part.column(len(names) + 1).to_pylist()
                kept, gone = [], []
                for raw, f, s in zip(raws, first, size):
                    value, n = without(raw, f, s) if f and raw else (raw, 0)
                    kept.append(value)
                    gone.append(n)
                columns = list(part.columns[: len(names)])
                columns[at] = pa.array(kept, pa.binary()).cast(columns[at].type)
                if report is not None:
                    columns.append(pa.array(gone, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, [*names, *([report] if report else [])])

    return both.mapInArrow(run, schema)


def without(raw: bytes, first: list[int], size: list[int]) -> tuple[bytes, int]:
    """The text without the given spans of lines, and the number of lines that hold a word among those deleted."""
    places, _, _ = lines_of(raw)
    drop = np.zeros(len(places), dtype=bool)
    gone: set[int] = set()
    for f, s in zip(first, size):
        drop[f : f + s] = True
        gone.update(range(places[f], places[f + s - 1] + 1))
    return b"\n".join(x for i, x in enumerate(raw.split(b"\n")) if i not in gone), int(drop.sum())
