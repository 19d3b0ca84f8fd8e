"""Best-fit packing of token sequences, large pieces first.

Every document becomes pieces of at most ``capacity`` tokens. Only the lengths matter for packing, and there are at most
``capacity`` of them, so the plan is made on how many pieces each length has: pieces above a third of the capacity are
paired, at most two to a bin, the longest with the longest that still fits; smaller pieces then go, longest first, into
the smallest gap that holds them. Bins of equal content are one entry with a count, and a step ends either a length or
an entry, so the plan has a few thousand entries whatever the number of documents. Each piece then finds its own place
from its rank among the pieces of its length. All bins are planned over the whole table, not per partition.

Defined cases: a null text is an empty one, and an empty document is the end token alone; repeated rows are packed
each; a null id is carried; an empty table has no sequences. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, written

CAPACITY = 2048
END = 0


@lru_cache(maxsize=2)
def _encoder(ranks_path: str):
    """The byte-level vocabulary by its ranks; its one special token keeps the id it has in the full file."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {"<|endoftext|>": len(ranks)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str | None, ranks_path: str) -> np.ndarray:
    """The ids of a text and the end token. The ranks file gives the ids of the json file of the same vocabulary, several
    times faster; a test holds both against each other."""
    ids = _encoder(ranks_path).encode(text or "", allowed_special="all")
    return np.append(np.asarray(ids, dtype="<u4"), np.uint32(END)).astype("<u4")


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of each piece; only the first may be shorter than the capacity."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(
    docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece; ``src`` and ``nth`` number the pieces of a length within a partition of the written table."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {PIECE}, src int, nth bigint" + (", ids array<bigint>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                at, rows = [], []
                for i, value in enumerate(part.column(1).to_pylist()):
                    ids = token_ids(value, ranks_path)
                    for n, (start, size) in enumerate(cuts(len(ids), capacity)):
                        own = ids[start : start + size]
                        at.append(i)
                        row = (n, start, size, zlib.crc32(own.tobytes()), src, int(seen[size]))
                        rows.append((*row, own.tolist()) if with_ids else row)
                        seen[size] += 1
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
                names = ["piece", "start", "length", "ids_crc32", "src", "nth", "ids"][: len(rows[0])]
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), *arrays], ["doc_id", *names])

    return chosen.mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins for so many pieces of each length: (lengths in the bin, number of such bins)."""
    left = {s: n for s, n in counts.items() if n > 0}
    large = sorted(s for s in left if 3 * s > capacity)
    open_bins: dict[int, list[list]] = {}  # gap -> entries [lengths, count]
    gaps: list[int] = []  # the gaps there are, in order
    closed: list[tuple[list[int], int]] = []

    def put(content: list[int], n: int, gap: int) -> None:
        if gap == 0:
            closed.append((content, n))
            return
        if gap not in open_bins:
            open_bins[gap] = []
            insort(gaps, gap)
        open_bins[gap].append([content, n])

    # the longest with the longest that fits beside it
    while large:
        s = large[-1]
        i = bisect_left(large, capacity - s + 1) - 1
        if i < 0:
            put([s], left[s], capacity - s)
            large.pop()
            continue
        mate = large[i]
        n = left[s] // 2 if mate == s else min(left[s], left[mate])
        if n == 0:  # one piece that could only pair with its own length
            if i == 0:
                put([s], 1, capacity - s)
                large.pop()
                continue
            mate = large[i - 1]
            n = 1
        put([s, mate], n, capacity - s - mate)
        left[s] -= n
        left[mate] -= n
        large = [x for x in large if left[x] > 0]

    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        n = left[s]
        while n:
            i = bisect_left(gaps, s)
            if i == len(gaps):  # no gap holds it: new bins, as full as this length makes them
                per = capacity // s
                whole, rest = divmod(n, per)
                if whole:
                    put([s] * per, whole, capacity - s * per)
                if rest:
                    put([s] * rest, 1, capacity - s * rest)
                break
            gap = gaps[i]
            content, have = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap]
                gaps.pop(i)
            fit = gap // s
            full = min(have, n // fit)
            if full:
                put([*content, *[s] * fit], full, gap - s * fit)
                n -= full * fit
                have -= full
            if have and n and n < fit:
                put([*content, *[s] * n], 1, gap - s * n)
                n, have = 0, have - 1
            if have:
                put(content, have, gap)
    return closed + [(c, n) for entries in open_bins.values() for c, n in entries]


def places(bins: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: the first ranks of its slots, and each slot's first sequence and offset. A slot takes as many
    pieces as its entry has bins."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for content, n in bins:
        offset = 0
        for s in content:
            slots.setdefault(s, []).append((taken.get(s, 0), first, offset))
            taken[s] = taken.get(s, 0) + n
            offset += s
        first += n
    return {s: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for s, rows in slots.items()}


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece (a frame that ``pieces`` made and that has been written) its sequence and its offset there."""
    counts = parts.groupBy("length", "src").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "src", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity
    where = places(plan(totals, capacity))
    kept = [c for c in parts.columns if c not in ("src", "nth")]
    ranked = parts.join(base, ["length", "src"]).select(*kept, (F.col("base") + F.col("nth")).alias("rank"))
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column(kept.index("length")).to_numpy()
            rank = batch.column(len(kept)).to_numpy()
            sequence, offset = np.empty(len(size), dtype=np.int64), np.empty(len(size), dtype=np.int64)
            for s in np.unique(size):
                own = size == s
                ranks, firsts, offsets = where[int(s)]
                i = np.searchsorted(ranks, rank[own], side="right") - 1
                sequence[own] = firsts[i] + rank[own] - ranks[i]
                offset[own] = offsets[i]
            arrays = [*batch.columns[:-1], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(run, f"{out}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, **columns) -> DataFrame:
    """Pieces of all documents with their places. The pieces are written once to the shared folder, so that ranks stay
    as they are when executors are lost."""
    return pack(written(pieces(docs, ranks_path, capacity, **columns), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, from pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``capacity`` ids in all
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
