"""N-gram Jaccard join with Bayesian pruning.

Two documents are linked when the sets of their five-word shingles have a Jaccard similarity of 0.8 or more.

1. Documents with equal shingle sets form one class; only classes are compared.
2. Every class has MinHash values; a band is three of them in a row. Classes that agree in a band meet in its bucket. With 21
   bands a pair of similarity 0.8 is missed with a probability of 3e-7.
3. In a bucket the MinHash values of a pair are compared nine at a time. A pair is dropped once the probability that it reaches the
   threshold, given the agreements so far (uniform prior), falls below ``tolerance``. A pair that meets in several
   buckets is handled in the first of its common bands only.
4. What is left is verified on the shingle sets themselves.

A bucket of many members is cut into blocks, and each pair of blocks is one unit of work, so no task holds more than two
blocks. Units give a count of links for each class and its smallest linked neighbour instead of pairs, so nothing
that is emitted grows with the square of a group; links still count every document, copies included.

Words are what stands between ASCII white space, ASCII letters in lower case. Defined cases: a text of one to four words
is one shingle; null, empty and blank texts have none, are linked with nothing and are classes of their own; null ids
take part and are named last; repeated rows are links of each other; other columns pass through ``keep``, whatever their
names, and are not read elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import all_pairs, map_slices, texts, whole_units, written
from tidemark.llm.components import connected, roots


@dataclass(frozen=True)
class Join:
    words: int = 5
    threshold: float = 0.8
    bands: int = 21
    band_rows: int = 3
    step: int = 9
    tolerance: float = 1e-6
    block_members: int = 1024
    block_shingles: int = 1_500_000

    @property
    def hashes(self) -> int:
        return self.bands * self.band_rows


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@lru_cache(maxsize=64)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes | None, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, in order. Hashes of spans come from running sums over the text."""
    parts = (raw or b"").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    text = np.frombuffer(b" ".join(parts), dtype=np.uint8)
    bits = max(12, int(len(text)).bit_length())
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _powers(int(_BASE), bits)[: len(text)], out=sums[1:])
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(parts) - words + 1, 1)
    starts, ends = starts[:n], ends[min(words, len(parts)) - 1 :][:n]
    return np.unique(mixed((sums[ends] - sums[starts]) * _powers(int(_BASE_INVERSE), bits)[starts]))


@lru_cache(maxsize=4)
def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    draw = lambda: rng.integers(1, 1 << 63, n, dtype=np.uint64)[:, None]
    return draw() * np.uint64(2) + np.uint64(1), draw()


def signature(found: np.ndarray, n: int, chunk: int = 2048) -> np.ndarray:
    """The ``n`` MinHash values of a set, 16 bits of each."""
    factor, offset = _factors(n)
    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(found), chunk):
        part = found[None, lo : lo + chunk] * factor + offset
        part ^= part >> np.uint64(32)
        np.minimum(least, part.min(axis=1), out=least)
    return (mixed(least) & np.uint64(0xFFFF)).astype("<u2")


def needed_matches(join: Join) -> list[tuple[int, int]]:
    """After so many comparisons, the fewest agreements that keep a pair: the posterior of a similarity in [threshold, 1]
    after m of k agreements under a uniform prior is the chance of at most m successes in k + 1 trials at the threshold."""
    out, t = [], join.threshold
    for k in range(join.step, join.hashes + 1, join.step):
        total, m = 0.0, 0
        while True:
            total += comb(k + 1, m) * t**m * (1 - t) ** (k + 1 - m)
            if total >= join.tolerance:
                break
            m += 1
        out.append((k, m))
    return out


def surviving(sigs: np.ndarray, i: np.ndarray, j: np.ndarray, band: np.ndarray, join: Join) -> np.ndarray:
    """Which pairs of rows are left after the comparisons, among those whose first common band is ``band``."""
    alive = np.arange(len(i))
    agreed = np.zeros(len(i), dtype=np.int16)
    for k, least in needed_matches(join):
        lo = k - join.step
        same = sigs[i[alive], lo:k] == sigs[j[alive], lo:k]
        agreed[alive] += same.sum(axis=1, dtype=np.int16)
        whole = same.reshape(len(alive), -1, join.band_rows).all(axis=2)
        bands = np.arange(lo // join.band_rows, k // join.band_rows)
        earlier = (whole & (bands[None, :] < band[alive][:, None])).any(axis=1)
        alive = alive[(agreed[alive] >= least) & ~earlier]
        if not len(alive):
            break
    return alive


_UNIT = ["key", "low", "high"]


def _signatures(table: pa.Table, join: Join) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype="<u2").reshape(-1, join.hashes)


def _candidates(table: pa.Table, starts: np.ndarray, sizes: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """The surviving pairs of rows of some units."""
    sigs, band = _signatures(table, join), table.column("key").to_numpy() % join.bands
    block, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    pending = sizes * (sizes - 1) // 2
    at = 0
    while at < len(sizes):
        to = at + max(1, int(np.searchsorted(np.cumsum(pending[at:]), 400_000)))
        i, j = all_pairs(starts[at:to], sizes[at:to])
        across = (low[i] == high[i]) | (block[i] != block[j])
        i, j = i[across], j[across]
        left = surviving(sigs, i, j, band[i], join)
        found.append((i[left], j[left]))
        at = to
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs (sorted by ``i``) reach the threshold exactly."""
    sizes = np.array([len(s) for s in sets])
    vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(sizes)])
    ok = np.zeros(len(i), dtype=bool)
    mark = np.zeros(len(vocabulary), dtype=bool)
    bounds = np.flatnonzero(np.diff(i, prepend=-1, append=-1))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        a, partners = i[lo], j[lo:hi]
        own = flat[first[a] : first[a + 1]]
        mark[own] = True
        from_, to = partners.min(), partners.max() + 1
        both = np.add.reduceat(mark[flat[first[from_] : first[to]]], first[from_:to] - first[from_], dtype=np.int64)
        both = both[partners - from_]
        mark[own] = False
        ok[lo:hi] = both >= threshold * (sizes[a] + sizes[partners] - both) - 1e-9
    return ok


# --- on tables ---------------------------------------------------------------------------------------------------


def signatures(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``version`` (hash of the text), ``cls`` (hash of the shingle set, null without any), ``check``, ``n`` and
    ``sig`` of every document."""
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    kind = keyed.schema["id"].dataType.simpleString()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for raw in texts(batch, "text"):
            found = shingles(raw, join.words)
            if not len(found):
                rows.append((None, None, 0, None))
                continue
            sums = np.array([found.sum(dtype=np.uint64), mixed(found + np.uint64(1)).sum(dtype=np.uint64)])
            rows.append((*mixed(sums).view(np.int64).tolist(), len(found), signature(found, join.hashes).tobytes()))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*rows), types))]
        return pa.RecordBatch.from_arrays(arrays, ["id", "version", "cls", "check", "n", "sig"])

    return map_slices(keyed, step, f"id {kind}, version bigint, cls bigint, check bigint, n bigint, sig binary")


def _order() -> Column:
    """The document that names a group comes first: the smallest id, nulls last."""
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "version")


def classes(sigs: DataFrame) -> DataFrame:
    """One row per shingle set: its first document, its number of documents, its size and MinHash values."""
    rows = sigs.where("cls IS NOT NULL")
    return rows.groupBy("cls", "check").agg(
        F.min(_order()).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig")
    )


def _bands(groups: DataFrame, join: Join) -> DataFrame:
    """``key`` and ``cls`` for every band; the key ends in the band's number."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u2").reshape(-1, join.bands, join.band_rows)
        code = np.zeros(sigs.shape[:2], dtype=np.int64)
        for k in range(join.band_rows):
            code = (code << 16) | sigs[:, :, k]
        keys = (code * join.bands + np.arange(join.bands)).ravel()
        rows = np.repeat(np.arange(batch.num_rows), join.bands)
        return pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0).take(pa.array(rows)), batch.column(2).take(pa.array(rows))], ["key", "cls", "n"])

    return map_slices(groups.select("cls", "sig", "n"), step, "key bigint, cls bigint, n bigint", rows=4096)


def _units(groups: DataFrame, join: Join) -> DataFrame:
    """Members of every bucket of two or more, once for each pair of blocks they are in."""
    bands = _bands(groups, join)
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles")).where("members > 1")
    blocks = F.greatest(
        F.ceil(F.col("members") / join.block_members), F.ceil(F.col("shingles") / join.block_shingles)
    ).cast("int")
    # written, so that the join stands between two plain shuffles and a hot bucket can be split
    buckets = written(buckets.select("key", blocks.alias("blocks")), "buckets")
    found = bands.select("key", "cls").join(buckets, "key")
    found = found.join(groups.select("cls", "sig", "copies", "rep"), "cls")
    block = F.pmod(F.xxhash64(F.lit(3), "cls"), F.col("blocks")).cast("int")
    found = found.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return found.select(
        "key",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "cls",
        "sig",
        "copies",
        F.col("rep.id").alias("id"),
        F.col("rep.version").alias("version"),
    )


def _in_units(df: DataFrame) -> DataFrame:
    return df.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "cls")


def links(docs: DataFrame, groups: DataFrame, join: Join = Join(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``cls``, ``linked`` (documents in other classes that it is linked with, in this unit of work) and ``neighbour`` (the
    smallest class of its part of the unit)."""
    members = _in_units(_units(groups, join))
    schema = members.schema

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, sizes in whole_units(batches, _UNIT):
            i, j = _candidates(table, starts, sizes, join)
            rows = np.unique(np.concatenate([i, j]))
            if len(rows):
                yield from table.take(pa.array(rows)).combine_chunks().to_batches()

    left = written(members.mapInArrow(prune, schema), "candidates")
    body = docs.select(F.col(id_col).alias("body_id"), F.xxhash64(text).alias("body_version"), F.col(text).alias("text"))
    needed = left.select("id", "version", "cls").distinct()
    body = (
        body.join(
            needed.hint("shuffle_hash"),
            F.col("body_id").eqNullSafe(F.col("id")) & (F.col("body_version") == F.col("version")),
        )
        .select("cls", "text")
    )
    units = _in_units(left.select(*_UNIT, "block", "cls", "sig", "copies").join(body, "cls"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, sizes in whole_units(batches, _UNIT):
            rows = []
            for start, size in zip(starts, sizes):
                unit = table.slice(start, size)
                cls = unit.column("cls").to_numpy()
                once = np.flatnonzero(np.diff(cls, prepend=cls[0] - 1) != 0)  # repeated rows bring a text twice
                unit, cls = unit.take(pa.array(once)), cls[once]
                i, j = _candidates(unit, np.zeros(1, dtype=np.int64), np.array([len(once)]), join)
                if not len(i):
                    continue
                raws = unit.column("text").cast(pa.binary()).to_pylist()
                sets = [shingles(raw, join.words) for raw in raws]
                order = np.lexsort((j, i))
                i, j = i[order], j[order]
                ok = verified(sets, i, j, join.threshold)
                i, j = i[ok], j[ok]
                copies = unit.column("copies").to_numpy()
                linked = np.zeros(len(once), dtype=np.int64)
                np.add.at(linked, i, copies[j])
                np.add.at(linked, j, copies[i])
                top = roots(len(once), i, j)  # rows are in the order of their classes
                rows += [(int(cls[k]), int(linked[k]), int(cls[top[k]])) for k in np.flatnonzero(linked)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)], ["cls", "linked", "neighbour"]
                )

    return units.mapInArrow(verify, "cls bigint, linked bigint, neighbour bigint")


def group(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id``, ``version``, ``class_id`` (the smallest id among the documents it is linked with,
    directly or through others), ``n_links`` (other documents linked directly) and ``first`` (whether it names its group)."""
    sigs = written(signatures(docs, join, id_col, text), "signatures")
    groups = written(classes(sigs), "classes")
    found = written(links(docs, groups, join, id_col, text), "links")
    placed = grouped(groups, found)
    both = sigs.select("id", "version", "cls", "check").join(placed, ["cls", "check"], "left")
    return both.select(
        "id",
        "version",
        F.when(F.col("head").isNull(), F.col("id")).otherwise(F.col("head.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("head").isNull() | (F.col("head") == _order())).alias("first"),
    )


def grouped(groups: DataFrame, found: DataFrame) -> DataFrame:
    """``cls``, ``check``, the ``head`` of its component and ``n_links`` of each class, from the links of all units."""
    counts = found.groupBy("cls").agg(F.sum("linked").alias("linked"))
    parts = connected(found.select(F.col("cls").alias("a"), F.col("neighbour").alias("b")))
    placed = (
        groups.select("cls", "check", "rep", "copies")
        .join(counts, "cls", "left")
        .join(parts.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("component", F.coalesce("component", "cls"))
    )
    heads = written(placed.groupBy("component").agg(F.min("rep").alias("head")), "heads")  # as above, for hot components
    return placed.join(heads, "component").select(
        "cls", "check", "head", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )


def keep(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with all columns; rows that agree in id and text count as one."""
    stay = group(docs, join, id_col, text).where("first").groupBy("id", "version").agg(F.count(F.lit(1)).alias("times"))
    body = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).alias("body_id"),
        F.xxhash64(text).alias("body_version"),
    )
    both = body.join(
        stay.hint("shuffle_hash"), F.col("body_id").eqNullSafe(F.col("id")) & (F.col("body_version") == F.col("version"))
    )
    single = both.where("times = 1").select("row.*")
    again = both.where("times > 1").dropDuplicates(["id", "version"]).select("row.*")
    return single.unionByName(again)
