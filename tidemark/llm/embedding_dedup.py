"""Embedding near-duplicates by product quantisation.

Vectors of one label are linked when their cosine is at least the threshold. Equal vectors form one class first. An index
is fitted on a bounded sample: centroids of coarse lists, and a codebook for each subspace of the residuals. Every class is
indexed: it goes to the list of its nearest centroid with its codes and with the exact length of what the codes lose.

As a query a class visits its own list and each list to whose plane (half-way between the two centroids) it has at most half
the length r of a difference at the threshold. Neighbours in two lists stand on either side of the plane and r apart at
most, so the one closer to it visits the other's list: no pair is lost, whatever the direction of its difference, and
that one alone counts the pair. In a list, table lookups give the distance to each code; a vector can only be a neighbour if
that distance less its own loss is within r, so the codes lose none. What is left is decided by the exact cosine in
double precision.

Lists that many vectors share are cut into blocks, each pair of a block of queries and a block of entries is a unit of work,
and units give counts and spanning edges, not pairs.

Defined cases: rows without a label, and vectors that are null, empty, zero or hold a null or non-finite component, are
linked with nothing and stand alone; vectors of another length than most are compared with their own length
only, exactly; null ids take part and are named last; repeated rows are links of each other; an empty table gives an
empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from tidemark.llm.common import map_slices, sampled, whole_units, written
from tidemark.llm.components import roots
from tidemark.llm.ngram_join import grouped


@dataclass(frozen=True)
class Search:
    threshold: float = 0.93
    sample_rows: int = 20_000
    sample_values: int = 4_000_000
    max_lists: int = 1024
    subspaces: int = 8
    codes: int = 256
    block: int = 2048
    rounds: int = 8

    @property
    def radius(self) -> float:
        """The distance of unit vectors at the threshold."""
        return float(np.sqrt(2 - 2 * self.threshold))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings them near 1: exact, and very long or short ones keep their direction."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _k_means(x: np.ndarray, k: int, rounds: int, unit: bool) -> np.ndarray:
    """Centroids of the rows, from evenly spaced rows; centroids without rows stay where they are."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        some = n > 0
        centres[some] = sums[some] / n[some, None]
        if unit:
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


class Index:
    """Coarse centroids and residual codebooks for vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int, search: Search):
        self.search, self.dims = search, sample.shape[1]
        sample = _scaled(sample)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.centres = _k_means(unit, lists, search.rounds, True)
        self.width = -(-self.dims // search.subspaces)
        rest = self._padded(unit - self.centres[_nearest(unit, self.centres)])
        self.books = [_k_means(p, search.codes, search.rounds, False) for p in np.split(rest, search.subspaces, axis=1)]
        square = (self.centres * self.centres).sum(axis=1)
        self.apart = np.sqrt(np.maximum(square[:, None] + square - 2 * self.centres @ self.centres.T, 0))

    def _padded(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.width * self.search.subspaces - self.dims)))

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and lost length of unit vectors."""
        home = (unit @ self.centres.T).argmax(axis=1)
        rest = self._padded(unit - self.centres[home])
        parts = np.split(rest, self.search.subspaces, axis=1)
        codes = np.stack([_nearest(p, b) for p, b in zip(parts, self.books)], axis=1).astype(np.uint8)
        told = np.concatenate([b[codes[:, m]] for m, b in enumerate(self.books)], axis=1)
        return home, codes, np.linalg.norm(rest - told, axis=1)

    def probes(self, unit: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Which lists (columns) each unit vector visits."""
        near = unit @ self.centres.T
        gap = near[np.arange(len(unit)), home][:, None] - near
        out = gap <= self.search.radius / 2 * self.apart[home] + 1e-9
        out[np.arange(len(unit)), home] = True
        return out

    def across(self, unit: np.ndarray, home: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How far each vector of list ``home`` is from the plane to list ``other``, times the distance of the centroids;
        summed row by row, so that it is the same number wherever it is worked out."""
        return (unit * (self.centres[home] - self.centres[other])).sum(axis=1)

    def distances(self, queries: np.ndarray, list_: int, codes: np.ndarray) -> np.ndarray:
        """Distances of unit vectors from coded ones of a list, by table lookups."""
        rest = self._padded(queries - self.centres[list_])
        total = np.zeros((len(queries), len(codes)), dtype=np.float32)
        for m, (part, book) in enumerate(zip(np.split(rest, self.search.subspaces, axis=1), self.books)):
            squares = (part * part).sum(axis=1)[:, None] + (book * book).sum(axis=1) - 2 * part @ book.T
            total += squares.astype(np.float32)[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def classes(vectors: DataFrame, id_col: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Every row with its class (null where it links with nothing), and one row per class."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    # the class is told by two hashes of label and vector
    usable = F.coalesce(F.col(label).isNotNull() & v.isNotNull() & sound, F.lit(False))
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.when(usable, F.xxhash64(label, v)).alias("cls"),
        F.when(usable, F.xxhash64(F.lit(11), v, F.col(label))).alias("check"),
        F.when(usable, F.xxhash64(F.lit(5), F.col(label))).alias("area"),
        v.alias("vector"),
    )
    order = F.struct(F.col("id").isNull().alias("no_id"), "id")
    groups = rows.where("cls IS NOT NULL").groupBy("cls", "check").agg(
        F.min(order).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("area").alias("area"), F.first("vector").alias("vector")
    )
    return rows.drop("vector", "area"), groups


def fit(groups: DataFrame, search: Search = Search()) -> Index | None:
    """An index from at most ``sample_rows`` classes of the most frequent length, chosen by hash."""
    sizes = groups.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if sizes is None:
        return None
    dims, n = sizes["dims"], sizes["count"]
    want = max(1, min(search.sample_rows, search.sample_values // dims))
    some = sampled(groups.where(F.size("vector") == dims), "cls", F.lit(min(1.0, 0.95 * want / n)))
    rows = sorted((r["cls"], r["vector"]) for r in some.select("cls", "vector").limit(want).collect())
    if not rows:
        rows = [(r["cls"], r["vector"]) for r in groups.where(F.size("vector") == dims).select("cls", "vector").limit(want).collect()]
    lists = int(min(search.max_lists, 1 << max(0, int(np.log2(max(n, 1) ** 0.5 / 2 + 1e-9) + 0.5))))
    return Index(np.array([v for _, v in rows], dtype=float), lists, search)


_UNIT = ["area", "list", "query_block", "entry_block"]


def _placed(groups: DataFrame, index: Index, search: Search) -> DataFrame:
    """One row per class as an entry of its list, and one as a query of each list that it visits."""
    kind = "<f4" if isinstance(groups.schema["vector"].dataType.elementType, FloatType) else "<f8"
    chosen = groups.select("cls", "area", "copies", "vector")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        vectors = batch.column(3).to_pylist()
        of = np.array([len(v) == index.dims for v in vectors])
        blobs = [np.asarray(v, dtype=kind).tobytes() for v in vectors]
        at, homes, lists, query, codes, loss = [], [], [], [], [], []

        def add(rows: np.ndarray, own: np.ndarray, to: np.ndarray, is_query: bool, code: list, lost: np.ndarray) -> None:
            at.append(rows)
            homes.append(own)
            lists.append(to)
            query.append(np.full(len(rows), is_query))
            codes.extend(code)
            loss.append(lost)

        usual = np.flatnonzero(of)
        if len(usual):
            x = _scaled(np.array([vectors[i] for i in usual], dtype=float))
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            home, code, lost = index.encode(unit)
            add(usual, home, home, False, [c.tobytes() for c in code], lost)
            r, c = np.nonzero(index.probes(unit, home))
            add(usual[r], home[r], c, True, [None] * len(r), np.zeros(len(r)))
        other = np.flatnonzero(~of)
        if len(other):
            own = np.array([-len(vectors[i]) for i in other])
            for is_query in (False, True):
                add(other, own, own, is_query, [None] * len(other), np.zeros(len(other)))
        take = pa.array(np.concatenate(at))
        names = ["cls", "area", "copies", "home", "list", "query", "vector", "code", "loss"]
        arrays = [batch.column(i).take(take) for i in range(3)]
        arrays += [pa.array(np.concatenate(c), pa.int32()) for c in (homes, lists)] + [pa.array(np.concatenate(query))]
        arrays += [pa.array(blobs, pa.binary()).take(take), pa.array(codes, pa.binary()), pa.array(np.concatenate(loss))]
        return pa.RecordBatch.from_arrays(arrays, names)

    schema = "cls bigint, area bigint, copies bigint, home int, list int, query boolean, vector binary, code binary, loss double"
    return map_slices(chosen, step, schema, rows=2048)


def _units(placed: DataFrame, search: Search) -> DataFrame:
    """Every query with every block of entries of a list, and the other way round."""
    counts = placed.groupBy("area", "list").agg(
        F.sum(F.col("query").cast("int")).alias("queries"), F.sum((~F.col("query")).cast("int")).alias("entries")
    )
    blocks = counts.where("queries > 0 AND entries > 0").select(
        "area",
        "list",
        F.ceil(F.col("queries") / search.block).cast("int").alias("query_blocks"),
        F.ceil(F.col("entries") / search.block).cast("int").alias("entry_blocks"),
    )
    both = placed.join(blocks, ["area", "list"])
    side = F.when(F.col("query"), F.col("query_blocks")).otherwise(F.col("entry_blocks"))
    other = F.when(F.col("query"), F.col("entry_blocks")).otherwise(F.col("query_blocks"))
    both = both.withColumn("own", F.pmod(F.xxhash64(F.lit(9), "cls"), side).cast("int"))
    both = both.withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
    both = both.select(
        "area",
        "list",
        F.when(F.col("query"), F.col("own")).otherwise(F.col("other")).alias("query_block"),
        F.when(F.col("query"), F.col("other")).otherwise(F.col("own")).alias("entry_block"),
        "cls",
        "copies",
        "home",
        "query",
        "vector",
        "code",
        "loss",
    )
    return both.repartition(*_UNIT).sortWithinPartitions(*_UNIT)


def _in_unit(unit: pa.Table, index: Index, search: Search, kind: str, chunk: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows (query, entry) of a unit: of a pair in one list the larger class looks for the other, of a pair in two lists
    the one closer to the plane between them."""
    query = unit.column("query").to_numpy()
    q, e = np.flatnonzero(query), np.flatnonzero(~query)
    if not len(q) or not len(e):
        return q[:0], e[:0]
    cls, home = unit.column("cls").to_numpy(), unit.column("home").to_numpy()
    x = _scaled(np.frombuffer(b"".join(unit.column("vector").to_pylist()), dtype=kind).reshape(unit.num_rows, -1).astype(float))
    lengths = np.linalg.norm(x, axis=1)
    list_ = int(unit.column("list")[0].as_py())
    coded = list_ >= 0
    if coded:
        codes = np.frombuffer(b"".join(unit.column("code").take(pa.array(e)).to_pylist()), dtype=np.uint8).reshape(len(e), -1)
        loss = unit.column("loss").to_numpy()[e]
        units = x / lengths[:, None]
        # from the plane, times the distance of the centroids: each entry for each home of a query, and each query
        lists, at_home = np.unique(home[q], return_inverse=True)
        entries = (units[e] @ (index.centres[list_] - index.centres[lists]).T).T
        gaps = index.across(units[q], home[q], np.full(len(q), list_))
        order = np.lexsort((gaps, at_home))
        q, at_home, gaps = q[order], at_home[order], gaps[order]
        limits = search.radius * index.apart[lists, list_] + 1e-9
    found = []
    for lo in range(0, len(q), chunk):
        part = q[lo : lo + chunk]
        if coded:
            own, gap = at_home[lo : lo + chunk], gaps[lo : lo + chunk, None]
            beyond = entries[own]
            can = (beyond >= gap - 1e-9) & (beyond <= limits[own, None] - gap)
            same = home[part] == list_
            can[same] = cls[part[same]][:, None] > cls[e][None, :]
            some = np.flatnonzero(can.any(axis=0))
            far = index.distances(units[part], list_, codes[some])
            a, b = np.nonzero(can[:, some] & (far - loss[some] <= search.radius + 1e-4))
            b = some[b]
        else:
            a, b = np.nonzero(cls[part][:, None] > cls[e][None, :])
        for at in range(0, len(a), 100_000):
            i, j = part[a[at : at + 100_000]], e[b[at : at + 100_000]]
            near = np.einsum("nd,nd->n", x[i], x[j]) / (lengths[i] * lengths[j])
            i, j = i[near >= search.threshold], j[near >= search.threshold]
            if coded:
                mine, other = index.across(units[i], home[i], home[j]), index.across(units[j], home[j], home[i])
                turn = (mine < other) | (mine == other) & (cls[i] > cls[j])
                i, j = i[turn], j[turn]
            found.append((i, j))
    if not found:
        return q[:0], e[:0]
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def links(groups: DataFrame, index: Index, search: Search = Search()) -> DataFrame:
    """``cls``, ``linked`` (vectors of other classes linked in this unit of work), ``neighbour`` (the smallest class of its
    part of the unit)."""
    kind = "<f4" if isinstance(groups.schema["vector"].dataType.elementType, FloatType) else "<f8"
    units = _units(written(_placed(groups, index, search), "placed"), search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, sizes in whole_units(batches, _UNIT):
            rows = []
            for start, size in zip(starts, sizes):
                unit = table.slice(start, size)
                i, j = _in_unit(unit, index, search, kind)
                if not len(i):
                    continue
                # a class may be both query and entry: number the classes of the links
                cls, copies = unit.column("cls").to_numpy(), unit.column("copies").to_numpy()
                known, first, number = np.unique(cls, return_index=True, return_inverse=True)
                linked = np.zeros(len(known), dtype=np.int64)
                np.add.at(linked, number[i], copies[j])
                np.add.at(linked, number[j], copies[i])
                top = roots(len(known), number[i], number[j])
                rows += [(int(known[k]), int(linked[k]), int(known[top[k]])) for k in np.flatnonzero(linked)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["cls", "linked", "neighbour"])

    return units.mapInArrow(run, "cls bigint, linked bigint, neighbour bigint")


def near_duplicates(
    vectors: DataFrame, search: Search = Search(), id_col: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per vector: ``id``, ``n_links`` (other vectors linked directly), ``component_id`` (smallest id that links
    reach) and ``kept`` (whether it is that id)."""
    kind = vectors.schema[vector].dataType
    if not isinstance(kind, ArrayType) or not isinstance(kind.elementType, FloatType | DoubleType):
        raise TypeError(f"{vector} is not an array of floating-point numbers")
    rows, groups = classes(vectors, id_col, vector, label)
    groups = written(groups, "vectors")
    index = fit(groups, search)
    if index is None:
        placed = groups.select("cls", "check", F.col("rep").alias("head"), F.lit(0).cast("long").alias("n_links"))
    else:
        placed = grouped(groups, written(links(groups, index, search), "links"))
    both = rows.join(placed, ["cls", "check"], "left")
    name = F.when(F.col("head").isNull(), F.col("id")).otherwise(F.col("head.id"))
    return both.select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), name.alias("component_id"), F.col("id").eqNullSafe(name).alias("kept")
    )
