"""Hard-negative mining over blocks in the order of a Hilbert curve, with zone maps.

Components become whole numbers, floor(``scale`` * x), and the score of two rows is their inner product, exactly. An
anchor's positives are the best other rows of its label; each positive makes a *window* of scores, from ``low`` to ``high``
per cent of its own, and the best rows of other labels inside it are its hard negatives.

* Candidates are ordered along a Hilbert curve over the principal axes of a bounded sample and written as Parquet blocks of
  ``block_rows`` rows. A block and a group of ``group_blocks`` blocks carry the smallest and largest value of each
  component and the labels inside: their zone maps.
* Interval arithmetic on a zone map bounds the scores that an anchor can meet there, from below and above. An anchor reads a
  group only if these bounds reach one of its windows (or, for its positives, the score that it must beat), and in the
  group it scores only the blocks whose own bounds do. What must be beaten comes from each anchor's most promising groups.
* The zone maps come in sheets and the anchors in chunks, each sheet meets each chunk; groups meet their readers in units
  of at most ``unit_anchors`` anchors. A unit gives the best few rows of each window. Nothing is broadcast or collected but
  the sample of the axes and counts.

The bounds are exact, so the blocks that they choose change what is read and never the result. Order: higher scores first, of
equal ones the smaller id. Defined cases: rows without an id or a label, and vectors that are null or hold a null or
non-finite component, take no part, nor do components too large for a score to be a 64-bit number (beyond 90,000 in 64
dimensions); *other* rows are those of another id; rows that agree in id, label and vector count once; vectors of
different lengths have no score; an empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_slices, sampled, whole_units, written

_LEAST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Mining:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    block_rows: int = 256
    group_blocks: int = 32
    axes: int = 8
    bits: int = 7
    sample_rows: int = 10_000
    unit_anchors: int = 2048


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place along a Hilbert curve of each row of whole numbers below 2^bits."""
    x = [c.astype(np.int64) for c in cells.T]
    top = 1 << (bits - 1)
    bit = top
    while bit > 1:  # undo the turns of the curve, from the coarsest square on
        for i in range(len(x)):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (bit - 1))
            x[0] = np.where(flip, x[0] ^ (bit - 1), x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        bit >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn, bit = np.zeros_like(x[0]), top
    while bit > 1:
        turn = np.where((x[-1] & bit) != 0, turn ^ (bit - 1), turn)
        bit >>= 1
    place = np.zeros_like(turn)
    for b in reversed(range(bits)):
        for column in x:
            place = (place << 1) | (((column ^ turn) >> b) & 1)
    return place


class Axes:
    """Principal axes of a sample of whole-number vectors of one length."""

    def __init__(self, sample: np.ndarray, settings: Mining):
        self.dims, self.bits = sample.shape[1], settings.bits
        self.mean = sample.mean(axis=0)
        _, vectors = np.linalg.eigh(np.cov(sample - self.mean, rowvar=False).reshape(self.dims, self.dims))
        self.vectors = vectors[:, ::-1][:, : settings.axes]
        at = (sample - self.mean) @ self.vectors
        self.low, self.width = at.min(axis=0), np.maximum(np.ptp(at, axis=0), 1e-9)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        at = ((vectors - self.mean) @ self.vectors - self.low) / self.width
        cells = np.clip(np.floor(at * (1 << self.bits)), 0, (1 << self.bits) - 1)
        return hilbert(cells.astype(np.int64), self.bits)


def _largest(dims: int) -> int:
    """Below it the scores of vectors of this length, times 100, are 64-bit numbers."""
    return int(min((2.0**55 / max(dims, 1)) ** 0.5, 2.0**31 - 1))


def usable(vectors: DataFrame, settings: Mining, anchors: Column, id_col: str, vector: str, label: str) -> DataFrame:
    """``id``, ``label``, ``dims``, ``anchor`` and ``q``, the components as 32-bit whole numbers, of the rows that take part."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & sound)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        values = batch.column(3)
        sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = np.floor(settings.scale * values.flatten().to_numpy(zero_copy_only=False))
        ends = np.cumsum(sizes)
        parts = [flat[e - n : e] for e, n in zip(ends, sizes)]
        fits = np.array([n == 0 or np.abs(p).max() < _largest(n) for p, n in zip(parts, sizes)], dtype=bool)
        blobs = [p.astype("<i4").tobytes() for p, ok in zip(parts, fits) if ok]
        if not blobs:
            return None
        some = pa.array(fits)
        arrays = [batch.column(i).filter(some) for i in range(3)]
        arrays += [pa.array(sizes[fits], pa.int32()), pa.array(blobs, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["id", "label", "anchor", "dims", "q"])

    return map_slices(rows, step, "id bigint, label bigint, anchor boolean, dims int, q binary", rows=4096)


def fit_axes(rows: DataFrame, settings: Mining) -> Axes | None:
    """Axes from at most ``sample_rows`` rows of the most frequent length, chosen by hash."""
    sizes = rows.where("dims > 0").groupBy("dims").count().orderBy(F.desc("count"), "dims").first()
    if sizes is None:
        return None
    own = rows.where(F.col("dims") == sizes["dims"])
    some = sampled(own, "id", F.lit(min(1.0, 0.95 * settings.sample_rows / sizes["count"])))
    picked = some.select("id", "q").limit(settings.sample_rows).collect() or own.select("id", "q").limit(settings.sample_rows).collect()
    blobs = [bytes(r["q"]) for r in sorted(picked, key=lambda r: (r["id"], bytes(r["q"])))]
    sample = np.frombuffer(b"".join(blobs), dtype="<i4").reshape(len(blobs), -1).astype(float)
    return Axes(np.concatenate([sample, sample]) if len(sample) == 1 else sample, settings)


_BLOCK = "grp bigint, block bigint, dims int, n int, lo binary, hi binary, labels binary, ids binary, label binary, q binary"


def blocks(rows: DataFrame, axes: Axes, settings: Mining) -> DataFrame:
    """The rows as blocks in the order of the curve, each with its zone map; behind the blocks of a group, the zone map of the
    whole group (``block`` is null)."""

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        dims = batch.column(3).to_numpy()
        curve = np.zeros(len(dims), dtype=np.int64)
        usual = np.flatnonzero(dims == axes.dims)
        if len(usual):
            blobs = batch.column(4).take(pa.array(usual)).to_pylist()
            curve[usual] = axes.places(np.frombuffer(b"".join(blobs), dtype="<i4").reshape(len(usual), -1).astype(float))
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 3, 4)), pa.array(curve)], ["id", "label", "dims", "q", "curve"])

    placed = written(map_slices(rows, place, "id bigint, label bigint, dims int, q binary, curve bigint", rows=4096), "places")
    # the id splits a vector of which there are many
    order = ["dims", "curve", "id"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order, "label", "q").select("dims", "id", "label", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, inside, held, last = TaskContext.get().partitionId() << 24, [], [], None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if row == last:
                    continue
                if held and (len(held) == settings.block_rows or held[0][0] != row[0]):
                    inside.append(_block(group, len(inside), held))
                    held = []
                    if len(inside) == settings.group_blocks or inside[0]["dims"] != row[0]:
                        yield _group(inside)
                        group, inside = group + 1, []
                held.append(row)
                last = row
        if held:
            inside.append(_block(group, len(inside), held))
        if inside:
            yield _group(inside)

    return written(ordered.mapInArrow(run, _BLOCK), "blocks")


_KINDS = [("grp", pa.int64()), ("block", pa.int64()), ("dims", pa.int32()), ("n", pa.int32())]
_KINDS += [(c, pa.binary()) for c in ("lo", "hi", "labels", "ids", "label", "q")]


def _block(group: int, nth: int, rows: list[tuple]) -> dict:
    dims, ids, labels, blobs = zip(*rows)
    q = np.frombuffer(b"".join(blobs), dtype="<i4").reshape(len(rows), dims[0])
    label = np.array(labels, dtype="<i8")
    out = {"grp": group, "block": nth, "dims": dims[0], "n": len(rows), "lo": q.min(axis=0).tobytes(), "hi": q.max(axis=0).tobytes()}
    out |= {"labels": np.unique(label).tobytes(), "ids": np.array(ids, dtype="<i8").tobytes()}
    return out | {"label": label.tobytes(), "q": q.tobytes()}


def _group(inside: list[dict]) -> pa.RecordBatch:
    zones = {c: np.array([np.frombuffer(b[c], dtype="<i4") for b in inside]) for c in ("lo", "hi")}
    whole = {"grp": inside[0]["grp"], "dims": inside[0]["dims"], "n": sum(b["n"] for b in inside)}
    whole |= {"lo": zones["lo"].min(axis=0).tobytes(), "hi": zones["hi"].max(axis=0).tobytes()}
    whole["labels"] = np.unique(np.frombuffer(b"".join(b["labels"] for b in inside), dtype="<i8")).tobytes()
    rows = [*inside, whole]
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in _KINDS], [c for c, _ in _KINDS])


class Readers:
    """Anchors with what they look for: rows of their own label above a score, or of other labels inside windows."""

    def __init__(self, rows: pa.Table, same_label: bool, settings: Mining):
        self.settings, self.same = settings, same_label
        self.key, self.id, self.label = (rows.column(c).to_numpy() for c in ("key", "id", "label"))
        self.q = _matrix(rows.column("q"), "<i4", len(self.key))
        goals = [np.frombuffer(g, dtype="<i8").reshape(-1, 3) for g in rows.column("goals").to_pylist()]
        most = max(map(len, goals))
        # of each window: the positive, its score, the score that must be beaten or met; unused windows are empty
        self.goal = np.stack([np.concatenate([g, np.zeros((most - len(g), 3), dtype=np.int64)]) for g in goals])
        used = np.arange(most) < np.array([len(g) for g in goals])[:, None]
        score, beat = self.goal[:, :, 1], self.goal[:, :, 2]
        if same_label:
            self.lo, self.hi = beat, np.full_like(beat, np.iinfo(np.int64).max)
        else:
            self.lo = np.maximum(-((-settings.low * score) // 100), beat)
            self.hi = np.where(used, (settings.high * score) // 100, _LEAST)
        self.best = settings.positives if same_label else settings.negatives

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest score of each reader with any vector between ``lo`` and ``hi`` (rows: readers)."""
        up, down = np.maximum(self.q, 0).astype(float), np.minimum(self.q, 0).astype(float)
        least, most = up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T
        slack = 1 + 1e-9 * (np.abs(least) + np.abs(most))  # of sums beyond 2^53
        return least - slack, most + slack

    def allowed(self, labels: list[np.ndarray]) -> np.ndarray:
        """Whether each set of labels has what a reader looks for."""
        if self.same:
            return np.stack([np.isin(self.label, own) for own in labels], axis=1)
        return np.stack([(len(own) > 1) | (self.label != own[0]) for own in labels], axis=1)

    def reaches(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether the bounds touch any window of a reader."""
        out = np.zeros(least.shape, dtype=bool)
        for w in range(self.goal.shape[1]):
            out |= (self.lo[:, w : w + 1] <= most) & (self.hi[:, w : w + 1] >= least) & (self.lo <= self.hi)[:, w : w + 1]
        return out

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        a = self.q[rows]
        if self.q.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(q).max(initial=0)) < 2**53:
            return (a.astype(float) @ q.T.astype(float)).astype(np.int64)
        return a @ q.T


def _matrix(column: pa.ChunkedArray, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(n, -1).astype(np.int64)


def first_rows(reader: np.ndarray, window: np.ndarray, score: np.ndarray, id_: np.ndarray, best: int) -> np.ndarray:
    """The places of the first ``best`` rows of each reader's window."""
    order = np.lexsort((id_, -score, window, reader))
    r, w = reader[order], window[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1])
    starts = np.flatnonzero(new)
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[nth < best]


def search(readers: Readers, inside: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(reader, window, score, id) of the first rows of each window in a group, its blocks read as their bounds ask."""
    n = inside.num_rows
    lo, hi = _matrix(inside.column("lo"), "<i4", n), _matrix(inside.column("hi"), "<i4", n)
    labels = [np.frombuffer(x, dtype="<i8") for x in inside.column("labels").to_pylist()]
    least, most = readers.bounds(lo, hi)
    allowed = readers.allowed(labels)
    found = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    for b in np.argsort(-most.max(axis=0), kind="stable"):
        some = np.flatnonzero(allowed[:, b] & readers.reaches(least[:, b : b + 1], most[:, b : b + 1])[:, 0])
        if not len(some):
            continue
        label = np.frombuffer(inside.column("label")[int(b)].as_py(), dtype="<i8")
        q = np.frombuffer(inside.column("q")[int(b)].as_py(), dtype="<i4").reshape(len(label), readers.q.shape[1]).astype(np.int64)
        ids = np.frombuffer(inside.column("ids")[int(b)].as_py(), dtype="<i8")
        score = readers.scores(some, q)
        fit = (label == readers.label[some][:, None]) == readers.same
        fit &= ids != readers.id[some][:, None]
        parts = [found]
        for w in range(readers.goal.shape[1]):
            inside_w = fit & (score >= readers.lo[some, w][:, None]) & (score <= readers.hi[some, w][:, None])
            own = np.where(inside_w, score, _LEAST)
            k = min(readers.best, own.shape[1])
            least_kept = np.partition(own, own.shape[1] - k, axis=1)[:, own.shape[1] - k]
            r, c = np.nonzero(inside_w & (own >= least_kept[:, None]))
            parts.append((some[r], np.full(len(r), w), own[r, c], ids[c]))
        found = tuple(np.concatenate(x) for x in zip(*parts))
        keep = first_rows(*found, readers.best)
        found = tuple(x[keep] for x in found)
        # what is found must be met from now on
        r, w, score, _ = found
        full = np.zeros(readers.lo.shape, dtype=np.int64)
        np.add.at(full, (r, w), 1)
        last = np.full(readers.lo.shape, np.iinfo(np.int64).max)
        np.minimum.at(last, (r, w), score)
        readers.lo = np.where(full == readers.best, np.maximum(readers.lo, last), readers.lo)
    return found


_READER = "key bigint, id bigint, label bigint, dims int, q binary, goals binary"


def chosen(readers: DataFrame, zones: DataFrame, settings: Mining, same_label: bool, promising: bool) -> DataFrame:
    """Each reader with each group (``grp``) that it must read, or with the most promising one of each sheet."""
    chunks = -(-max(readers.count(), 1) // settings.unit_anchors)
    maps = zones.where("block IS NULL").select("grp", "dims", "lo", "hi", "labels").withColumn("sheet", F.shiftright("grp", 11))
    # all sheets of its length for each reader; the salt splits that one key
    salts = 64
    sheets = maps.select("sheet", "dims").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    sheets = sheets.withColumnRenamed("dims", "sheet_dims").withColumnRenamed("salt", "sheet_salt")
    on = (F.col("dims") == F.col("sheet_dims")) & (F.pmod("key", F.lit(salts)).cast("int") == F.col("sheet_salt"))
    asked = readers.join(sheets, on).select(*readers.columns, "sheet")
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int"))
    maps = maps.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    unit = ["sheet", "chunk", "dims"]
    both = asked.unionByName(maps, allowMissingColumns=True).repartition(*unit).sortWithinPartitions(*unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, sizes in whole_units(batches, unit):
            for start, size in zip(starts, sizes):
                own = table.slice(start, size)
                is_zone = own.column("grp").is_valid()
                groups, rows = own.filter(is_zone), own.filter(pc.invert(is_zone))
                if not rows.num_rows or not groups.num_rows:
                    continue
                who = Readers(rows, same_label, settings)
                n = groups.num_rows
                least, most = who.bounds(_matrix(groups.column("lo"), "<i4", n), _matrix(groups.column("hi"), "<i4", n))
                wanted = who.allowed([np.frombuffer(x, dtype="<i8") for x in groups.column("labels").to_pylist()])
                if promising:
                    middle = np.where(wanted, least + most, -np.inf)
                    first = middle.argmax(axis=1)
                    r = np.flatnonzero(wanted.any(axis=1))
                    c = first[r]
                else:
                    r, c = np.nonzero(wanted & who.reaches(least, most))
                out = rows.select([f.split()[0] for f in _READER.split(", ")]).take(pa.array(r))
                out = out.append_column("grp", groups.column("grp").take(pa.array(c)))
                yield from out.combine_chunks().to_batches(max_chunksize=4096)

    return both.mapInArrow(run, f"{_READER}, grp bigint")


def read(readers: DataFrame, zones: DataFrame, settings: Mining, same_label: bool, label: str) -> DataFrame:
    """``key``, ``anchor_id``, ``nth`` (of the window), ``score`` and ``id``: the first rows of each reader's windows in each
    group that it reads."""
    readers = written(readers, label)
    slices = readers.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / settings.unit_anchors).cast("int").alias("slices"))
    slices = written(slices, "slices")
    asked = readers.join(slices, "grp").withColumn("part", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int")).drop("slices")
    asked = asked.withColumnRenamed("label", "own_label")
    data = zones.where("block IS NOT NULL").join(slices, "grp").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    data = data.select("grp", "part", "block", "lo", "hi", "labels", "ids", "label", F.col("q").alias("rows"))
    unit = ["grp", "part"]
    both = asked.unionByName(data, allowMissingColumns=True).repartition(*unit).sortWithinPartitions(*unit)
    mine = ["key", "id", "own_label", "dims", "q", "goals"]
    theirs = ["block", "lo", "hi", "labels", "ids", "label", "rows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, sizes in whole_units(batches, unit):
            for start, size in zip(starts, sizes):
                own = table.slice(start, size)
                is_block = own.column("block").is_valid()
                rows = own.filter(pc.invert(is_block)).select(mine).rename_columns(["key", "id", "label", "dims", "q", "goals"])
                if not rows.num_rows:
                    continue
                who = Readers(rows, same_label, settings)
                inside = own.filter(is_block).select(theirs).rename_columns([*theirs[:-1], "q"])
                r, w, score, ids = search(who, inside)
                arrays = [pa.array(x) for x in (who.key[r], who.id[r], who.goal[r, w, 0], who.goal[r, w, 1], w, score, ids)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "anchor_id", "positive_id", "positive_score", "nth", "score", "id"])

    schema = "key bigint, anchor_id bigint, positive_id bigint, positive_score bigint, nth bigint, score bigint, id bigint"
    return both.mapInArrow(run, schema)


def _best(found: DataFrame, best: int) -> DataFrame:
    """The first rows of each window over all groups, with their ``rank``."""
    order = Window.partitionBy("key", "anchor_id", "nth").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _goals(*parts: str) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """The windows of each row, given as lists of numbers, as one binary."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [batch.column(batch.schema.names.index(p)).to_pylist() for p in parts]
        goals = [np.array(row, dtype="<i8").T.tobytes() for row in zip(*lists)]
        names = [f.split()[0] for f in _READER.split(", ")][:-1]
        arrays = [batch.column(batch.schema.names.index(c)) for c in names]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(goals, pa.binary())], [*names, "goals"])

    return step


def with_goals(rows: DataFrame) -> DataFrame:
    """Readers from rows whose windows are the lists ``to_id``, ``to_score`` and ``beat``."""
    return map_slices(rows, _goals("to_id", "to_score", "beat"), _READER, rows=4096)


def _searched(anchors: DataFrame, windows: DataFrame, zones: DataFrame, settings: Mining, same_label: bool) -> DataFrame:
    """The first rows of each window over all groups: first those of the most promising groups, which must then be met."""
    name = "positives" if same_label else "negatives"
    best = settings.positives if same_label else settings.negatives
    plain = with_goals(windows)
    tried = read(chosen(plain, zones, settings, same_label, True), zones, settings, same_label, f"{name}_tried")
    tried = _best(tried, best).where(F.col("rank") == best)  # a window that has all its rows can do no worse
    beat = tried.groupBy(F.col("key").alias("k")).agg(F.map_from_entries(F.collect_list(F.struct("nth", "score"))).alias("met"))
    known = windows.join(beat, F.col("key") == F.col("k"), "left")
    met = F.transform("beat", lambda b, i: F.greatest(b, F.coalesce(F.try_element_at("met", i.cast("bigint")), b)))
    known = with_goals(known.withColumn("beat", met).drop("k", "met"))
    found = read(chosen(written(known, name), zones, settings, same_label, False), zones, settings, same_label, f"{name}_asked")
    return _best(found, best)


def mine(
    vectors: DataFrame, anchors: Column, settings: Mining = Mining(), id_col: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score`` for the rows that
    ``anchors`` marks."""
    rows = written(usable(vectors, settings, anchors, id_col, vector, label), "usable")
    axes = fit_axes(rows, settings)
    if axes is None:
        axes = Axes(np.zeros((2, 1)), settings)
    zones = blocks(rows, axes, settings)
    own = rows.where("anchor").select(F.xxhash64("id", "label", "q").alias("key"), "id", "label", "dims", "q").distinct()
    own = written(own, "anchors")
    nothing = F.lit(0).cast("bigint")
    first = own.select("*", F.array(nothing).alias("to_id"), F.array(nothing).alias("to_score"), F.array(F.lit(_LEAST)).alias("beat"))
    positives = written(_searched(own, first, zones, settings, True), "best_positives")
    order = F.sort_array(F.collect_list(F.struct("rank", "id", "score")))
    found = positives.groupBy(F.col("key").alias("k"), "anchor_id").agg(order.alias("to"))
    second = own.join(found, (F.col("key") == F.col("k")) & (F.col("id") == F.col("anchor_id"))).select(
        *own.columns,
        F.col("to.id").alias("to_id"),
        F.col("to.score").alias("to_score"),
        F.transform("to", lambda _: F.lit(_LEAST)).alias("beat"),
    )
    negatives = _searched(own, written(second, "windows"), zones, settings, False)
    return negatives.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
