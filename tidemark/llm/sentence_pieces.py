"""SentencePiece encoding and decoding by a max-plus parallel scan.

Encoding finds the segmentation of a text into vocabulary pieces with the greatest sum of piece scores. A text is cut into
chunks; a chunk is told nothing but the state at its ends, which is how many of its characters a piece reaching in
from the chunk before has taken. Each chunk gives a matrix of the best sums from every entry state to every exit state; such
matrices combine associatively (sums of maxima), so the scan over a giant document is a tree of small products and gives
the state at every boundary; then each chunk is traced back by itself. A text of one chunk is the special case with
both states known.

Where no piece of the vocabulary goes on past the beginning of a blank run, texts fall apart there, and the best
segmentation of each part (a word with the blanks before it) is worked out once for all its occurrences. Parts of equal length
are worked out together, one column of characters at a time.

The pieces and scores are those of a SentencePiece model file. Scores are read as those of a unigram model whatever the
file calls itself. Characters outside the vocabulary fall back to byte pieces, or to the unknown id where there are none.

Defined cases: null and empty texts have no ids and decode to an empty text; null ids are carried; repeated rows are
encoded each; the character that stands for a blank inside the model (U+2581) decodes to a blank. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, written

BLANK = "▁"
#: Characters of a chunk. A text with more is cut.
CHUNK = 16_384
#: Characters that are encoded together: the more, the more words they share; the parts of this many are held at once.
TOGETHER = 1_000_000
#: Parts up to this length are worked out in common; longer ones (no blank for so long) one by one.
LONGEST_SHARED = 48
_PART = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_LOW = -1e300


class Vocabulary:
    """Pieces, scores and a hashed lookup of spans."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        scores = np.array([model.get_score(i) for i in range(n)], dtype=float)
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.unknown = model.unk_id()
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown_score = scores[plain].min() - 10
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = np.append(scores, _LOW)  # id -1: no such piece
        self.longest = max(map(len, self.ids))
        #: no piece continues past the start of a blank run
        self.falls_apart = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids)
        self.silent = {i for i in range(n) if model.is_control(i)}
        self._hash()

    def _hash(self, bits: int = 19) -> None:
        """Two tables of span hash -> id; a seed is sought with which every piece finds a free place in one of them."""
        texts = list(self.ids)
        ids = np.fromiter(self.ids.values(), dtype=np.int32)
        keys = np.array([list(self._spans(self._codes([t]), len(t)))[-1][0, 0] for t in texts])
        self.shift = np.uint64(64 - bits)
        for seed in range(1, 200):
            a, b = (np.uint64((0x9E3779B97F4A7C15 * (2 * seed + k) | 1) & (2**64 - 1)) for k in (0, 1))
            first, second = ((keys * m >> self.shift).astype(np.int64) for m in (a, b))
            owner = np.full(1 << bits, -1, dtype=np.int32)
            owner[first[::-1]] = np.arange(len(keys), dtype=np.int32)[::-1]
            rest = np.flatnonzero(owner[first] != np.arange(len(keys)))
            if len(np.unique(second[rest])) == len(rest):
                break
        else:
            raise ValueError("no seed separates the pieces")
        self.factors = (a, b)
        self.tables = []
        for rows, slot in ((np.flatnonzero(owner[first] == np.arange(len(keys))), first), (rest, second)):
            key, value = np.zeros(1 << bits, dtype=np.uint64), np.full(1 << bits, -1, dtype=np.int32)
            key[slot[rows]], value[slot[rows]] = keys[rows], ids[rows]
            self.tables.append((key, value))

    @staticmethod
    def _codes(texts: list[str]) -> np.ndarray:
        """Code points of texts of equal length, one text per row."""
        return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).reshape(len(texts), -1)

    @staticmethod
    def _spans(codes: np.ndarray, sizes: int) -> Iterator[np.ndarray]:
        """Per span size from 1: the hash of each span of each row, made from that of the span one shorter."""
        codes = codes.astype(np.uint64)
        out = np.full(codes.shape, 0x9E3779B97F4A7C15, dtype=np.uint64)
        for size in range(1, sizes + 1):
            out = (out[:, : codes.shape[1] - size + 1] ^ codes[:, size - 1 :]) * np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(32)
            yield out

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Ids of spans by their hashes, -1 where there is no such piece."""
        (key_a, id_a), (key_b, id_b) = self.tables
        a = (keys * self.factors[0] >> self.shift).astype(np.int64)
        b = (keys * self.factors[1] >> self.shift).astype(np.int64)
        return np.where(key_a[a] == keys, id_a[a], np.where(key_b[b] == keys, id_b[b], -1))

    def span_ids(self, codes: np.ndarray) -> list[np.ndarray]:
        """Per span size from 1: the id of the span that begins at each place of each row."""
        return [self.lookup(keys) for keys in self._spans(codes, min(self.longest, codes.shape[1]))]

    def ids_of(self, text: str, start: int, end: int, found: int) -> list[int]:
        """The ids of one step of a path: a piece, or what stands for a character outside the vocabulary."""
        if found >= 0:
            return [int(found)]
        if self.bytes:
            return [self.bytes[b] for b in text[start:end].encode()]
        return [self.unknown]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(vocabulary(path))


def normalised(text: str) -> str:
    """Blanks made visible, and one at the front."""
    return BLANK + text.replace(" ", BLANK) if text else ""


# --- parts of equal length ---------------------------------------------------------------------------------------


def encode_parts(v: Vocabulary, parts: list[str]) -> list[bytes]:
    """Ids (little-endian 32 bits) of each of some parts of equal length."""
    codes = v._codes(parts)
    rows, n = codes.shape
    spans = v.span_ids(codes)
    best = np.full((rows, n + 1), _LOW)
    best[:, 0] = 0
    back = np.zeros((rows, n + 1), dtype=np.int64)
    for e in range(1, n + 1):
        top, size = np.full(rows, -np.inf), np.zeros(rows, dtype=np.int64)
        for k in range(min(e, v.longest), 0, -1):  # among equals the longest last piece
            ids = spans[k - 1][:, e - k]
            gain = best[:, e - k] + v.score[ids]
            if k == 1:
                gain = np.where(ids < 0, best[:, e - 1] + v.unknown_score, gain)
            better = gain > top
            top = np.where(better, gain, top)
            size[better] = k
        best[:, e], back[:, e] = top, size
    # back from the end, all rows a step at a time; ids fill their row from the right
    found, free = np.empty((rows, n), dtype="<u4"), np.full(rows, n)
    at, left = np.full(rows, n), np.arange(rows)
    outside = np.zeros(rows, dtype=bool)
    while len(left):
        size = back[left, at[left]]
        for k in np.unique(size):
            own = left[size == k]
            ids = spans[k - 1][own, at[own] - k]
            free[own] -= 1
            found[own, free[own]] = ids.astype(np.uint32)
            outside[own[ids < 0]] = True
        at[left] -= size
        left = left[at[left] > 0]
    raw = found.tobytes()
    out = [raw[4 * (r * n + f) : 4 * (r + 1) * n] for r, f in enumerate(free.tolist())]
    for r in np.flatnonzero(outside):
        out[r] = _with_fallback(v, parts[r], back[r], out[r])
    return out


def _with_fallback(v: Vocabulary, text: str, back: np.ndarray, ids: bytes) -> bytes:
    """Ids of a part that holds characters outside the vocabulary."""
    ends, e = [], len(text)
    while e:
        ends.append(e)
        e -= int(back[e])
    out: list[int] = []
    for e, i in zip(reversed(ends), np.frombuffer(ids, dtype="<u4").view(np.int32)):
        out += v.ids_of(text, e - int(back[e]), e, int(i))
    return np.array(out, dtype="<u4").tobytes()


class Encoder:
    """Encodes texts; keeps the ids of parts it has seen, up to a bound."""

    def __init__(self, v: Vocabulary, remember: int = 150_000):
        self.v, self.remember, self.known = v, remember, {}

    def parts(self, text: str) -> list[str]:
        return _PART.findall(text) if self.v.falls_apart else [text] if text else []

    def learn(self, parts: set[str]) -> None:
        new = parts.difference(self.known)
        if len(self.known) + len(new) > self.remember:
            self.known = {p: self.known[p] for p in parts if p in self.known}
        by_size: dict[int, list[str]] = {}
        for p in new:
            by_size.setdefault(len(p), []).append(p)
        for size, own in by_size.items():
            if size > LONGEST_SHARED:
                for p in own:
                    self.known[p] = encode_long(self.v, p)
                continue
            for lo in range(0, len(own), 8192):
                self.known.update(zip(own[lo : lo + 8192], encode_parts(self.v, own[lo : lo + 8192])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of normalised texts."""
        out: list[bytes] = []
        while len(out) < len(texts):
            cut, size = [], 0
            for t in texts[len(out) :]:
                size += len(t)
                if cut and size > TOGETHER:
                    break
                cut.append(self.parts(t))
            self.learn({p for parts in cut for p in parts})
            out += [b"".join(map(self.known.__getitem__, parts)) for parts in cut]
        return out


# --- chunks ------------------------------------------------------------------------------------------------------


def _lattice(v: Vocabulary, text: str) -> np.ndarray:
    """Score of the piece of each size (rows, from 1) that begins at each place; the lowest where there is none."""
    spans = v.span_ids(v._codes([text]))
    out = np.full((v.longest, len(text)), _LOW)
    for k, ids in enumerate(spans):
        out[k, : ids.shape[1]] = v.score[ids[0]]
        if k == 0:
            out[0] = np.where(ids[0] < 0, v.unknown_score, out[0])
    return out


def transfer(v: Vocabulary, text: str, size: int, first: bool = False) -> np.ndarray:
    """Best sums from each entry state to each exit state of a chunk: the first ``size`` characters of ``text``, which goes
    on as far as a piece can reach past the chunk. State s: a piece from before takes the first s characters."""
    n = v.longest
    lattice = _lattice(v, text)
    ends = np.full((size + n, n), _LOW)  # best sum of each place, per entry state
    for s in range(min(n, size) if not first else 1):
        ends[s, s] = 0
    for at in range(size):
        here = ends[at]
        if here.max() <= _LOW / 2:
            continue
        reach = min(n, len(text) - at)
        ends[at + 1 : at + 1 + reach] = np.maximum(ends[at + 1 : at + 1 + reach], here + lattice[:reach, at, None])
    out = ends[size : size + n].T.copy()
    for s in range(size, n):  # a piece that takes the whole chunk
        out[s, s - size] = 0
    out[out < _LOW / 2] = _LOW
    return out


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The matrix of two chunks in a row."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), _LOW)


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at each end of each chunk on the best path that begins and ends between pieces, by a tree of products:
    the states around a pair of chunks are known before the one between them is chosen."""
    if len(matrices) == 1:
        return [0, 0]
    pairs = [compose(matrices[i], matrices[i + 1]) for i in range(0, len(matrices) - 1, 2)]
    if len(matrices) % 2:
        pairs.append(matrices[-1])
    outer = boundary_states(pairs)
    out = []
    for k, state in enumerate(outer[:-1]):
        out.append(state)
        if 2 * k + 1 < len(matrices):
            between = matrices[2 * k][state, :] + matrices[2 * k + 1][:, outer[k + 1]]
            out.append(int(between.argmax()))
    return [*out, outer[-1]]


def trace(v: Vocabulary, text: str, size: int, entry: int, leave: int) -> bytes:
    """Ids of the pieces that begin in a chunk, its states given."""
    spans = v.span_ids(v._codes([text]))
    n, end = v.longest, size + leave
    if entry >= size:
        return b""
    best = np.full(end + 1, _LOW)
    best[entry] = 0
    back = np.zeros(end + 1, dtype=np.int64)
    ids = np.full((n, len(text)), -1, dtype=np.int64)
    for k, found in enumerate(spans):
        ids[k, : found.shape[1]] = found[0]
    scores = v.score[ids]
    scores[0] = np.where(ids[0] < 0, v.unknown_score, scores[0])
    for e in range(entry + 1, end + 1):
        if size < e < end:
            continue  # no piece of this chunk may end there
        sizes = np.arange(1, min(n, e - entry) + 1)
        starts = e - sizes
        gain = np.where(starts < size, best[starts] + scores[sizes - 1, starts], _LOW)
        k = len(gain) - 1 - int(gain[::-1].argmax())  # among equals the longest
        best[e], back[e] = gain[k], sizes[k]
    out: list[int] = []
    while end > entry:
        start = end - int(back[end])
        out.extend(reversed(v.ids_of(text, start, end, int(ids[end - start - 1, start]))))
        end = start
    return np.array(out[::-1], dtype="<u4").tobytes()


def chunk_bounds(v: Vocabulary, text: str, chunk: int) -> list[int]:
    """Where a text is cut: after every ``chunk`` characters, moved on to the next place where texts fall apart if that is
    not further than another chunk."""
    bounds = [0]
    while len(text) - bounds[-1] > chunk:
        cut = bounds[-1] + chunk
        if v.falls_apart:
            at = text.find(BLANK, cut, cut + chunk)
            while at > 0 and text[at - 1] == BLANK:
                at = text.find(BLANK, at + 1, cut + chunk)
            cut = at if at > 0 else cut
        bounds.append(cut)
    return [*bounds, len(text)]


def encode_long(v: Vocabulary, text: str, chunk: int = CHUNK) -> bytes:
    """Ids of one text by the scan over its chunks."""
    if not text:
        return b""
    bounds = [*range(0, len(text), chunk), len(text)]
    cut = [(text[a : b + v.longest - 1], b - a) for a, b in zip(bounds, bounds[1:])]
    states = boundary_states([transfer(v, t, n, k == 0) for k, (t, n) in enumerate(cut)]) if len(cut) > 1 else [0, 0]
    return b"".join(trace(v, t, n, a, b) for (t, n), a, b in zip(cut, states, states[1:]))


def decode(v: Vocabulary, ids: np.ndarray) -> str:
    """The text of some ids."""
    pieces = v.pieces
    if v.silent and not v.silent.isdisjoint(ids.tolist()):
        ids = ids[~np.isin(ids, list(v.silent))]
    listed = ids.tolist()
    if v.bytes:
        of = {i: b for b, i in v.bytes.items()}
        if not of.keys().isdisjoint(listed):
            raw = b"".join(bytes((of[i],)) if i in of else pieces[i].encode() for i in listed)
            return _plain(raw.decode("utf-8", "replace"))
    return _plain("".join([pieces[i] for i in listed]))


def _plain(text: str) -> str:
    return text.replace(BLANK, " ").removeprefix(" ")


# --- on tables ---------------------------------------------------------------------------------------------------


def _whole(docs: DataFrame, path: str, kind: str) -> DataFrame:
    """Documents of one chunk, encoded at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                found = encoder.encode([normalised(t or "") for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def _giant(docs: DataFrame, path: str, kind: str, chunk: int) -> DataFrame:
    """Documents of several chunks: matrices, states, then every chunk traced back by itself."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("version"), "text").dropDuplicates(["doc_id", "version"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            for i, value in enumerate(batch.column(2).to_pylist()):
                text = normalised(value)
                bounds = chunk_bounds(v, text, chunk)
                at = pa.array([i] * (len(bounds) - 1))
                bodies = [text[a : b + v.longest - 1] for a, b in zip(bounds, bounds[1:])]
                sizes = [b - a for a, b in zip(bounds, bounds[1:])]
                arrays = [batch.column(0).take(at), batch.column(1).take(at), pa.array(range(len(sizes)), pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(sizes, pa.int64()), pa.array(bodies)], ["doc_id", "version", "chunk", "size", "body"]
                )

    chunks = written(
        keyed.mapInArrow(cut, f"doc_id {kind}, version bigint, chunk bigint, size bigint, body string").repartition(
            "doc_id", "version", "chunk"
        ),
        "chunks",
    )

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            number, size, body = (batch.column(c).to_pylist() for c in (2, 3, 4))
            made = [_ends(v, t, n, k == 0).tobytes() for k, n, t in zip(number, size, body)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(made, pa.binary())], ["doc_id", "version", "chunk", "matrix"]
            )

    made = chunks.mapInArrow(matrices, f"doc_id {kind}, version bigint, chunk bigint, matrix binary")
    # a document's matrices are small: a few hundred numbers for each 16,384 characters
    per_doc = made.groupBy("doc_id", "version").agg(F.array_sort(F.collect_list(F.struct("chunk", "matrix"))).alias("found"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = vocabulary(path).longest
        for batch in batches:
            at, number, enter, leave = [], [], [], []
            for i, found in enumerate(batch.column(2).to_pylist()):
                states = boundary_states([np.frombuffer(x["matrix"]).reshape(n, n) for x in found])
                at += [i] * len(found)
                number += range(len(found))
                enter += states[:-1]
                leave += states[1:]
            take = pa.array(at, pa.int64())
            arrays = [batch.column(0).take(take), batch.column(1).take(take)]
            arrays += [pa.array(x, pa.int64()) for x in (number, enter, leave)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "version", "chunk", "enter", "leave"])

    states = per_doc.mapInArrow(scan, f"doc_id {kind}, version bigint, chunk bigint, enter bigint, leave bigint")
    s = states.select(*(F.col(c).alias(f"s_{c}") for c in states.columns))
    placed = chunks.join(
        s,
        F.col("doc_id").eqNullSafe(F.col("s_doc_id")) & (F.col("version") == F.col("s_version")) & (F.col("chunk") == F.col("s_chunk")),
    ).select("doc_id", "version", "chunk", "size", "body", "s_enter", "s_leave")

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, TOGETHER // chunk + 1):
                part = batch.slice(lo, TOGETHER // chunk + 1)
                size, body, enter, leave = (part.column(c).to_pylist() for c in (3, 4, 5, 6))
                made = traced(encoder, body, size, enter, leave)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(made, pa.binary())], ["doc_id", "version", "chunk", "ids"]
                )

    return placed.mapInArrow(back, f"doc_id {kind}, version bigint, chunk bigint, ids binary")


def _cuts(v: Vocabulary, text: str, size: int) -> tuple[int, int] | None:
    """The first and the last place inside a chunk (its end included) where texts fall apart. Its beginning may lie within
    a blank run, which only the chunk before could tell."""
    if not v.falls_apart:
        return None
    first = 1
    while first < size and (text[first] != BLANK or text[first - 1] == BLANK):
        first += 1
    if first >= size:
        return None
    last = size
    while last > first and (last >= len(text) or text[last] != BLANK or text[last - 1] == BLANK):
        last -= 1
    return first, last


def _ends(v: Vocabulary, text: str, size: int, first: bool) -> np.ndarray:
    """The matrix of a chunk. Between the first and the last place where it falls apart every path is in the same state,
    and what it gains there is the same for all: only the two ends are worked out."""
    cuts = _cuts(v, text, size)
    if cuts is None or len(text) == size and size < 2 * v.longest:
        return transfer(v, text, size, first)
    a, b = cuts
    head = transfer(v, text[:a], a, first)[:, :1]
    tail = transfer(v, text[b:], size - b, True)[:1] if b < size else np.where(np.arange(v.longest) == 0, 0.0, _LOW)[None]
    return np.maximum(head + tail, _LOW)


def traced(encoder: Encoder, texts: list[str], sizes: list[int], enter: list[int], leave: list[int]) -> list[bytes]:
    """Ids of the pieces that begin in each chunk; parts that lie inside the chunks come from the encoder."""
    v = encoder.v
    cuts = [_cuts(v, t, n) for t, n in zip(texts, sizes)]
    bodies = iter(encoder.encode([t[c[0] : c[1]] for t, c in zip(texts, cuts) if c]))
    out = []
    for t, n, c, a, b in zip(texts, sizes, cuts, enter, leave):
        if c is None:
            out.append(trace(v, t, n, a, b))
            continue
        tail = trace(v, t[c[1] :], n - c[1], 0, b) if c[1] < n else b""
        out.append(trace(v, t[: c[0]], c[0], a, 0) + next(bodies) + tail)
    return out


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per document: ``doc_id`` and ``ids`` (little-endian 32-bit numbers)."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    giant = F.coalesce(F.length("text") >= chunk, F.lit(False))
    small = _whole(chosen.where(~giant), path=model_path, kind=kind)
    large = chosen.where(giant)
    times = large.groupBy("doc_id", F.xxhash64("text").alias("version")).agg(F.count(F.lit(1)).alias("times"))
    parts = _giant(large, model_path, kind, chunk)
    joined = parts.groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("found")  # one document
    )
    t = times.select(F.col("doc_id").alias("t_id"), F.col("version").alias("t_version"), "times")
    whole = joined.join(t, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("version") == F.col("t_version")))
    whole = whole.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))

    def glue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [b"".join(x["ids"] for x in found) for found in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "ids"])

    large_ids = whole.select("doc_id", "found").mapInArrow(glue, f"doc_id {kind}, ids binary")
    return small.unionByName(large_ids)


def with_texts(encoded: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``n_ids``, ``ids_crc32``, and ``n_chars`` and ``text_crc32`` of the text that the ids decode to."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                raws = part.column(1).to_pylist()
                found = [decode(v, np.frombuffer(b, dtype="<u4")) for b in raws]
                columns = [
                    [len(b) // 4 for b in raws],
                    [zlib.crc32(b) for b in raws],
                    [len(t) for t in found],
                    [zlib.crc32(t.encode()) for t in found],
                ]
                arrays = [part.column(0), *(pa.array(c, pa.int64()) for c in columns)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_ids", "ids_crc32", "n_chars", "text_crc32"])

    return encoded.mapInArrow(run, f"doc_id {kind}, n_ids bigint, ids_crc32 bigint, n_chars bigint, text_crc32 bigint")
