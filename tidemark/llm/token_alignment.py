"""Alignment of two tokenizers by lockstep merging.

Every text, behind one blank, is encoded by a byte-level vocabulary (A) and by a vocabulary of pieces (B). The byte
offsets where tokens of both end are *cuts*; between two cuts lies a *group*, and each of its A tokens is *linked* to each
of its B tokens. An id pair is *held* by a document that has it linked; among the pairs of an A id those held by most
documents are its best.

* Lockstep merging: the documents of a batch are lanes, a long one is several, each beginning where tokens of both end.
  One state vector has the two pointers of all lanes; a step compares the ends of their tokens, emits a cut in every lane
  where they agree (its group holds the links), and advances the pointer whose token ends first, or both. Lanes that have
  ended are taken out.
* Encoding: neither vocabulary joins across a single blank between two characters that aren't blank, so a text is encoded
  in stretches cut there, and each worker remembers the ids of the stretches that it has seen.
* Counting: a block of documents yields a row for each id pair with the documents that hold it, so a pair of most
  documents is a row in each block, no hot key. Held counts are joined to those rows, and each block sums up for its own
  documents. Neither tokens nor links are shuffled one by one.

Memory is bounded by a block (``block_links``, ``block_docs``) and a segment (``segment_tokens``), which may be a part of
one document. Defined cases: null and empty texts, texts that aren't valid UTF-8, and those whose tokens do not spell the
text (such that hold U+2581) have no tokens, which gives zeros and an empty ``groups``; repeated rows and null ids are
documents of their own; an empty table gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, whole_units, written

BLANK_PIECE = "▁"
#: A single blank between two characters that aren't blank.
_CUT = re.compile(r" (?<=\S )(?=\S)")


@dataclass(frozen=True)
class Alignment:
    lane_tokens: int = 512
    segment_tokens: int = 400_000
    block_docs: int = 8192
    block_links: int = 4_000_000
    remembered: int = 200_000
    plain_group: int = 4096


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a: np.ndarray, b: np.ndarray, a_stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last A and the last B token of each group, in order. Lanes begin at tokens ``a`` and ``b``, end before ``a_stop``
    and begin and end where tokens of both do."""
    a, b, cuts_a, cuts_b = a.copy(), b.copy(), [], []
    while len(a):
        x, y = a_end[a], b_end[b]
        cut = x == y
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a += x <= y
        b += y <= x
        going = a < a_stop
        if not going.all():
            a, b, a_stop = a[going], b[going], a_stop[going]
    if not cuts_a:
        return a, b
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


class Encoders:
    """Both vocabularies, and the ids of the stretches met so far."""

    def __init__(self, ranks_path: str, model_path: str, remembered: int):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [self._spelled(i) for i in range(self._b.vocab_size())]
        if any(b" " in token.lstrip(b" ") for token in self.b_bytes):
            raise ValueError(f"{model_path} has pieces that go on after a blank")
        self.a_size, self.b_size = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = _digits(len(self.a_bytes)), _digits(len(self.b_bytes))
        self._most = remembered
        self.forget()

    def _spelled(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace(BLANK_PIECE, " ").encode()

    def forget(self) -> None:
        self._known: dict[str, int] = {}
        self.a_ids = self.b_ids = self.a_n = self.b_n = self.a_at = self.b_at = np.zeros(0, dtype=np.int64)
        self.right = self.edge = np.zeros(0, dtype=bool)

    def tidy(self) -> None:
        if len(self._known) > self._most or len(self.a_ids) + len(self.b_ids) > 20 * self._most:
            self.forget()

    def places(self, stretches: list[str]) -> np.ndarray:
        """Where the stretches, each behind one blank, are remembered."""
        new = [s for s in dict.fromkeys(stretches) if s not in self._known]
        if new:
            self._learn(new)
        return np.fromiter(map(self._known.__getitem__, stretches), dtype=np.int64, count=len(stretches))

    def _learn(self, new: list[str]) -> None:
        # those that may follow one another behind single blanks are encoded as one text
        follows = [bool(s) and not s[0].isspace() and not s[-1].isspace() for s in new]
        plain = [s for s, f in zip(new, follows) if f]
        if plain:
            self._encode(plain, False)
        for s in (s for s, f in zip(new, follows) if not f):
            self._encode([s], True)

    def _encode(self, new: list[str], edge: bool) -> None:
        text = " " + " ".join(new)
        sizes = np.fromiter((len(s.encode()) + 1 for s in new), dtype=np.int64, count=len(new))
        a = np.array(self._a.encode_ordinary(text), dtype=np.int64)
        lists = self._b.encode(new, num_threads=1)  # adds each blank itself
        b = np.array(list(chain.from_iterable(lists)), dtype=np.int64)
        right = all(b"".join([spelled[i] for i in x.tolist()]) == text.encode() for x, spelled in ((a, self.a_bytes), (b, self.b_bytes)))
        stops = np.searchsorted(np.cumsum(self.a_size[a]), np.cumsum(sizes)) + 1
        found = [(a, np.diff(stops, prepend=0)), (b, np.fromiter(map(len, lists), dtype=np.int64, count=len(new)))]
        if not right and len(new) > 1:  # look for those that the tokens do not spell
            half = len(new) // 2
            self._encode(new[:half], edge)
            self._encode(new[half:], edge)
            return
        first = len(self._known)
        self._known.update(zip(new, range(first, first + len(new))))
        for (ids, n), name in zip(found, "ab"):
            at = np.cumsum(n) - n + len(getattr(self, f"{name}_ids"))
            for field, value in (("ids", ids), ("n", n), ("at", at)):
                setattr(self, f"{name}_{field}", np.concatenate([getattr(self, f"{name}_{field}"), value]))
        self.right = np.append(self.right, np.full(len(new), right))
        self.edge = np.append(self.edge, np.full(len(new), edge))


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to n - 1 in rows that leave room for a sign behind, and how many there are."""
    text = [str(i).encode() for i in range(n)]
    width = len(text[-1]) + 1
    table = np.frombuffer(b"".join(t.ljust(width) for t in text), dtype=np.uint8).reshape(n, width)
    return table, np.array([len(t) for t in text])


@lru_cache(maxsize=1)
def _encoders(ranks_path: str, model_path: str, remembered: int) -> Encoders:
    return Encoders(ranks_path, model_path, remembered)


class _Block:
    """Documents with their counts, and the id pairs that they hold."""

    def __init__(self, encoders: Encoders, settings: Alignment, task: int, with_groups: bool):
        self.encoders, self.settings, self.with_groups = encoders, settings, with_groups
        self._next = task << 24
        self._clear()

    def _clear(self) -> None:
        self.ids: list[pa.Array] = []
        self.counts: list[np.ndarray] = []  # n_a, n_b, n_groups, n_links
        self.groups: list[str] = []
        self.keys: list[np.ndarray] = []
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    @property
    def full(self) -> bool:
        return len(self.groups) + SLICE > min(self.settings.block_docs, 1 << 16) or self.size > self.settings.block_links

    def add(self, ids: pa.Array, raws: list[bytes | None]) -> None:
        enc, first = self.encoders, len(self.groups)
        enc.tidy()
        texts = [_text(raw) for raw in raws]
        stretches = [t.split(" ") if t else [] for t in texts]
        sizes = np.array([len(s) for s in stretches])
        found = np.split(enc.places([s for own in stretches for s in own]), np.cumsum(sizes)[:-1])
        for i, own in enumerate(found):
            if enc.edge[own].any():  # runs of blanks stay whole
                found[i] = enc.places(_CUT.split(texts[i]))
            if not enc.right[found[i]].all():
                found[i] = found[i][:0]
        sizes = np.array([len(f) for f in found])
        at, doc = np.concatenate(found), np.repeat(np.arange(len(raws)), sizes)
        counts = np.zeros((4, len(raws)), dtype=np.int64)
        spelled = [hashlib.sha256() if n and not self.with_groups else bytearray() for n in sizes]
        begun = np.zeros(len(raws), dtype=bool)
        tokens = np.cumsum(enc.a_n[at] + enc.b_n[at])
        cuts = np.flatnonzero(np.diff(tokens // self.settings.segment_tokens)) + 1
        for own, docs in zip(np.split(at, cuts), np.split(doc, cuts)):
            if len(own):
                self._segment(own, docs, first, counts, spelled, begun)
        self.ids.append(ids)
        self.counts.append(counts)
        self.groups += [s.hexdigest() if n and not self.with_groups else bytes(s).decode() for s, n in zip(spelled, sizes)]

    def _segment(self, at: np.ndarray, doc: np.ndarray, first: int, counts: np.ndarray, spelled: list, begun: np.ndarray) -> None:
        enc = self.encoders
        n_a, n_b = enc.a_n[at], enc.b_n[at]
        a_ids, b_ids = enc.a_ids[_ranges(enc.a_at[at], n_a)], enc.b_ids[_ranges(enc.b_at[at], n_b)]
        a_end, b_end = np.cumsum(enc.a_size[a_ids]), np.cumsum(enc.b_size[b_ids])
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        a, b = self._lanes(doc, stop_a - n_a, stop_b - n_b, a_end, b_end)
        last_a, last_b = lockstep(a_end, b_end, a, b, np.append(a[1:], len(a_ids)))
        of = doc[np.searchsorted(stop_a, last_a, side="right")]
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        for row, n in enumerate((size_a, size_b, 1, size_a * size_b)):
            np.add.at(counts[row], of, n)
        self._spell(a_ids, b_ids, last_a, last_b, size_a, size_b, of, spelled, begun)
        self._link(a_ids, b_ids, last_a, last_b, size_a, size_b, of + first)

    def _lanes(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where lanes begin: with a document, and at about every ``lane_tokens`` tokens where tokens of both do."""
        n = self.settings.lane_tokens
        starts = np.diff(doc, prepend=-1) != 0
        starts[1:] |= np.diff((a + b) // n) != 0
        a, b = a[starts], b[starts]
        stop_a, stop_b = np.append(a[1:], len(a_end)), np.append(b[1:], len(b_end))
        inside = [(a, b)]
        for lane in np.flatnonzero(stop_a - a > 4 * n):  # a stretch without a blank: look for common ends
            own = b_end[b[lane] : stop_b[lane]]
            for at in range(a[lane] + n, stop_a[lane] - n, n):
                ends = a_end[at : at + 64]
                place = np.searchsorted(own, ends)
                same = np.flatnonzero(own[np.minimum(place, len(own) - 1)] == ends)
                if len(same):
                    inside.append((np.array([at + same[0] + 1]), np.array([b[lane] + place[same[0]] + 1])))
        a, b = (np.unique(np.concatenate(x)) for x in zip(*inside))
        return a[a < len(a_end)], b[b < len(b_end)]

    def _spell(self, a_ids, b_ids, last_a, last_b, size_a, size_b, of, spelled, begun) -> None:  # noqa: ANN001
        """The groups as text, to what each document has spelled so far."""
        (a_text, a_len), (b_text, b_len) = self.encoders.a_text, self.encoders.b_text
        group_a, group_b = np.repeat(np.arange(len(of)), size_a), np.repeat(np.arange(len(of)), size_b)
        place_a = np.arange(len(a_ids)) + (last_b - size_b + 1)[group_a]
        place_b = np.arange(len(b_ids)) + (last_a + 1)[group_b]
        width = max(a_text.shape[1], b_text.shape[1])
        table = np.empty((len(a_ids) + len(b_ids), width), dtype=np.uint8)
        lengths = np.empty(len(table), dtype=np.int64)
        for ids, place, text, n, last, sign in (
            (a_ids, place_a, a_text, a_len, last_a, b"|"),
            (b_ids, place_b, b_text, b_len, last_b, b";"),
        ):
            table[place, : text.shape[1]] = text[ids]
            lengths[place] = n[ids]
            signs = np.full(len(ids), ord(","), dtype=np.uint8)
            signs[last] = ord(sign)
            table[place, n[ids]] = signs
        flat = table[np.arange(width) <= lengths[:, None]]
        ends = np.cumsum(lengths + 1)
        lasts = np.flatnonzero(np.diff(of, append=-1))  # the last group of each document here
        start = 0
        for d, stop in zip(of[lasts], ends[place_b[last_b[lasts]]]):
            if begun[d]:
                _extend(spelled[d], b";")
            begun[d] = True
            _extend(spelled[d], flat[start : stop - 1].tobytes())
            start = stop

    def _link(self, a_ids, b_ids, last_a, last_b, size_a, size_b, of) -> None:  # noqa: ANN001
        """One key for each link, of its pair and its document; of large groups the keys once with their numbers."""
        links = size_a * size_b
        pairs = len(self.encoders.b_bytes)
        key = lambda a, b, d: ((a * pairs + b) << 16) | d
        one = links == 1
        self._take(key(a_ids[last_a[one]], b_ids[last_b[one]], of[one]))
        some = np.flatnonzero((links > 1) & (links <= self.settings.plain_group))
        if len(some):
            cuts = np.flatnonzero(np.diff(np.cumsum(links[some]) // self.settings.segment_tokens)) + 1
            for g in np.split(some, cuts):
                n, width = links[g], np.repeat(size_b[g], links[g])
                nth = _ranges(np.zeros(len(g), dtype=np.int64), n)
                a = np.repeat(last_a[g] - size_a[g] + 1, n) + nth // width
                b = np.repeat(last_b[g] - size_b[g] + 1, n) + nth % width
                self._take(key(a_ids[a], b_ids[b], np.repeat(of[g], n)))
        for g in np.flatnonzero(links > self.settings.plain_group):
            a, many_a = np.unique(a_ids[last_a[g] - size_a[g] + 1 : last_a[g] + 1], return_counts=True)
            b, many_b = np.unique(b_ids[last_b[g] - size_b[g] + 1 : last_b[g] + 1], return_counts=True)
            self.counted.append((key(a[:, None], b, of[g]).ravel(), (many_a[:, None] * many_b).ravel()))
            self.size += len(a) * len(b)

    def _take(self, keys: np.ndarray) -> None:
        self.keys.append(keys)
        self.size += len(keys)

    def flush(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """A row for each document, and one for each id pair with the documents that hold it."""
        if not self.groups:
            return
        block, n = self._next, len(self.groups)
        self._next += 1
        ids = pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in self.ids])
        counts = np.concatenate(self.counts, axis=1)
        own = {"id": ids, "block": np.full(n, block), "at": pa.array(range(n), pa.int32())}
        own |= dict(zip(("n_a", "n_b", "n_groups", "n_links"), counts)) | {"groups": self.groups}
        yield _batch(own, n, id_type)

        keys, many = np.unique(np.concatenate(self.keys), return_counts=True) if self.keys else (np.zeros(0, dtype=np.int64),) * 2
        if self.counted:
            keys, place = np.unique(np.concatenate([keys, *(k for k, _ in self.counted)]), return_inverse=True)
            many = np.concatenate([many, *(m for _, m in self.counted)])
            many, parts = np.zeros(len(keys), dtype=np.int64), many
            np.add.at(many, place, parts)
        starts = np.flatnonzero(np.diff(keys >> 16, prepend=-1))
        stops = np.append(starts[1:], len(keys))
        pair = keys[starts] >> 16
        pairs = len(self.encoders.b_bytes)
        docs, many = (keys & 0xFFFF).astype("<u2"), many.astype("<i8")
        for lo in range(0, len(starts), 1 << 14):
            s, e, p = starts[lo : lo + (1 << 14)], stops[lo : lo + (1 << 14)], pair[lo : lo + (1 << 14)]
            held = {"block": np.full(len(p), block), "a": (p // pairs).astype(np.int32), "b": (p % pairs).astype(np.int32)}
            held |= {"holders": e - s, "docs": _blobs(docs[s[0] : e[-1]], e - s), "many": _blobs(many[s[0] : e[-1]], e - s)}
            yield _batch(held, len(p), id_type)
        self._clear()


def _text(raw: bytes | None) -> str:
    try:
        return raw.decode() if raw else ""
    except UnicodeDecodeError:
        return ""


def _extend(spelled, more: bytes) -> None:  # noqa: ANN001
    spelled.extend(more) if isinstance(spelled, bytearray) else spelled.update(more)


def _blobs(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of the values as binary."""
    offsets = np.append(0, np.cumsum(sizes) * values.itemsize).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


_FIELDS = {"block": pa.int64(), "at": pa.int32(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64()}
_FIELDS |= {"groups": pa.string(), "a": pa.int32(), "b": pa.int32(), "holders": pa.int64(), "docs": pa.binary(), "many": pa.binary()}
_SCHEMA = "block bigint, at int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string"
_SCHEMA += ", a int, b int, holders bigint, docs binary, many binary"


def _batch(columns: dict, n: int, id_type: pa.DataType) -> pa.RecordBatch:
    kinds = {"id": id_type} | _FIELDS
    arrays = [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def blocks(
    docs: DataFrame, ranks_path: str, model_path: str, settings: Alignment, id_col: str, text: str, with_groups: bool
) -> DataFrame:
    """The rows of all blocks: those of documents have ``at``, those of id pairs ``a`` and ``b``."""
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(_encoders(ranks_path, model_path, settings.remembered), settings, TaskContext.get().partitionId(), with_groups)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                block.add(part.column(0), part.column(1).to_pylist())
                if block.full:
                    yield from block.flush(kind)
        yield from block.flush(kind)

    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, {_SCHEMA}")


def align(
    docs: DataFrame,
    ranks_path: str,
    model_path: str,
    settings: Alignment = Alignment(),
    id_col: str = "doc_id",
    text: str = "text",
    with_groups: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Of every document ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (their text ``a1,a2|b1;a3|b2,b3``
    with ``with_groups``, else its sha256), ``n_best`` and ``count_sum``; and of every id pair ``a``, ``b``, ``held`` and
    ``best``."""
    rows = written(blocks(docs, ranks_path, model_path, settings, id_col, text, with_groups), "alignments")
    pairs = rows.where("at IS NULL").select("block", "a", "b", "holders")
    counts = pairs.groupBy("a", "b").agg(F.sum("holders").alias("held"))
    top = F.max("held").over(Window.partitionBy("a"))  # at most as many rows as B has ids
    # written, so that the join stands between two plain shuffles; merged at every size
    counts = written(counts.withColumn("best", F.col("held") == top), "pairs")
    held = pairs.drop("holders").join(counts.hint("merge"), ["a", "b"])
    # the documents of a block and of its pairs, and what is known of the pairs, meet again
    both = rows.drop("holders").unionByName(held, allowMissingColumns=True).repartition("block").sortWithinPartitions("block")
    kept = ["id", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, sizes in whole_units(batches, ["block"]):
            for start, size in zip(starts, sizes):
                unit = table.slice(start, size)
                is_doc, is_count = unit.column("at").is_valid(), unit.column("held").is_valid()
                documents, known = unit.filter(is_doc).combine_chunks(), unit.filter(is_count)
                place = documents.column("at").to_numpy()
                sums = np.zeros((2, int(place.max()) + 1), dtype=np.int64)
                links = unit.filter(pc.invert(pc.or_(is_doc, is_count)))
                if links.num_rows:
                    asked, told = _pair(links), _pair(known)
                    order = np.argsort(told)
                    at = order[np.searchsorted(told[order], asked)]
                    n = pc.binary_length(links.column("docs")).to_numpy() // 2
                    best = np.repeat(known.column("best").to_numpy()[at], n)
                    doc, many = _joined(links.column("docs"), "<u2"), _joined(links.column("many"), "<i8")
                    np.add.at(sums[0], doc[best], many[best])
                    np.add.at(sums[1], doc, many * np.repeat(known.column("held").to_numpy()[at], n))
                out = documents.select(kept)
                for name, values in zip(("n_best", "count_sum"), sums):
                    out = out.append_column(name, pa.array(values[place]))
                yield from out.combine_chunks().to_batches()

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, n_best bigint, count_sum bigint"
    return both.mapInArrow(run, schema), counts


def _pair(rows: pa.Table) -> np.ndarray:
    return rows.column("a").to_numpy().astype(np.int64) << 32 | rows.column("b").to_numpy()


def _joined(blobs: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), dtype=kind).astype(np.int64)
