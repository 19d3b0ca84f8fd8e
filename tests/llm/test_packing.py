import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tidemark.llm import packing as P
from tidemark.llm.queries import QUERIES, byte_vocabulary

from .cases import clashing, frame, odd_rows


def whole_places(rows, capacity=2048):
    """Sequences are filled from 0 without gaps and never over capacity; gives their number."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_against_the_full_tokenizer(spark):
    rows = QUERIES["op4_best_fit_packing"](spark, SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(docs)
    for i, own in by.items():
        ids = [*full.encode(docs[i] or "", add_special_tokens=False).ids, 0]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and own[0].start == 0
        assert all(r.length == 2048 for r in own[1:]) and sum(r.length for r in own) == len(ids)
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
    used = whole_places(rows)
    assert used <= 1.01 * sum(r.length for r in rows) / 2048 + 1


@pytest.mark.parametrize("text", ["<|endoftext|> a", "x" * 3000, "é😀\u0000\r\n\t  　 it's", "日本語 " * 50, " " * 500 + "a"])
def test_ids_equal_the_full_tokenizer(text):
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert P.token_ids(text, byte_vocabulary()).tolist() == [*full.encode(text, add_special_tokens=False).ids, 0]


def first_fit(sizes, capacity):
    """Plain best-fit decreasing, one item at a time."""
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            g = min(fit)
            gaps.remove(g)
            gaps.append(g - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


def test_plan_holds_every_piece_and_packs_well():
    rng = random.Random(4)
    for capacity, n in ((100, 400), (2048, 800), (7, 50)):
        for _ in range(8):
            sizes = [max(1, min(capacity, int(rng.paretovariate(0.9) * capacity / 12))) for _ in range(n)]
            counts = {s: sizes.count(s) for s in set(sizes)}
            bins = P.plan(counts, capacity)
            held = {}
            for content, times in bins:
                assert times > 0 and sum(content) <= capacity
                assert sum(3 * s > capacity for s in content) <= 2
                for s in content:
                    held[s] = held.get(s, 0) + times
            assert held == counts
            assert sum(t for _, t in bins) <= first_fit(sizes, capacity) * 1.02 + 1
            assert len(bins) <= 3 * len(counts) + 3  # does not grow with the number of pieces
    many = P.plan({s: 10**12 + s for s in range(1, 2049)})
    assert len(many) < 3 * 2048


def test_odd_rows(spark):
    docs = clashing(frame(spark, odd_rows()))
    packed = P.pack_documents(docs, byte_vocabulary(), with_ids=True)
    rows = packed.collect()
    whole_places(rows)
    assert sum(r.piece == 0 for r in rows) == len(odd_rows())
    assert {(r.length, r.ids) == (1, [0]) for r in rows if r.doc_id in (2, 3)} == {True}
    sequences = P.sequences(packed).collect()
    assert sorted(len(s.ids) for s in sequences) == sorted(
        packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).toPandas().n
    )
    for r in rows:
        s = next(s for s in sequences if s.sequence_id == r.sequence_id)
        assert s.ids[r.offset : r.offset + r.length] == r.ids
    assert P.pack_documents(docs.limit(0), byte_vocabulary()).count() == 0
