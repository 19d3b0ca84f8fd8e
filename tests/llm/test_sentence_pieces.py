import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tests.conftest import SMALL
from tidemark.llm import sentence_pieces as S
from tidemark.llm.queries import QUERIES, piece_model

from .cases import LONG, clashing, frame, odd_rows


@pytest.fixture(scope="module")
def v():
    return S.vocabulary(piece_model())


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The model as a unigram model whose scores the library's 32-bit sums hold exactly, and its path."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(piece_model(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        p.score = max(p.score, -40_000.0) if p.type == 1 else p.score
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path), sentencepiece.SentencePieceProcessor(model_file=str(path))


def ids(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


def text(rng, letters="ab the éx日 \n.", n=200):
    return "".join(rng.choice(letters) for _ in range(rng.randint(1, n)))


def best_sum(v, t):
    """The greatest sum of scores, over all segmentations."""
    best = [0.0] + [-1e18] * len(t)
    for e in range(1, len(t) + 1):
        for s in range(max(0, e - v.longest), e):
            i = v.ids.get(t[s:e])
            gain = v.score[i] if i is not None else v.unknown_score if e - s == 1 else -1e18
            best[e] = max(best[e], best[s] + gain)
    return best[-1]


def path_sum(v, t, found):
    """The sum of a result, which must spell the text."""
    back, total, at, k = {b: i for i, b in v.bytes.items()}, 0.0, 0, 0
    back = {i: b for b, i in v.bytes.items()}
    while k < len(found):
        if found[k] in back:
            n = len(t[at].encode())
            assert [back[x] for x in found[k : k + n]] == list(t[at].encode())
            total, at, k = total + v.unknown_score, at + 1, k + n
        else:
            piece = v.pieces[found[k]]
            assert t.startswith(piece, at)
            total, at, k = total + v.score[found[k]], at + len(piece), k + 1
    assert at == len(t)
    return total


def test_ids_equal_the_library(unigram, spark):
    path, library = unigram
    encoder = S.Encoder(S.vocabulary(path))
    rng = random.Random(1)
    texts = [text(rng) for _ in range(200)] + ["a  b   c", "  x", "日本語", "", "it's\ttab"]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if len(r.text) < 1500]
    for t, got in zip(texts, encoder.encode([S.normalised(t) for t in texts])):
        assert ids(got) == library.encode(t)
        assert S.decode(encoder.v, np.frombuffer(got, dtype="<u4")) == library.decode(ids(got)) == t


def test_sums_are_the_greatest(v):
    rng = random.Random(2)
    encoder = S.Encoder(v)
    for _ in range(60):
        t = S.normalised(text(rng))
        whole = ids(encoder.encode([t])[0])
        assert abs(path_sum(v, t, whole) - best_sum(v, t)) < 1e-6


def test_chunks_cut_anywhere(v):
    rng = random.Random(3)
    encoder = S.Encoder(v)
    for letters in ("ab the é日x ", "abtheinr"):
        for _ in range(15):
            t = S.normalised(text(rng, letters, 300))
            want = best_sum(v, t)
            for chunk in (5, 16, 40):
                assert abs(path_sum(v, t, ids(S.encode_long(v, t, chunk))) - want) < 1e-6
                bounds = [*range(0, len(t), chunk), len(t)]
                cut = [(t[a : b + v.longest - 1], b - a) for a, b in zip(bounds, bounds[1:])]
                made = [S._ends(v, x, n, k == 0) for k, (x, n) in enumerate(cut)]
                states = S.boundary_states(made) if len(cut) > 1 else [0, 0]
                parts = S.traced(encoder, [x for x, _ in cut], [n for _, n in cut], states[:-1], states[1:])
                assert abs(path_sum(v, t, ids(b"".join(parts))) - want) < 1e-6


def test_products_are_associative():
    a, b, c = (np.random.default_rng(k).integers(-50, 50, (16, 16)).astype(float) for k in range(3))
    assert (S.compose(S.compose(a, b), c) == S.compose(a, S.compose(b, c))).all()


def test_bounds_move_to_blanks(v):
    t = S.normalised("word " * 100 + "x" * 90 + " end")
    bounds = S.chunk_bounds(v, t, 33)
    assert bounds[0] == 0 and bounds[-1] == len(t) and sorted(set(bounds)) == bounds
    assert sum(t[b] != S.BLANK for b in bounds[1:-1]) <= 2


def test_tables(spark, v):
    docs = clashing(frame(spark, odd_rows() + [(9, LONG, "en", "s", 1), (9, LONG, "en", "s", 1), (9, "y" * 5000, "en", "s", 1)]))
    want = sorted((i or 0, t or "") for i, t, *_ in [(r["doc_id"], r["text"]) for r in docs.collect()])
    encoder = S.Encoder(v)
    for chunk in (S.CHUNK, 1000):
        rows = S.encode(docs, piece_model(), chunk=chunk).collect()
        got = sorted((r.doc_id or 0, S.decode(v, np.frombuffer(r.ids, dtype="<u4"))) for r in rows)
        assert got == sorted((i, t.replace(S.BLANK, " ")) for i, t in want)
        for r in rows:
            if r.doc_id in (1, 5):
                t = next(t for i, t in want if i == r.doc_id)
                assert bytes(r.ids) == encoder.encode([S.normalised(t)])[0]
    assert S.encode(docs.limit(0), piece_model()).count() == 0


def test_query_round_trip(spark):
    import zlib

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op3_sentence_pieces"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_chars, r.text_crc32) == (len(docs[r.doc_id]), zlib.crc32(docs[r.doc_id].encode()))
