import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.cases import LONG, clashing, frame, odd_rows
from tidemark.llm import token_alignment as T
from tidemark.llm.queries import QUERIES, byte_vocabulary, piece_model

FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def brute(texts):
    """What each text yields, by the named tokenizers over whole texts and by sets of offsets."""
    a_tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    spelled = {int(i): base64.b64decode(t) for t, i in map(bytes.split, open(byte_vocabulary(), "rb"))}

    def b_bytes(i):
        piece = b_tool.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") else piece.replace("▁", " ").encode()

    docs = []
    for text in texts:
        groups = []
        if text:
            whole = (" " + text).encode()
            a, b = a_tool.encode(" " + text, add_special_tokens=False).ids, b_tool.encode(text)
            x, y = [spelled[i] for i in a], [b_bytes(i) for i in b]
            if b"".join(x) == whole == b"".join(y):
                end_a, end_b = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
                at, cuts = (0, 0), set(end_a) & set(end_b)
                for cut in sorted(cuts):
                    to = (end_a.index(cut, at[0]) + 1, end_b.index(cut, at[1]) + 1)
                    groups.append((a[at[0] : to[0]], b[at[1] : to[1]]))
                    at = to
        docs.append(groups)
    links = [Counter((p, q) for g, h in groups for p in g for q in h) for groups in docs]
    held = Counter(pair for own in links for pair in own)
    top = Counter()
    for (p, _), n in held.items():
        top[p] = max(top[p], n)
    out = []
    for groups, own in zip(docs, links):
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        best = sum(n for pair, n in own.items() if held[pair] == top[pair[0]])
        sizes = [sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), sum(own.values())]
        out.append((*sizes, best, sum(n * held[pair] for pair, n in own.items()), text))
    return out


SMALLEST = T.Alignment(lane_tokens=3, segment_tokens=20, block_docs=1, block_links=50, remembered=20, plain_group=2)


def held_against_brute(spark, rows, settings=T.Alignment(), parts=3):
    docs = frame(spark, rows, parts)
    got, _ = T.align(docs, byte_vocabulary(), piece_model(), settings, with_groups=True)
    got = sorted(((r.id, *(r[f] for f in FIELDS)) for r in got.collect()), key=str)
    want = sorted(((r[0], *w) for r, w in zip(rows, brute([r[1] for r in rows]))), key=str)
    assert got == want
    return want


def tangled(seed=2):
    """Texts of odd blanks, signs, scripts and runs, and long ones without a blank."""
    rng = random.Random(seed)
    bits = [" ", "  ", "\n", "\n ", "\t", "\r\n", " ", "　", "▁", "\x1c", "\x00", "'s", "don't", "don't ", "é", "é", "ñ"]
    bits += ["the", " the", " house", "ing", "Straße", "漢字", "かな", "สวัสดี", "😀", "👩‍👩‍👧", "12", "3456", " 78", "...", "!!", "<s>", "</s>"]
    bits += ["<|endoftext|>", "ab" * 40, "=" * 30, " " * 9, "łódź", "приве́т", "مرحبا"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.choice([1, 3, 10, 60]))), "en", "a", 1) for i in range(150)]
    rows = [(i, t if rng.random() < 0.3 else t.replace("▁", "_"), *rest) for i, t, *rest in rows]
    rows.append((500, "".join(rng.choice("abcdefghijklmnop漢字é") for _ in range(6000)), "en", "a", 1))
    rows.append((501, "-=" * 9000 + "x", "en", "a", 1))
    return rows


@pytest.mark.parametrize("settings", [T.Alignment(), SMALLEST, T.Alignment(lane_tokens=16, plain_group=1)])
def test_against_offset_sets(spark, settings):
    want = held_against_brute(spark, tangled(), settings)
    assert sum(w[1] > 0 for w in want) > 100 and sum(w[1] == 0 for w in want) >= 10
    assert any(w[4] > w[1] + w[2] for w in want)  # groups of many tokens


@pytest.mark.parametrize("settings", [T.Alignment(), SMALLEST])
def test_odd_rows(spark, settings):
    held_against_brute(spark, odd_rows(), settings)


def test_extra_columns_and_empty_table(spark):
    docs = clashing(frame(spark, odd_rows()))
    rows, pairs = T.align(docs, byte_vocabulary(), piece_model())
    assert rows.count() == docs.count() and pairs.where("best").count() > 0
    rows, pairs = T.align(docs.limit(0), byte_vocabulary(), piece_model())
    assert rows.count() == 0 and pairs.count() == 0
    broken = docs.limit(1).withColumn("text", F.expr("cast(X'41FF42' AS string)"))
    rows, _ = T.align(broken, byte_vocabulary(), piece_model())
    assert [tuple(r)[1:] for r in rows.collect()] == [(0, 0, 0, 0, "", 0, 0)]


def test_query_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = brute([r.text for r in docs])
    got = {r.doc_id: r for r in QUERIES["op12_token_alignment"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for doc, w in zip(docs, want):
        r = got[doc.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == w[:6]
        assert r.groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")


def test_lanes_move_together():
    """Steps are as many as the longest lane needs, not the sum of all."""
    rng = np.random.default_rng(0)
    ends_a = [np.unique(np.append(rng.integers(1, 1000, 200), 1000)) for _ in range(50)]
    ends_b = [np.unique(np.append(rng.integers(1, 1000, 150), 1000)) for _ in range(50)]
    a, b = np.cumsum([0, *map(len, ends_a)]), np.cumsum([0, *map(len, ends_b)])
    whole_a = np.concatenate([e + 1000 * i for i, e in enumerate(ends_a)])
    whole_b = np.concatenate([e + 1000 * i for i, e in enumerate(ends_b)])
    last_a, last_b = T.lockstep(whole_a, whole_b, a[:-1], b[:-1], a[1:])
    assert (whole_a[last_a] == whole_b[last_b]).all()
    assert whole_a[last_a].tolist() == sorted(set(whole_a.tolist()) & set(whole_b.tolist()))
