import random
from math import comb

import numpy as np

from tests.conftest import SMALL
from tidemark.llm import ngram_join as J
from tidemark.llm.components import connected, roots

from .cases import clashing, frame, odd_rows, prose


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def brute(rows):
    """(doc_id, text) -> doc_id -> (class id, links)."""
    sets = [shingles(t) for _, t in rows]
    up, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    name = {}
    for k, (i, _) in enumerate(rows):
        name.setdefault(find(k), []).append(i)
    return {i: (min(name[find(k)]), links[k]) for k, (i, _) in enumerate(rows)}


def edited(rng, words, rate):
    return [f"e{rng.randrange(10**6)}" if rng.random() < rate else w for w in words]


def test_generated_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.id: (r.class_id, r.n_links) for r in J.group(docs).collect()}
    assert got == brute(sorted((r.doc_id, r.text) for r in docs.collect()))


def test_groups_cut_into_blocks(spark):
    rng = random.Random(3)
    rows = []
    for g in range(6):
        base = prose(rng, rng.choice([3, 40, 120, 200]), 10**6)
        for _ in range(25 if g else 60):
            rows.append((len(rows), " ".join(edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.04]))), "en", "s", 1))
    want = brute([(r[0], r[1]) for r in rows])
    for join in (J.Join(), J.Join(block_members=7), J.Join(block_shingles=300)):
        got = {r.id: (r.class_id, r.n_links) for r in J.group(frame(spark, rows), join).collect()}
        assert got == want
    kept = J.keep(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for c, _ in want.values()})


def test_odd_rows(spark):
    docs = clashing(frame(spark, odd_rows()))
    rows = J.group(docs).collect()
    assert len(rows) == len(odd_rows())
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append((r.class_id, r.n_links, r.first))
    assert by[1] == [(1, 2, True)] * 2  # each other and the row without an id
    assert by[2] == [(2, 0, True)] and by[3] == [(3, 0, True)] and by[4] == [(4, 0, True)]
    assert sorted(by[None], key=str) == [(1, 2, False), (None, 0, True)]
    kept = J.keep(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        {(i or 0, t or "") for i, t, *_ in odd_rows() if i is not None or t is None}
    )
    assert J.group(docs.limit(0)).count() == 0 and J.keep(docs.limit(0)).count() == 0


def test_pruning_rule():
    join = J.Join()
    for k, m in J.needed_matches(join):
        grid = np.linspace(0, 1, 200_001)
        for tried, keeps in ((m, True), (m - 1, False)):
            if tried < 0:
                continue
            like = comb(k, tried) * grid**tried * (1 - grid) ** (k - tried)
            posterior = like[grid >= 0.8].sum() / like.sum()
            assert (posterior >= join.tolerance) == keeps


def test_spans_are_hashed_alike_wherever_they_stand():
    a, b = J.shingles(b"x y a b c d e", 5), J.shingles(b"a  B c\td e\nf", 5)
    assert len(np.intersect1d(a, b)) == 1
    assert len(J.shingles(b"one two", 5)) == 1 and len(J.shingles(b" \n", 5)) == len(J.shingles(None, 5)) == 0


def test_components(spark):
    rng = random.Random(5)
    for n, m in ((30, 20), (60, 45), (50, 49)):
        edges = [(i, i + 1) for i in range(n - 1)] if m == 49 else [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        want = roots(n, np.array([a for a, _ in edges]), np.array([b for _, b in edges]))
        got = connected(spark.createDataFrame(edges, "a long, b long")).collect()
        touched = {x for a, b in edges for x in (a, b) if a != b}
        assert {r.node: r.component for r in got} == {x: want[x] for x in touched} and len(got) == len(touched)
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
