import random

from tests.conftest import SMALL
from tidemark.llm import line_dedup as D

from .cases import CLASHING, DOCS, clashing, frame, odd_rows, prose


def brute(docs, need):
    """(doc_id, text) in order -> text without every run of at least ``need`` words that stands earlier."""
    held = [(i, t, [(k, " ".join(x.split())) for k, x in enumerate(t.split("\n")) if x.split()]) for i, t in docs]

    def runs(lines):
        for a in range(len(lines)):
            words = 0
            for b in range(a, len(lines)):
                words += len(lines[b][1].split())
                if words >= need:
                    yield a, b, tuple(x for _, x in lines[a : b + 1])

    first = {}
    for n, (_, _, lines) in enumerate(held):
        for a, _, key in runs(lines):
            first.setdefault(key, (n, a))
            first[key] = min(first[key], (n, a))
    out = {}
    for n, (i, text, lines) in enumerate(held):
        gone = set()
        for a, b, key in runs(lines):
            if first[key] < (n, a):
                gone.update(range(lines[a][0], lines[b][0] + 1))
        out[i] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
    return out


def test_generated_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r.text for r in D.dedup(docs).collect()}
    assert got == brute(sorted((r.doc_id, r.text) for r in docs.collect()), 50)


def test_shared_passages_against_brute_force(spark):
    rng = random.Random(2)
    for runs in (D.Runs(12, 6), D.Runs(9, 9), D.Runs(20, 4)):
        common = [" ".join(prose(rng, rng.choice([1, 2, 3, 5, 8, 15]), 30)) for _ in range(40)]
        rows = []
        for i in range(60):
            lines = []
            for _ in range(rng.randint(0, 6)):
                at = rng.randrange(len(common))
                if rng.random() < 0.6:
                    lines += common[at : at + rng.randint(1, 8)]
                else:
                    lines.append(" ".join(prose(rng, rng.randint(0, 10))))
            rows.append((i, "\n".join(lines), "en", "s", 1))
        got = {r.doc_id: r.text for r in D.dedup(frame(spark, rows), runs).collect()}
        assert got == brute([(r[0], r[1]) for r in rows], runs.run_words)


def test_odd_rows(spark):
    docs = clashing(frame(spark, odd_rows()))
    out = D.dedup(docs, report="gone")
    assert out.columns == [*docs.columns, "gone"]
    rows = out.collect()
    assert len(rows) == len(odd_rows())
    assert {r.text for r in rows if r.doc_id == 1} == {odd_rows()[0][1]}  # equal rows are one document
    assert [r.text for r in rows if r.doc_id is None and r.text is not None] == [""]  # nulls come last
    assert {r[c] for r in rows for c in CLASHING if c not in DOCS} == {"other"}
    assert D.dedup(docs.limit(0)).count() == 0


def test_blank_lines(spark):
    passage = "\n\n".join(" ".join(prose(random.Random(k), 30)) for k in range(2))
    rows = [(1, passage, "en", "s", 1), (2, f"new\n\n{passage}\n\nend", "en", "s", 1)]
    assert {r.doc_id: r.text for r in D.dedup(frame(spark, rows)).collect()} == {1: passage, 2: "new\n\n\nend"}
