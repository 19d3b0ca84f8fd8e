import re
from collections import Counter

import numpy as np

from tests.conftest import SMALL
from tidemark.llm import quality_rules as Q

from .cases import clashing, frame, odd_rows


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) for k in range(3) if grams[tuple(words[i : i + 3])] > 1}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(inside) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside), failed


def test_base_counts_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = Q.score(docs, Q.references(docs)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:7] == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_odd_rows(spark):
    docs = clashing(frame(spark, odd_rows()))
    refs = Q.references(docs)
    got = Q.score(docs, refs).collect()
    assert len(got) == len(odd_rows())
    assert {r.kept for r in got if r.doc_id == 2} == {False}
    kept = Q.keep(docs, refs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    hist = Q.Histograms(Q.Rules())
    for text in ("\x1c\u00a0a\u2003b c", "a\x0bb\x0cc\u0085d", "\ud7ff é😀\r\n#$"):  # only ASCII blanks divide words
        assert Q.judge([text.encode()], refs, Q.Rules(), hist)[0][:6] == brute(text)


def test_empty_table_has_no_references(spark):
    docs = frame(spark, odd_rows()).limit(0)
    refs = Q.references(docs)
    assert refs.languages == [] and Q.score(docs, refs).count() == 0 and Q.keep(docs, refs).count() == 0


def test_distance():
    p = np.array([[1.0, 0.0], [0.5, 0.5]])
    assert np.allclose(Q.jensen_shannon(p, p).diagonal(), 0)
    assert np.isclose(Q.jensen_shannon(p[:1], np.array([[0.0, 1.0]]))[0, 0], 1)


def test_junk_is_told_from_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = Q.score(docs, Q.references(docs)).join(labels, "doc_id").where("not base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.99
    assert got[got.quality == 0].kept.mean() < 0.3


RUSSIAN = "в этом городе она жила много лет и каждый день ходила через старый мост на работу где было тихо".split()
FINNISH = "kaupunki oli hiljainen ja vanha silta johti yli joen missä hän käveli joka päivä töihin ennen kuin talvi tuli".split()


def test_rare_languages_are_not_judged_by_others(spark):
    rng = np.random.default_rng(1)

    def rows(words, n, lang, start):
        return [(start + i, " ".join(rng.choice(words, 150)), lang, "s", 1) for i in range(n)]

    english = "the cat of the house and the dog in the garden were not at all tired of it this time he said to them".split()
    many = rows(english, 4000, "en", 0)
    junk = "#$%& <<>> 0x1f || 99;; {} ~~ ^^ 77== @@ -- ++ 42% ##".split()
    rare = rows(RUSSIAN, 7, "ru", 5000) + rows(FINNISH, 7, "fi", 6000) + rows(RUSSIAN, 3, None, 7000) + rows(RUSSIAN, 5, "en", 7100)
    some = rows(RUSSIAN, 25, "uk", 8000)  # under 0.2% of a large table: enough for a reference of its own
    for more in ([], some):
        docs = frame(spark, many + rare + more + rows(junk, 10, "en", 9000) + rows(junk, 5, None, 9100) + rows(junk, 5, "uk", 9200))
        refs = Q.references(docs)
        assert list(zip(refs.languages, refs.scripts)) == [("en", "Latin")] + [("uk", "Cyrillic")] * bool(more)
        kept = {r.doc_id for r in Q.score(docs, refs).collect() if r.kept}
        assert {r[0] for r in rare + more} <= kept and not kept & {*range(9000, 9105)}
        assert {r.doc_id for r in Q.keep(docs, refs).collect()} == kept


def test_more_languages_than_texts_at_a_time(spark):
    words = [f"x{i}" for i in range(300)]
    rows = [(20 * k + i, " ".join(words[k : k + 5] * 3 + words[(k + i) % 240 : (k + i) % 240 + 60]), f"l{k:03}", "s", 1) for k in range(210) for i in range(20)]
    docs = frame(spark, rows)
    assert len(Q.references(docs).languages) == 210


def test_scripts():
    for text, name in (("é à the", "Latin"), ("12 % …", "Latin"), ("где the было", "Cyrillic"), ("日本のこと", "Han"), ("ไทย a", "Thai"), ("한국", "Hangul")):
        assert Q.script(text.encode()) == name
