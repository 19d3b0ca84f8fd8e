import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LONG, clashing, frame, odd_rows, prose
from tidemark.llm import decontamination as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORDS.findall(low)


def brute(docs, items, n=10):
    """(doc_id, words, hit words, item ids) of every row, by looking at every place."""
    grams = []
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        grams += [(item, tuple(w[i : i + k])) for i in range(len(w) - k + 1) if k]
    out = []
    for doc, text in docs:
        w, hit, who = words(text), set(), set()
        for item, gram in grams:
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i : i + len(gram)]) == gram:
                    hit.update(range(i, i + len(gram)))
                    who.add(item)
        out.append((doc, len(w), len(hit), sorted(str(x) for x in who if x is not None)))
    return sorted(out, key=str)


def made(spark, docs, items, windows=D.Windows()):
    bench = spark.createDataFrame(items, ITEMS)
    found, members = D.find(docs, bench, windows)
    return sorted(((r.id, r.n_words, r.n_hit, r["items"]) for r in D.report(found, members).collect()), key=str), found


def planted(seed=5):
    rng = random.Random(seed)
    items = [(i, " ".join(prose(rng, rng.choice([12, 25, 40]), 50))) for i in range(12)]
    items += [(20, "Alpha; BETA gamma"), (21, "beta gamma"), (22, "Élan ÉLAN"), (23, ""), (24, None), (25, "... !"), (None, items[0][1])]
    items += [(3, items[4][1]), (26, items[5][1] + " and " + items[6][1])]
    docs = []
    for i in range(60):
        w = prose(rng, rng.choice([0, 5, 60, 200]), 50)
        for _ in range(rng.choice([0, 0, 1, 2])):
            source = words(rng.choice(items)[1])
            at, cut = rng.randrange(len(w) + 1), rng.randrange(0, 15)
            w[at:at] = source[: len(source) - cut] if cut < len(source) else source
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(x.upper() if rng.random() < 0.2 else x for x in w), "en", "a", 1))
    docs += [(100, "alpha beta-gamma", "en", "a", 1), (101, "élan Élan ÉLAN", "fr", "a", 1), (102, "alpha beta delta gamma", "en", "a", 1)]
    return docs, items


@pytest.mark.parametrize("windows", [D.Windows(), D.Windows(broadcast_bytes=0), D.Windows(words=3)])
def test_against_every_place(spark, windows):
    docs, items = planted()
    got, _ = made(spark, frame(spark, docs), items, windows)
    want = brute([d[:2] for d in docs], items, windows.words)
    assert got == want
    assert sum(w[2] > 0 for w in want) > 10


def test_odd_rows(spark):
    rows = odd_rows()
    items = [(1, "the dog in the garden were not at all tired"), (2, " ".join(LONG.split()[500:540])), (3, "y é"), (4, "12345 678")]
    docs = clashing(frame(spark, rows))
    got, found = made(spark, docs, items)
    assert got == brute([r[:2] for r in rows], items)
    empty, _ = made(spark, docs.limit(0), items)
    assert empty == []
    clean, _ = made(spark, docs, [(1, None), (2, "!")])
    assert len(clean) == len(rows) and all(n == 0 and not who for _, _, n, who in clean)
    left = D.remove(docs, found)
    assert left.columns == docs.columns and left.count() == len(rows)
    assert D.remove(docs, found, max_share=0.0).count() == sum(n == 0 for _, _, n, _ in got)


def test_hit_words_are_removed(spark):
    docs = frame(spark, [(1, '"One two, THREE four five."', "en", "a", 1), (2, "zwei drei", "de", "a", 1), (3, "Two three", "en", "a", 1)])
    found, _ = D.find(docs, spark.createDataFrame([(7, "two three"), (8, "three four")], ITEMS))
    assert {r.doc_id: r.text for r in D.remove(docs, found).collect()} == {1: '"One five."', 2: "zwei drei", 3: ""}
    assert {r.doc_id for r in D.remove(docs, found, max_share=0.7).collect()} == {1, 2}


def test_one_passage_in_most_documents_and_items(spark):
    """What is found of a document doesn't grow with its copies, and a class of windows meets its items once."""
    passage = " ".join(f"p{i}" for i in range(40))
    docs = frame(spark, [(i % 5, f"a{i % 3} {passage} b{i}", "en", "a", 1) for i in range(300)])
    items = [(i, f"{passage} tail{i}") for i in range(50)]
    got, found = made(spark, docs, items)
    assert len(got) == 300 and all(n == 40 and len(who) == 50 for _, _, n, who in got)
    assert found.select(F.max(F.size("classes"))).first()[0] == 1


def test_main_path_is_native(spark):
    docs, items = planted()
    found, members = D.find(frame(spark, docs), spark.createDataFrame(items, ITEMS))
    for df in (D.report(found, members), D.remove(frame(spark, docs), found)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
