import zlib

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import language_id as L
from tidemark.llm.common import crc_mod
from tidemark.llm.queries import QUERIES

from .cases import clashing, frame, odd_rows


def test_held_out_accuracy(spark):
    got = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(got) == len(docs)
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    assert (both[both.held_out].lang_pred == both[both.held_out].lang).mean() > 0.97
    assert both.score.between(0, 1).all()


def test_odd_rows(spark):
    docs = clashing(frame(spark, odd_rows()))
    model = L.fit_model(docs)
    got = L.identify(docs, model).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        if r.doc_id in (2, 3, 4, 8):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred != "und"
    kept = L.keep(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == sum(r.lang_pred != "und" for r in got)


def test_nothing_and_one_language_to_learn(spark):
    docs = frame(spark, odd_rows())
    nothing = L.fit_model(docs, learn=F.lit(False))
    assert {r.lang_pred for r in L.identify(docs, nothing).collect()} == {"und"}
    one = L.fit_model(docs.where("lang = 'en'"))
    assert {r.lang_pred for r in L.identify(docs, one).collect()} == {"en", "und"}
    assert L.identify(docs.limit(0), one).count() == 0


def test_three_languages_of_one_family_vote(spark):
    words = {"fr": "le chat dans la maison", "es": "el gato en la casa", "it": "il gatto nella casa di"}
    rows = [(i, f"{words[v]} {i}", v, "s", 1) for i, v in enumerate(list(words) * 20)]
    model = L.fit_model(frame(spark, rows))
    assert model.families == ["romance"] and len(model.pairs[0][0]) == 3
    langs, scores = L.predict(model, [t.encode() for t in words.values()])
    assert langs == list(words) and min(scores) > 0.5


def test_held_out_rows_and_columns_are_not_learned(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    learn = crc_mod("doc_id", 4) != 2
    spoiled = docs.withColumn("lang", F.when(learn, F.col("lang")).otherwise("zz")).withColumn("source", F.lit("q"))
    a = L.identify(docs, L.fit_model(docs, learn=learn)).collect()
    b = L.identify(docs, L.fit_model(spoiled, learn=learn)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_every_language_is_learned(spark):
    """400 languages, one of them with a third of the rows and most of those alike; each is told from all others."""
    import random

    rng = random.Random(4)
    syllables = [[rng.choice("bcdfghjklmnprstvz") + rng.choice("aeiouy") for _ in range(3)] for _ in range(400)]
    text = lambda v: " ".join("".join(rng.choice(syllables[v]) for _ in range(4)) for _ in range(30))
    rows = [(10_000 * v + i, text(v), f"l{v:03}", "s", 1) for v in range(400) for i in range(5)]
    rows += [(5_000_000, rows[0][1], "l000", "s", 1)] * 800 + [(6_000_000 + i, text(0), "l000", "s", 1) for i in range(400)]
    docs = frame(spark, rows)
    model = L.fit_model(docs)
    assert sum(map(len, model.members)) == 400
    langs, _ = L.predict(model, [text(v).encode() for v in range(400)])
    assert sum(lang == f"l{v:03}" for v, lang in enumerate(langs)) > 380


def test_against_plain_prediction_of_every_document(spark):
    """The query's predictions are those of one model, text by text, without Spark."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = L.fit_model(docs, learn=crc_mod("doc_id", 4) != 2)
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op10_language_id"](spark, SMALL).collect()}
    for r in docs.select("doc_id", "text").collect():
        raw = None if r.text is None else r.text.encode()
        lang, score = L.predict(model, [raw])
        assert got[r.doc_id][0] == lang[0] and abs(got[r.doc_id][1] - score[0]) < 1e-5
