import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tests.conftest import SMALL
from tidemark.llm import language_id, line_dedup, packing, quality_rules
from tidemark.llm.queries import QUERIES, byte_vocabulary

from .cases import clashing, frame, odd_rows
from .test_line_dedup import brute as without_runs
from .test_ngram_join import brute as near_classes
from .test_packing import whole_places


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    refs = quality_rules.references(docs)
    verdicts = quality_rules.judge(
        [r.text.encode() for r in rows.values()], refs, quality_rules.Rules(), quality_rules.Histograms(quality_rules.Rules())
    )
    want = {i for i, v in zip(rows, verdicts) if v[-1]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns, name
        got = {r.doc_id: r for r in docs.collect()}
        if name == "language_id":
            model = language_id.fit_model(before)
            langs, scores = language_id.predict(model, [rows[i].text.encode() for i in sorted(want)])
            want = {i for i, v, s in zip(sorted(want), langs, scores) if v != "und" and s >= corpus_pipeline.MIN_LANGUAGE_SCORE}
        elif name == "line_dedup":
            texts = without_runs(sorted((i, rows[i].text) for i in want), line_dedup.Runs().run_words)
            want = {i for i in want if texts[i].split() or texts[i] == rows[i].text}
            assert {i: r.text for i, r in got.items()} == {i: texts[i] for i in want}
            assert all(r.n_chars == len(r.text) for r in got.values())
        elif name == "ngram_join":
            classes = near_classes(sorted((i, texts[i]) for i in want))
            want = {c for c, _ in classes.values()}
        assert set(got) == want, name
        before = docs
    packed = corpus_pipeline.pack(spark, docs, SMALL).collect()
    whole_places(packed)
    for i in want:
        own = sum(r.length for r in packed if r.doc_id == i)
        assert own == len(packing.token_ids(got[i].text, byte_vocabulary()))
    assert {r.doc_id for r in packed} == want


def test_odd_and_empty_tables(spark, tmp_path):
    for n, rows in enumerate((odd_rows(), [])):
        folder = str(tmp_path / str(n))
        prose = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60 if rows else 0)
        clashing(frame(spark, odd_rows()).limit(len(rows)).unionByName(prose)).write.parquet(f"{folder}/documents.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert out if rows else out == []


def test_entries(spark):
    found = entry_points.queries()
    assert set(QUERIES) <= set(found) and "pipeline" in found
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert found["pipeline"](spark, SMALL).select(F.count(F.lit(1))).first()[0] > 0
