"""The corpus pipeline: documents are filtered, deduplicated and packed, one operator per stage.

Every stage takes the documents that the one before has kept, with all their columns, and its decisions take effect. An
empty table, null texts and null ids, repeated rows and further columns pass as each operator's docstring says; a
document without text goes in the first stage, which asks for a number of words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, line_dedup, ngram_join, packing, quality_rules
from tidemark.llm.common import written
from tidemark.llm.queries import byte_vocabulary

#: A document goes when its language is unknown or less sure than this.
MIN_LANGUAGE_SCORE = 0.55
#: No stage can be said in SQL as a whole; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs, quality_rules.references(docs))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known well enough."""
    return language_id.keep(docs, language_id.fit_model(docs), MIN_LANGUAGE_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are deleted; a document goes when nothing of it is left."""
    left = line_dedup.dedup(docs, report="__gone")
    left = left.where((F.col("__gone") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).drop("__gone")
    if "n_chars" in left.columns:
        kind = left.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.length("text").cast(kind))
    return left


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return ngram_join.keep(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document as pieces with their places in sequences."""
    packed = packing.pack_documents(docs, byte_vocabulary())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality),
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
