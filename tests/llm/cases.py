"""Odd rows that every operator must take, and small helpers."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
CLASHING = "id version cls check score kept text_ row length rank src nth held_out ids chunk matrix found n_words head".split()


def odd_rows() -> list[tuple]:
    """Null ids, null, empty and blank texts, a very long text, repeated rows, one id with two texts."""
    base = "the cat of the house and the dog in the garden were not at all tired of it " * 8
    return [
        (1, base, "en", "a", 5),
        (1, base, "en", "a", 5),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, " \t\n ", "en", "a", 4),
        (None, base, "en", "a", 5),
        (None, None, None, None, None),
        (5, LONG, "en", "a", len(LONG)),
        (6, "le chat de la maison et le chien du jardin ne sont pas du tout las de la vie " * 8, "fr", "b", 7),
        (6, "zwei", "de", "b", 7),
        (7, "😀 ▁x \u0000y é\r\n\x0bz <s> [INST]", "xx", "b", 7),
        (8, "12345 678", "en", "b", 7),
    ]


def clashing(df):
    """The frame with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("other") for c in CLASHING if c not in df.columns})


def frame(spark, rows, parts: int = 3):
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def prose(rng: random.Random, words: int, vocabulary: int = 2000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
