"""Benchmark decontamination with a broadcast hash set of test n-grams, by DataFrame functions alone.

Texts are lower-cased (A to Z) and cut into words at every ASCII character but digits and letters. A benchmark item yields
its windows of ``words`` consecutive words; a shorter one is a single window. The distinct windows, each with its hash,
are the set; every window of every document is looked up by its hash and verified by its words. A word inside a window
that was found is *hit*; hit words can be removed, or documents that hold too many of them.

* One scan: each document yields its windows and one row for itself, so that counts need no second reading, and nothing
  but that row and what was found is shuffled.
* The set is broadcast when its measured size is within ``broadcast_bytes``. A larger one is joined by shuffling, on the
  hash, where adaptive execution can split a window that many documents hold.
* Windows of the same items are one class: a document meets the items of a class once, not once for each window.

Documents are told apart by id and text. Defined cases: null and empty texts have no words and no hits; rows that agree in
id and text are reported each, alike; null ids take part; an item without an id contaminates, but isn't counted or named
among the items; items that share an id are one; an empty benchmark hits nothing; very long texts are scanned whole,
window by window. Other columns are not read by ``find`` and pass through ``remove``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Characters of words before they are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


@dataclass(frozen=True)
class Windows:
    words: int = 10
    broadcast_bytes: int = 64 << 20


def words_of(text: Column) -> Column:
    """The lower-case words of a text; none of a null."""
    text = text.cast("string")
    plain = F.octet_length(text) == F.length(text)  # lower() is much faster, and the same where there is ASCII only
    small = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(small, f"{BREAKS}+"), ""), F.array().cast("array<string>"))


def _window(words: str = "words") -> Column:
    # a row that is no window has i = 0, and slice() counts from 1
    return F.slice(words, F.greatest(F.col("i"), F.lit(1)), F.col("k"))


def benchmark_windows(benchmark: DataFrame, windows: Windows, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item``, ``k`` (words), ``gram`` (the words, one blank between them) and ``h`` (their hash): each window of each item."""
    rows = benchmark.select(F.col(item).alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    rows = rows.select("item", "words", F.least(F.size("words"), F.lit(windows.words)).alias("k"))
    rows = rows.select("item", "words", "k", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("k") + 1)).alias("i"))
    return rows.select("item", "k", F.array_join(_window(), " ").alias("gram"), F.xxhash64(_window()).alias("h")).distinct()


def gram_classes(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct windows with the class of their items (two hashes), and the items of each class."""
    known = F.when(F.col("item").isNotNull(), F.col("item"))
    grams = pairs.groupBy("k", "gram", "h").agg(
        F.bit_xor(F.when(known.isNotNull(), F.xxhash64(F.lit(1), known))).alias("c1"),
        F.bit_xor(F.when(known.isNotNull(), F.xxhash64(F.lit(2), known))).alias("c2"),
    )
    grams = written(grams, "grams")
    first = grams.where("c1 IS NOT NULL").groupBy("c1", "c2").agg(F.min(F.struct("gram", "k")).alias("first"))
    first = first.select("c1", "c2", "first.gram", "first.k")
    members = pairs.where("item IS NOT NULL").join(first, ["gram", "k"]).select("c1", "c2", "item").distinct()
    return grams, written(members, "classes")


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    windows: Windows = Windows(),
    id_col: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """One row per document (id and text): ``id``, ``version`` (hash of the text), ``copies`` (rows alike), ``n_words``,
    ``n_hit``, ``spans`` (first and last word, from 1, of what was found) and ``classes``; and the items of each class."""
    pairs = written(benchmark_windows(benchmark, windows, item, item_text), "items")
    grams, members = gram_classes(pairs)
    about = grams.groupBy("k").agg(F.sum(F.octet_length("gram") + 64).alias("size")).collect()  # a row for each length
    lengths = [r["k"] for r in about]
    found = grams.select(F.col("k").alias("gram_k"), "gram", "h", "c1", "c2")
    if sum(r["size"] for r in about) <= windows.broadcast_bytes:
        found = F.broadcast(found)

    # every document: a row for itself (k = 0), then a row for each window
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), words_of(F.col(text)).alias("words"))
    rows = rows.select("id", "version", "words", F.size("words").alias("n_words"))
    rows = rows.select("*", F.explode(F.array(*(F.lit(k) for k in [0, *lengths]))).alias("k"))
    last = F.col("n_words") - F.col("k") + 1
    starts = F.when(F.col("k") == 0, F.array(F.lit(0))).when(last > 0, F.sequence(F.lit(1), last))
    rows = rows.select("*", F.explode(starts).alias("i"))
    is_window = F.col("k") > 0
    rows = rows.withColumn("key", F.when(is_window, F.xxhash64(_window())).otherwise(F.col("version")))
    same = (F.col("key") == F.col("h")) & (F.col("k") == F.col("gram_k")) & (F.array_join(_window(), " ") == F.col("gram"))
    rows = rows.join(found, same, "left").where(~is_window | F.col("h").isNotNull())

    span = F.struct(F.col("i").alias("first"), (F.col("i") + F.col("k") - 1).alias("last"))
    whole = rows.groupBy("id", "version").agg(
        F.sum(F.when(is_window, 0).otherwise(1)).alias("copies"),
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(is_window, span))).alias("found"),
        F.collect_set(F.when(F.col("c1").isNotNull(), F.struct("c1", "c2"))).alias("classes"),
    )
    whole = whole.select("id", "version", "copies", "n_words", _joined(F.col("found")).alias("spans"), "classes")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    whole = whole.select("id", "version", "copies", "n_words", hit.alias("n_hit"), "spans", "classes")
    return written(whole, "leaks"), members


def _joined(spans: Column) -> Column:
    """Sorted spans as the disjoint ones that they cover, in order: a span that begins within what came before only adds what
    lies beyond it."""
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        begins = F.greatest(s["first"], acc["end"] + 1)
        part = F.array(F.struct(begins.alias("first"), s["last"].alias("last")))
        more = F.when(s["last"] > acc["end"], F.concat(acc["out"], part)).otherwise(acc["out"])
        return F.struct(F.greatest(acc["end"], s["last"]).alias("end"), more.alias("out"))

    return F.aggregate(spans, start, step, lambda acc: acc["out"])


def report(found: DataFrame, members: DataFrame) -> DataFrame:
    """``id``, ``n_words``, ``n_hit``, ``items`` (ids as text, in their order) and ``contaminated`` of every document row."""
    hits = found.where(F.size("classes") > 0).select("id", "version", F.explode("classes").alias("c"))
    hits = hits.select("id", "version", "c.*").join(members, ["c1", "c2"])
    items = hits.groupBy(F.col("id").alias("hit_id"), F.col("version").alias("hit_version")).agg(
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")
    )
    both = found.join(items, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("version") == F.col("hit_version")), "left")
    both = both.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    none = F.array().cast("array<string>")
    return both.select(
        "id", "n_words", "n_hit", F.coalesce("items", none).alias("items"), (F.col("n_hit") > 0).alias("contaminated")
    )


def remove(
    docs: DataFrame, found: DataFrame, max_share: float = 1.0, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of ``docs``, hit words deleted from the text, each with what stands between it and the next word.
    Documents of which more than ``max_share`` of the words is hit are dropped; 0 drops every contaminated one."""
    spans = found.where("n_hit > 0").select(
        F.col("id").alias("hit_id"), F.col("version").alias("hit_version"), "spans", (F.col("n_hit") / F.col("n_words")).alias("share")
    )
    body = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("version"),
    )
    both = body.join(spans, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("version") == F.col("hit_version")), "left")
    both = both.where(F.col("share").isNull() | (F.col("share") <= max_share))
    value = F.col("row").getField(text)
    words = F.regexp_extract_all(value, F.lit(f"{WORD}+(?:(?!{WORD})[\\x00-\\x7F])*"), F.lit(0))
    stay = F.filter(words, lambda w, i: ~F.exists("spans", lambda s: (i + 1 >= s["first"]) & (i + 1 <= s["last"])))
    left = F.concat(F.regexp_extract(value, f"^(?:(?!{WORD})[\\x00-\\x7F])*", 0), F.array_join(stay, ""))
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns]
    columns[docs.columns.index(text)] = F.when(F.col("spans").isNull(), value).otherwise(left).alias(text)
    return both.select(*columns)
