"""Quality rules by distribution divergence.

A document's histogram of character classes and its histogram of common words are compared, by Jensen-Shannon distance
(base 2, 0 to 1), with the average histograms of each language of the corpus, one for each script that it is written in. A document far from
every one is rejected. Only a document whose own language and script have an average is judged so (without a language:
whose script has one); of the others nothing is known, and the base rules decide alone. Texts too short for a histogram to mean anything are not judged by it (the guards in ``Rules``); rules on
length and on repetition come first.

Defined cases: a null text counts as empty and fails the length rule; a null id is carried through; repeated rows get
equal verdicts; rows without a language are judged but add nothing to the references; without any reference (an empty
table, no languages) only the base rules speak; a text of any length is counted whole. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, map_slices, texts

#: Frequent words of the default languages; any further language is still compared by these and by "other".
COMMON_WORDS = (
    "the of and to in is that it for as was with be by on not he his at are this or from an which you had "
    "le la les de des du et est un une que qui dans pour par pas sur au avec ce il ne se plus son "
    "der die das und ist nicht ein eine den dem mit von zu im auf für sich auch als "
    "el los las y que en del por con una su para al lo como más pero sus"
)
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
PAIRS = 1 << 16  # texts and languages whose distances are worked out at once
UNIT = 1 << 20  # shares are summed as whole numbers, so that sums do not depend on their order


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_share: float = 0.5
    #: Guards: the histograms of shorter texts are not judged.
    min_chars_for_classes: int = 200
    min_words_for_words: int = 50
    max_class_distance: float = 0.30
    max_word_distance: float = 0.55
    #: Both distances together; short texts stray further from any average, by about 1 / sqrt(words).
    max_distance_sum: float = 0.42
    short_text_allowance: float = 0.6
    #: Every language (in one script) with so many judged documents gives a reference.
    min_language_docs: int = 10
    common_words: str = COMMON_WORDS


@dataclass
class References:
    languages: list[str]
    scripts: list[str]
    classes: np.ndarray
    words: np.ndarray


def _class_table() -> np.ndarray:
    """Class of each UTF-8 byte; the bytes inside a character belong to none (the last class)."""
    table = np.full(256, 10, dtype=np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 0xC0:
            table[b] = 7 if b < 0xE0 else 8 if b < 0xF0 else 9
        elif b >= 0x80:
            table[b] = 11
        elif c.islower():
            table[b] = 0
        elif c.isupper():
            table[b] = 1
        elif c.isdigit():
            table[b] = 2
        elif c == " ":
            table[b] = 3
        elif c in "\t\n\r\x0b\x0c":
            table[b] = 4
        elif c in ".,;:!?'\"()-":
            table[b] = 5
        elif b >= 0x20:
            table[b] = 6
    return table


CLASS_OF = _class_table()
CLASSES = 11

#: Where the letters of a script begin, "" where letters of none do; what is not told apart counts by blocks of 256.
SCRIPT_STARTS = (
    (0x0, ""), (0x40, "Latin"), (0x80, ""), (0xC0, "Latin"), (0x2B0, ""), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"),
    (0x590, "Hebrew"), (0x600, "Arabic"), (0x700, "Syriac"), (0x750, "Arabic"), (0x780, "Thaana"), (0x7C0, "Nko"), (0x800, "Hebrew"),
    (0x860, "Syriac"), (0x8A0, "Arabic"), (0x900, "Devanagari"), (0x980, "Bengali"), (0xA00, "Gurmukhi"), (0xA80, "Gujarati"),
    (0xB00, "Oriya"), (0xB80, "Tamil"), (0xC00, "Telugu"), (0xC80, "Kannada"), (0xD00, "Malayalam"), (0xD80, "Sinhala"),
    (0xE00, "Thai"), (0xE80, "Lao"), (0xF00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Ethiopic"), (0x13A0, "Cherokee"), (0x1400, "Syllabics"), (0x1680, "*"), (0x1780, "Khmer"), (0x1800, "Mongolian"),
    (0x18B0, "Syllabics"), (0x1900, "*"), (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1CC0, "*"), (0x1D00, "Latin"),
    (0x1F00, "Greek"), (0x2000, ""), (0x2C00, "*"), (0x2C60, "Latin"), (0x2C80, "*"), (0x2DE0, "Cyrillic"), (0x2E00, ""), (0x3040, "Han"),
    (0x3130, "Hangul"), (0x3190, "Han"), (0xA000, "*"), (0xA640, "Cyrillic"), (0xA6A0, "*"), (0xA720, "Latin"), (0xA800, "*"),
    (0xA8E0, "Devanagari"), (0xA900, "*"), (0xAB00, "Ethiopic"), (0xAB30, "Latin"), (0xAB70, "Cherokee"), (0xABC0, "*"),
    (0xAC00, "Hangul"), (0xD800, ""), (0xF900, "Han"), (0xFB00, ""), (0xFB50, "Arabic"), (0xFE00, ""), (0xFE70, "Arabic"), (0xFF00, ""),
    (0x10000, "*"), (0x1D000, ""), (0x1E000, "*"), (0x1F000, ""), (0x20000, "Han"), (0x32000, ""),
)


def _script_table() -> tuple[list[str], np.ndarray]:
    """Names of scripts, and the script of each 16 code points."""
    starts = [at for at, _ in SCRIPT_STARTS]
    of = np.searchsorted(starts, np.arange(0, 0x110000, 16), side="right") - 1
    named = [SCRIPT_STARTS[k][1] if SCRIPT_STARTS[k][1] != "*" else f"U+{at >> 4:02X}00" for at, k in enumerate(of)]
    names = ["", "Latin", *sorted(set(named) - {"", "Latin"})]
    number = {name: k for k, name in enumerate(names)}
    return names, np.array([number[x] for x in named], dtype=np.int64)


SCRIPTS, SCRIPT_OF = _script_table()
#: First bytes of all characters that letters of other scripts than Latin can have.
OTHER_SCRIPTS = bytes([*range(0xCD, 0xE2), *range(0xE3, 0xF5)])


def script(raw: bytes) -> str:
    """The script of most letters; Latin if no other has more."""
    if len(raw.translate(None, OTHER_SCRIPTS)) == len(raw):
        return "Latin"
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4")
    n = np.bincount(SCRIPT_OF[points >> 4], minlength=len(SCRIPTS))
    return SCRIPTS[1 + int(n[1:].argmax())]


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text, first occurrences included."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    again = np.fromiter((counts[g] > 1 for g in grams), dtype=bool, count=len(grams))
    covered = np.zeros(len(words), dtype=bool)
    for at in range(3):
        covered[at : at + len(grams)] |= again
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


class Histograms:
    """Class and common-word counts of texts."""

    def __init__(self, rules: Rules):
        listed = list(dict.fromkeys(rules.common_words.split()))
        self.index = {w.encode(): i for i, w in enumerate(listed)}
        self.size = len(listed) + 1

    def classes(self, raw: bytes) -> np.ndarray:
        return np.bincount(CLASS_OF[np.frombuffer(raw, dtype=np.uint8)], minlength=CLASSES + 1)[:CLASSES]

    def words(self, raw: bytes) -> np.ndarray:
        low = raw.lower().split()
        found = np.fromiter(map(self.index.get, low, repeat(self.size - 1)), dtype=np.int64, count=len(low))
        return np.bincount(found, minlength=self.size)


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1)


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of each row of ``p`` from each row of ``q``."""
    p, q = p[:, None, :], q[None, :, :]
    m = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0.0).sum(axis=-1)

    return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


def _base_failed(rules: Rules, n_words: int, n_repeat: int) -> bool:
    return n_words < rules.min_words or n_repeat > rules.max_repeat_share * n_words


def references(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> References:
    """Average histograms of each language and script over all its documents that are long enough to be judged."""
    hist = Histograms(rules)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        sums: dict[tuple[str, str], np.ndarray] = {}
        for raw, name in zip(texts(batch, "text"), batch.column(1).to_pylist()):
            if not raw or len(raw) < rules.min_chars_for_classes:
                continue
            by_word = hist.words(raw)
            if by_word.sum() < max(rules.min_words, rules.min_words_for_words):
                continue
            row = np.concatenate([[1], _shares(hist.classes(raw)) * UNIT, _shares(by_word) * UNIT]).round()
            key = name, script(raw)
            sums[key] = sums.get(key, 0) + row.astype(np.int64)
        if not sums:
            return None
        arrays = [*(pa.array(x) for x in zip(*sums)), pa.array([x.tolist() for x in sums.values()], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "script", "sums"])

    known = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    parts = map_slices(known, step, "lang string, script string, sums array<bigint>")
    width = 1 + CLASSES + hist.size
    totals = parts.groupBy("lang", "script").agg(*(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)))
    rows = sorted(totals.where(F.col("s0") >= rules.min_language_docs).collect(), key=lambda r: (r.lang, r.script))
    sums = np.array([[r[f"s{i}"] for i in range(1, width)] for r in rows], dtype=float).reshape(len(rows), width - 1)
    return References([r.lang for r in rows], [r.script for r in rows], _shares(sums[:, :CLASSES]), _shares(sums[:, CLASSES:]))


MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
SCORES = f"{MEASURES}, base_failed boolean, class_distance double, word_distance double, nearest_lang string, kept boolean"


def judge(
    raws: list[bytes | None], refs: References, rules: Rules, hist: Histograms, langs: list[str | None] | None = None
) -> list[tuple]:
    """The values of ``SCORES`` for each text; ``langs`` are the languages that the texts are said to be in."""
    rows, by_class, by_word = [], [], []
    for raw in raws:
        raw = raw or b""
        words = raw.split()
        inside = sum(map(len, words))
        # code points: bytes that do not continue a character
        chars = inside - int(np.count_nonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) == 0x80))
        n_repeat = repeat_words(words)
        rows.append(
            (len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), duplicate_lines(raw), n_repeat)
            + (_base_failed(rules, len(words), n_repeat),)
        )
        by_class.append(hist.classes(raw))
        by_word.append(hist.words(raw))
    if not rows or not refs.languages:
        return [(*row, None, None, None, not row[5]) for row in rows]
    classes, words = np.array(by_class), np.array(by_word)
    distances = []
    part = max(1, PAIRS // len(refs.languages))  # texts at a time, however many languages there are
    for lo in range(0, len(rows), part):
        far_class = jensen_shannon(_shares(classes[lo : lo + part]), refs.classes)
        far_word = jensen_shannon(_shares(words[lo : lo + part]), refs.words)
        nearest = (far_class + far_word).argmin(axis=1)
        at = np.arange(len(nearest))
        distances += zip(far_class[at, nearest].tolist(), far_word[at, nearest].tolist(), nearest.tolist())
    known = {*zip(refs.languages, refs.scripts), *((None, x) for x in refs.scripts)}
    out = []
    for i, (row, (a, b, nearest)) in enumerate(zip(rows, distances)):
        odd = classes[i].sum() >= rules.min_chars_for_classes and a > rules.max_class_distance
        if row[0] >= rules.min_words_for_words:
            odd |= b > rules.max_word_distance
            odd |= a + b > rules.max_distance_sum + rules.short_text_allowance / row[0] ** 0.5
        if odd and not row[5]:  # base rules only, where nothing is known of the language or the script
            odd = (langs[i] if langs else None, script(raws[i])) in known
        out.append((*row, a, b, refs.languages[nearest], not row[5] and not odd))
    return out


def _language(docs: DataFrame, lang: str) -> Column:
    """The language column as text; null if there is none."""
    return (F.col(lang) if lang in docs.columns else F.lit(None)).cast("string")


def score(
    docs: DataFrame, refs: References, rules: Rules = Rules(), id_col: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per document: its id and the columns of ``SCORES``."""
    hist = Histograms(rules)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), _language(docs, lang).alias("lang"))
    key = chosen.schema["doc_id"].dataType.simpleString()
    names = [x.split()[0] for x in SCORES.split(", ")]
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}
    types = [kinds[x.split()[1]] for x in SCORES.split(", ")]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(zip(*judge(texts(batch, "text"), refs, rules, hist, batch.column(2).to_pylist())))
        arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", *names])

    return map_slices(chosen, step, f"doc_id {key}, {SCORES}")


def keep(docs: DataFrame, refs: References, rules: Rules = Rules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose text is kept, with all their columns."""
    hist, at, width = Histograms(rules), docs.columns.index(text), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                raws = part.column(at).cast(pa.binary()).to_pylist()
                langs = part.column(width).to_pylist()
                mask = pa.array([x[-1] for x in judge(raws, refs, rules, hist, langs)], pa.bool_())
                yield part.select(range(width)).filter(mask)

    both = docs.select(*(F.col(f"`{c}`") for c in docs.columns), _language(docs, lang).alias("__lang"))
    return both.mapInArrow(run, docs.schema)
