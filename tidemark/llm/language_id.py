"""Language identification in two levels.

The first level picks a language family by linear scores, one against the rest; the second tells the languages of that
family apart by linear support vector machines, one for each pair, which vote. Inputs are hashed letter trigrams
of the whole text, however long it is. The models are fitted in numpy on a bounded sample of the rows of each language;
every language that has a row with a letter is learned.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a null id is carried and never learned
from; repeated rows get equal predictions; with no labelled rows every text is ``und``; with one language every text
with a letter has it. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, map_slices, texts, written

UNKNOWN = "und"
#: Families of language codes; a code that is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic", "sr": "slavic",
}
BITS = 12


@dataclass(frozen=True)
class Fit:
    """Bounds of the training sample and the strength of the regularisation. Every language is learned: of each there are
    about ``max_rows`` / languages rows, ``per_language`` at most and ``least`` at least."""

    max_rows: int = 4000
    per_language: int = 700
    least: int = 12
    steps: int = 150
    ridge: float = 1e-4


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    by_family: np.ndarray | None = None
    members: list[list[str]] = field(default_factory=list)
    #: family -> (pairs of its languages, a weight vector for each pair)
    pairs: list[tuple[list[tuple[int, int]], np.ndarray]] = field(default_factory=list)


def _letters() -> bytes:
    """Letters in lower case, bytes of other alphabets as they are, all else a blank."""
    return bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


LETTERS = _letters()


def has_letter(raw: bytes | None) -> bool:
    if not raw:
        return False
    if raw.translate(None, bytes(b for b in range(256) if b >= 128 or not chr(b).isalpha())):
        return True
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def features(raw: bytes) -> np.ndarray:
    """Square roots of the shares of hashed trigrams, and a constant."""
    a = np.frombuffer(b" " + raw.translate(LETTERS) + b" ", dtype=np.uint8).astype(np.uint32)
    grams = (a[:-2] << np.uint32(16) | a[1:-1] << np.uint32(8) | a[2:]) * np.uint32(2654435761) >> np.uint32(32 - BITS)
    counts = np.bincount(grams[grams != _BLANK], minlength=1 << BITS).astype(np.float32)
    out = np.ones((1 << BITS) + 1, dtype=np.float32)
    out[:-1] = np.sqrt(counts / max(counts.sum(), 1.0))
    return out


_BLANK = np.uint32((0x202020 * 2654435761 & 0xFFFFFFFF) >> (32 - BITS))


def _squared_hinge(x: np.ndarray, y: np.ndarray, fit: Fit) -> np.ndarray:
    """Linear support vector machines with squared hinge loss, one for each column of ``y`` (-1, 1, or 0 to leave a row
    out), by accelerated gradient descent."""
    n = np.maximum((y != 0).sum(axis=0), 1)
    share = np.where(y > 0, 1 / np.maximum((y > 0).sum(axis=0), 1), 1 / np.maximum((y < 0).sum(axis=0), 1)) * n / 2
    weight = (np.where(y == 0, 0, share) / n).astype(np.float32)
    step = 1 / (4 * np.maximum(weight.sum(axis=0), 1e-9) + fit.ridge)  # rows have a squared length of at most 2
    w = z = np.zeros((x.shape[1], y.shape[1]), dtype=np.float32)
    for t in range(fit.steps):
        slack = np.maximum(1 - y * (x @ z), 0)
        grad = -2 * (x.T @ (weight * slack * y)) + fit.ridge * z
        new = (z - step * grad).astype(np.float32)
        w, z = new, (new + t / (t + 3) * (new - w)).astype(np.float32)
    return w


def train(x: np.ndarray, langs: list[str], fit: Fit = Fit(), families: dict[str, str] = FAMILIES) -> Model:
    """Fit both levels."""
    if not langs:
        return Model()
    known = sorted(set(langs))
    groups: dict[str, list[str]] = {}
    for lang in known:
        groups.setdefault(families.get(lang, lang), []).append(lang)
    model = Model(sorted(groups), None, [groups[f] for f in sorted(groups)])
    own = np.array(langs)
    of = np.array([families.get(v, v) for v in langs])
    if len(model.families) > 1:
        y = np.stack([np.where(of == f, 1.0, -1.0) for f in model.families], axis=1).astype(np.float32)
        model.by_family = _squared_hinge(x, y, fit)
    for members in model.members:
        pairs = [(i, j) for i in range(len(members)) for j in range(i + 1, len(members))]
        weights = np.zeros((x.shape[1], 0), dtype=np.float32)
        if pairs:
            y = np.stack(
                [np.where(own == members[i], 1.0, np.where(own == members[j], -1.0, 0.0)) for i, j in pairs], axis=1
            ).astype(np.float32)
            rows = np.isin(own, members)
            weights = _squared_hinge(x[rows], y[rows], fit)
        model.pairs.append((pairs, weights))
    return model


def _soft(margins: np.ndarray) -> np.ndarray:
    e = np.exp(4 * (margins - margins.max(axis=-1, keepdims=True)))
    return e / e.sum(axis=-1, keepdims=True)


def predict(model: Model, raws: list[bytes | None]) -> tuple[list[str], list[float]]:
    langs, scores = [UNKNOWN] * len(raws), [0.0] * len(raws)
    at = [i for i, raw in enumerate(raws) if has_letter(raw)] if model.families else []
    if not at:
        return langs, scores
    x = np.stack([features(raws[i]) for i in at])
    sure = np.ones((len(at), 1)) if model.by_family is None else _soft((x @ model.by_family).astype(float))
    family = sure.argmax(axis=1)
    for f, members in enumerate(model.members):
        rows = np.flatnonzero(family == f)
        if not len(rows):
            continue
        pairs, weights = model.pairs[f]
        votes, trust = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
        margins = (x[rows] @ weights).astype(float)
        for k, (i, j) in enumerate(pairs):
            p = 1 / (1 + np.exp(-4 * np.clip(margins[:, k], -100, 100)))
            votes[:, i] += p >= 0.5
            votes[:, j] += p < 0.5
            trust[:, i] += p
            trust[:, j] += 1 - p
        best = (votes + trust / (len(members) + 1)).argmax(axis=1)  # a tie of votes goes to the greater trust
        for r, b in zip(rows, best):
            inside = trust[np.searchsorted(rows, r), b] / (len(members) - 1) if len(members) > 1 else 1.0
            langs[at[r]] = members[b]
            scores[at[r]] = float(np.clip(sure[r, f] * inside, 0, 1))
    return langs, scores


def fit_model(
    docs: DataFrame,
    learn: Column | None = None,
    fit: Fit = Fit(),
    families: dict[str, str] = FAMILIES,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """Fit on a bounded number of rows of each language among those that ``learn`` allows. They are those with the smallest
    hashes of id and text, so the same ones on every run; repeated rows count once."""
    rows = docs if learn is None else docs.where(learn)
    rows = rows.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    # written, so that the join below stands between plain shuffles
    sizes = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    languages = sizes.count()
    if not languages:
        return Model()
    want = min(fit.per_language, max(fit.max_rows // languages, fit.least))
    key = F.xxhash64(F.lit(7), "id", "text")
    # half as many again are drawn, as some have no letter
    share = F.pmod(key, F.lit(1 << 30)) / float(1 << 30) < F.col("half_more") / F.col("n")
    drawn = rows.join(sizes.withColumn("half_more", F.lit(1.5 * want + 10)), "lang").where(share)
    drawn = drawn.groupBy("lang", key.alias("key")).agg(F.first("text").alias("text"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        raws = texts(batch, "text")
        some = pa.array([has_letter(raw) for raw in raws])
        blobs = [features(raw).astype("<f2").tobytes() for raw in raws if has_letter(raw)]
        if not blobs:
            return None
        arrays = [batch.column(i).filter(some) for i in range(2)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(blobs, pa.binary())], ["lang", "key", "x"])

    ranked = map_slices(drawn, step, "lang string, key bigint, x binary")
    order = Window.partitionBy("lang").orderBy("key")
    some = ranked.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= want)
    got = sorted((r["lang"], r["key"], bytes(r["x"])) for r in some.select("lang", "key", "x").collect())
    x = np.array([np.frombuffer(b, dtype="<f2") for *_, b in got], dtype=np.float32)
    return train(x, [v for v, *_ in got], fit, families)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``lang_pred``, ``score``."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = predict(model, texts(batch, "text"))
        arrays = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score"])

    return map_slices(chosen, step, f"doc_id {kind}, lang_pred string, score double")


def keep(docs: DataFrame, model: Model, min_score: float, text: str = "text") -> DataFrame:
    """The rows whose language is known with at least ``min_score``, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                langs, scores = predict(model, part.column(at).cast(pa.binary()).to_pylist())
                yield part.filter(pa.array([v != UNKNOWN and s >= min_score for v, s in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
