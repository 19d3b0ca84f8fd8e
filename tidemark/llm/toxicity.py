"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters the network as the vector of its entry in a vocabulary and the mean vector of its hashed letter trigrams.
Every text is cut into overlapping windows of words; each window runs through a forward and a backward gated recurrent
layer, attention pools their states, and a logistic unit scores the window. A document scores what its worst window
scores. The network is trained in numpy on a bounded sample of labelled documents: in each epoch the windows that
score highest in their document carry the document's label.

Defined cases: null and empty texts are one window of padding and get a low score; null ids are carried and never
learned from; repeated rows get equal scores (to six digits, in 32-bit sums); without labelled rows of both kinds every
score is 0; several labels of one id count as toxic if one of them does. A text of any length is scored by all its
windows; those of more than 12 characters for each of ``max_words`` are not learned from, and of a sampled id with more
rows than the sample holds only some are. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_slices, sampled, texts
from tidemark.llm.language_id import LETTERS


@dataclass(frozen=True)
class Fit:
    """Bounds of the training sample, sizes of the network and of its windows."""

    toxic_docs: int = 2000
    clean_docs: int = 5000
    held_back: float = 0.25  # of the sample: finds the operating point
    max_words: int = 1500  # longer documents are scored, but not learned from
    vocabulary: int = 8000
    min_docs: int = 3
    window: int = 24
    stride: int = 16
    units: int = 8
    word_dims: int = 8
    char_dims: int = 8
    char_bits: int = 12
    attention: int = 4
    epochs: int = 10
    batch: int = 128
    rate: float = 0.01
    seed: int = 5


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(LETTERS).split()


def trigram_codes(words: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all words, a blank at each end, and where each word's begin."""
    text = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
    code = (text[:-2] << np.uint32(16) | text[1:-1] << np.uint32(8) | text[2:]) * np.uint32(2654435761) >> np.uint32(32 - bits)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    inside = np.ones(len(code), dtype=bool)
    inside[(starts + sizes)[:-1]] = False  # the trigrams around the blank between two words
    return code[inside], np.concatenate([[0], np.cumsum(sizes)[:-1]])


def windows(sizes: list[int], fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window among the concatenated words, and its document. The last window of a text ends with it;
    only texts shorter than a window have padding."""
    starts, docs, at = [], [], 0
    for d, n in enumerate(sizes):
        own = list(range(0, max(n - fit.window, 0) + 1, fit.stride))
        if n > fit.window and own[-1] != n - fit.window:
            own.append(n - fit.window)
        starts += [at + x for x in own]
        docs += [d] * len(own)
        at += n
    return np.array(starts, dtype=np.int64), np.array(docs, dtype=np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Parameters, scoring and gradients. Gates are laid out as (update, reset, new) x (forward, backward) x units."""

    def __init__(self, vocabulary: dict[bytes, int], fit: Fit, odds: np.ndarray):
        rng = np.random.default_rng(fit.seed)
        self.fit, self.vocabulary = fit, vocabulary
        h, d = fit.units, fit.word_dims + fit.char_dims
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        word = normal(len(vocabulary) + 1, fit.word_dims, scale=0.05)
        word[1:, 0] = odds  # what the counts of the sample say is where training starts
        word[0] = 0
        self.p = {
            "word": word,
            "char": normal(1 << fit.char_bits, fit.char_dims, scale=0.05),
            "w": normal(d, 6 * h, scale=0.4),
            "u": normal(2, h, 3 * h, scale=0.3),
            "b": np.zeros(6 * h, dtype=np.float32),
            "wa": normal(2 * h, fit.attention, scale=0.4),
            "va": normal(fit.attention, scale=0.4),
            "wo": normal(2 * h, scale=0.4),
            "bo": np.zeros(1, dtype=np.float32),
        }

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The vectors of distinct words, and what their gradients need. The last row is the padding."""
        known = np.fromiter((self.vocabulary.get(w, 0) for w in words), dtype=np.int64, count=len(words))
        code, first = trigram_codes(words, self.fit.char_bits)
        sizes = np.diff(np.append(first, len(code)))
        x = np.zeros((len(words) + 1, self.fit.word_dims + self.fit.char_dims), dtype=np.float32)
        if words:
            x[:-1, : self.fit.word_dims] = self.p["word"][known]
            x[:-1, self.fit.word_dims :] = np.add.reduceat(self.p["char"][code], first, axis=0) / sizes[:, None]
        return x, known, code, sizes

    def _recurrent(self) -> np.ndarray:
        """The recurrent weights of both directions as one matrix."""
        h = self.fit.units
        u = np.zeros((2, h, 3, 2, h), dtype=np.float32)
        for k in range(2):
            u[k, :, :, k, :] = self.p["u"][k].reshape(h, 3, h)
        return u.reshape(2 * h, 6 * h)

    def run(self, gates: np.ndarray, index: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list, np.ndarray]:
        """States (window, step, units of both directions) for windows of rows of ``gates``."""
        h, (n, steps) = self.fit.units, index.shape
        table = gates.reshape(len(gates), 3, 2, h)
        ahead, back = np.ascontiguousarray(table[:, :, 0]), np.ascontiguousarray(table[:, :, 1])
        u = self._recurrent()
        state = np.zeros((n, 2 * h), dtype=np.float32)
        states = np.empty((n, steps, 2 * h), dtype=np.float32)
        x = np.empty((n, 3, 2, h), dtype=np.float32)
        trace = []
        for t in range(steps):
            x[:, :, 0] = ahead[index[:, t]]
            x[:, :, 1] = back[index[:, steps - 1 - t]]
            flat = x.reshape(n, 6 * h)
            rec = state @ u
            zr = flat[:, : 4 * h] + rec[:, : 4 * h]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            z, r = zr[:, : 2 * h], zr[:, 2 * h :]
            new = np.tanh(flat[:, 4 * h :] + r * rec[:, 4 * h :])
            if keep:
                trace.append((state, z, r, new, rec[:, 4 * h :]))
            state = new + z * (state - new)
            states[:, t, :h] = state[:, :h]
            states[:, steps - 1 - t, h:] = state[:, h:]
        return states, trace, u

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
        a = np.tanh(states @ self.p["wa"])
        e = a @ self.p["va"]
        e = np.where(mask, e, -30)
        e = np.exp(e - e.max(axis=1, keepdims=True))
        share = e / e.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", share, states)
        return pooled @ self.p["wo"] + self.p["bo"][0], pooled, share, a

    def logits(self, words: list[bytes], index: np.ndarray, chunk: int = 4096) -> np.ndarray:
        """Logit of each window; ``index`` holds rows of ``words``, and their number where there is padding."""
        x, *_ = self.inputs(words)
        gates = x @ self.p["w"] + self.p["b"]
        out = np.empty(len(index), dtype=np.float32)
        for lo in range(0, len(index), chunk):
            part = index[lo : lo + chunk]
            states, _, _ = self.run(gates, part)
            out[lo : lo + chunk] = self.pool(states, _mask(part, len(words)))[0]
        return out

    def gradients(self, words: list[bytes], index: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss of the windows, and its gradient."""
        h, dims, (n, steps), p = self.fit.units, self.fit.word_dims, index.shape, self.p
        x, known, code, sizes = self.inputs(words)
        states, trace, u = self.run(x @ p["w"] + p["b"], index, keep=True)
        logit, pooled, share, a = self.pool(states, _mask(index, len(words)))
        loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d = ((_sigmoid(logit) - y) / n).astype(np.float32)
        g["wo"], g["bo"][0] = pooled.T @ d, d.sum()
        dp = d[:, None] * p["wo"]
        ds = share[:, :, None] * dp[:, None, :]
        de = share * (np.einsum("nth,nh->nt", states, dp) - (pooled * dp).sum(axis=1)[:, None])
        da = de[:, :, None] * p["va"] * (1 - a * a)
        g["va"] = np.einsum("nt,nta->a", de, a)
        g["wa"] = np.einsum("nth,nta->ha", states, da)
        ds += da @ p["wa"].T
        gates = np.zeros((len(x), 3, 2, h), dtype=np.float32)
        du = np.zeros_like(u)
        carry = np.zeros((n, 2 * h), dtype=np.float32)
        for t in reversed(range(steps)):
            before, z, r, new, rec = trace[t]
            dh = carry.copy()
            dh[:, :h] += ds[:, t, :h]
            dh[:, h:] += ds[:, steps - 1 - t, h:]
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (before - new) * z * (1 - z)
            dr = dn * rec * r * (1 - r)
            own = np.concatenate([dz, dr, dn], axis=1)
            through = np.concatenate([dz, dr, dn * r], axis=1)
            du += before.T @ through
            carry = dh * z + through @ u.T
            own = own.reshape(n, 3, 2, h)
            np.add.at(gates[:, :, 0], index[:, t], own[:, :, 0])
            np.add.at(gates[:, :, 1], index[:, steps - 1 - t], own[:, :, 1])
        du = du.reshape(2, h, 3, 2, h)
        g["u"] = np.stack([du[k, :, :, k, :].reshape(h, 3 * h) for k in range(2)])
        flat = gates.reshape(len(x), 6 * h)
        g["b"], g["w"] = flat.sum(axis=0), x.T @ flat
        dx = (flat @ p["w"].T)[:-1]
        np.add.at(g["word"], known, dx[:, :dims])
        g["word"][0] = 0
        np.add.at(g["char"], code, np.repeat(dx[:, dims:] / sizes[:, None], sizes, axis=0))
        return loss, g


def _mask(index: np.ndarray, pad: int) -> np.ndarray:
    mask = index != pad
    mask[~mask.any(axis=1)] = True
    return mask


def indexed(docs: list[list[bytes]], fit: Fit) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of some documents, the windows as rows of them, and each window's document."""
    row: dict[bytes, int] = {}
    flat = np.fromiter((row.setdefault(w, len(row)) for d in docs for w in d), dtype=np.int64)
    starts, of = windows([len(d) for d in docs], fit)
    ends = np.cumsum([len(d) for d in docs])[of] if len(docs) else np.zeros(0, dtype=np.int64)
    at = starts[:, None] + np.arange(fit.window)
    flat = np.append(flat, len(row))  # the padding
    return list(row), flat[np.where(at < ends[:, None], at, len(flat) - 1)], of


class Model:
    """A trained network with its operating point, or nothing learned."""

    def __init__(self, net: Network | None = None, shift: float = 0.0):
        self.net, self.shift = net, shift

    def worst(self, raws: list[bytes | None]) -> np.ndarray:
        """The highest logit among each text's windows."""
        words, index, of = indexed([words_of(r) for r in raws], self.net.fit)
        out = np.full(len(raws), -np.inf)
        np.maximum.at(out, of, self.net.logits(words, index).astype(float))
        return out

    def score(self, raws: list[bytes | None]) -> np.ndarray:
        if self.net is None or not raws:
            return np.zeros(len(raws))
        return _sigmoid(self.worst(raws) - self.shift).round(6)


def train(raws: list[bytes], labels: list[int], fit: Fit = Fit(), prior: float = 0.5) -> Model:
    """Fit on labelled texts; ``prior`` is the share of toxic documents where the model will be used."""
    y = np.array(labels, dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return Model()
    back = np.random.default_rng(fit.seed).random(len(y)) < fit.held_back
    if len(set(y[back])) < 2 or len(set(y[~back])) < 2 or min(y[back].sum(), (1 - y[back]).sum()) < 20:
        back[:] = False  # too few to hold any back
    test, y_test = ([raws[i] for i in np.flatnonzero(back)], y[back]) if back.any() else (raws, y)
    docs, y = [words_of(raws[i]) for i in np.flatnonzero(~back)], y[~back]
    n, bad = len(docs), int(y.sum())
    inside, clean = Counter(), Counter()
    for d, v in zip(docs, y):
        (inside if v else clean).update(set(d))
    counts = {w: inside[w] + clean[w] for w in inside.keys() | clean.keys()}
    chosen = sorted((w for w, c in counts.items() if c >= fit.min_docs), key=lambda w: (-counts[w], w))[: fit.vocabulary]
    a = np.array([inside[w] for w in chosen], dtype=float)
    b = np.array([clean[w] for w in chosen], dtype=float)
    odds = np.log((a + 0.5) / (bad + 1)) - np.log((b + 0.5) / (n - bad + 1))
    odds *= (a + b) / (a + b + 4)
    net = Network({w: i + 1 for i, w in enumerate(chosen)}, fit, np.clip(odds, -3, 3).astype(np.float32))
    words, index, of = indexed(docs, fit)
    rng = np.random.default_rng(fit.seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    steps = 0
    # the windows of the first epoch: those with the strongest words
    strength = np.append(np.array([net.p["word"][net.vocabulary.get(w, 0), 0] for w in words]), 0.0)
    value = np.sort(strength[index], axis=1)[:, -4:].sum(axis=1)
    for _ in range(fit.epochs):
        order = np.lexsort((-value, of))
        top = order[np.unique(of[order], return_index=True)[1]]
        extra = rng.permutation(np.flatnonzero(y[of] == 0))[: n // 2]  # clean windows beside the worst ones
        rows = rng.permutation(np.concatenate([top, extra]))
        for lo in range(0, len(rows), fit.batch):
            part = rows[lo : lo + fit.batch]
            used, local = np.unique(index[part], return_inverse=True)
            pad = len(words)
            names = [words[i] for i in used if i != pad]
            _, g = net.gradients(names, local.reshape(len(part), -1), y[of[part]])
            steps += 1
            for k, v in g.items():
                m, s = moment[k]
                m += 0.1 * (v - m)
                s += 0.001 * (v * v - s)
                net.p[k] -= fit.rate * (m / (1 - 0.9**steps)) / (np.sqrt(s / (1 - 0.999**steps)) + 1e-8)
        value = net.logits(words, index)
    scores = np.concatenate([Model(net).worst(test[i : i + 256]) for i in range(0, len(test), 256)])
    return Model(net, _operating_point(scores, y_test, prior))


def _operating_point(worst: np.ndarray, y: np.ndarray, prior: float) -> float:
    """The logit above which calling a document toxic gives the best F1 at the given share of toxic documents."""
    order = np.argsort(-worst, kind="stable")
    hits = np.cumsum(y[order]) / y.sum() * prior
    wrong = np.cumsum(1 - y[order]) / (len(y) - y.sum()) * (1 - prior)
    best = int(np.argmax(2 * hits / (hits + wrong + prior)))
    if best + 1 == len(order):
        return float(worst[order[best]]) - 1
    return float(worst[order[best]] + worst[order[best + 1]]) / 2


def fit_model(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    fit: Fit = Fit(),
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Train on about ``toxic_docs`` and ``clean_docs`` documents (never twice as many), among the labels that ``learn`` allows, chosen by
    hashed id; the labels chosen are joined with their texts, no others are moved."""
    known = labels if learn is None else labels.where(learn)
    known = known.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().where("y IN (0, 1)").collect()}
    if len(sizes) < 2:
        return Model()
    share = F.when(F.col("y") == 1, fit.toxic_docs / sizes[1]).otherwise(fit.clean_docs / sizes[0])
    bound = 2 * (fit.toxic_docs + fit.clean_docs)
    some = F.broadcast(sampled(known.where("y IN (0, 1)"), "id", share).limit(bound))  # two numbers a row
    body = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    short = F.length("text") <= 12 * fit.max_words
    rows = body.where(short).join(some, "id").select("id", "y", "text").limit(bound).collect()
    rows = sorted((r["id"], r["text"].encode(), r["y"]) for r in rows)
    return train([t for _, t, _ in rows], [v for _, _, v in rows], fit, sizes[1] / (sizes[0] + sizes[1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``score``, ``predicted``."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.score(texts(batch, "text"))
        arrays = [batch.column(0), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "score", "predicted"])

    return map_slices(chosen, step, f"doc_id {kind}, score double, predicted int", rows=256)
