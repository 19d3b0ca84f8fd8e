import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity as T

from .cases import LONG, clashing, frame, odd_rows

BAD = ["blorg", "snarf", "quibbit", "zonked"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice('aeiou')}" for _ in range(rng.randint(10, 120))]
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * rng.randint(2, 4)):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy():
    rows = corpus(900)
    model = T.train([t.encode() for _, t, _ in rows[:600]], [y for *_, y in rows[:600]], prior=0.3)
    scores = np.concatenate([model.score([t.encode() for _, t, _ in rows[i : i + 100]]) for i in range(600, 900, 100)])
    y = np.array([y for *_, y in rows[600:]])
    assert ((scores >= 0.5) == y).mean() > 0.94
    # a toxic passage is found wherever it stands in a long text
    clean = rows[[y for *_, y in rows].index(0)][1]
    far = f"{' '.join([clean] * 40)} blorg snarf zonked {' '.join([clean] * 40)}"
    low, high = model.score([" ".join([clean] * 80).encode(), far.encode()])
    assert low < 0.5 <= high


def test_gradients_against_differences():
    fit = T.Fit(units=3, word_dims=2, char_dims=2, char_bits=4, attention=2, window=5, seed=3)
    net = T.Network({b"aa": 1, b"bb": 2}, fit, np.array([0.5, -0.5], dtype=np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = [b"aa", b"bb", b"cde"]
    index, y = np.array([[0, 1, 2, 0, 1], [2, 1, 3, 3, 3]]), np.array([1.0, 0.0])
    _, g = net.gradients(words, index, y)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            if name == "word" and at[0] == 0:
                continue
            old, step = value[at], 1e-2
            value[at] = old + step
            up = net.gradients(words, index, y)[0]
            value[at] = old - step
            down = net.gradients(words, index, y)[0]
            value[at] = old
            assert abs((up - down) / (2 * step) - g[name][at]) < 2e-3, name


def test_windows_cover_every_word():
    fit = T.Fit()
    for n in (0, 1, 23, 24, 25, 40, 41, 1000):
        starts, of = T.windows([3, n, 5], fit)
        own = starts[of == 1] - 3
        assert len(own) and own[0] == 0 and own.max() + fit.window >= n
        assert (np.diff(own) <= fit.stride).all()


def test_odd_rows(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    model = T.fit_model(docs, labels)
    odd = clashing(frame(spark, odd_rows()))
    got = T.score(odd, model).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert all(r.score < 0.5 for r in got if r.doc_id in (2, 3, 4))
    assert model.score([LONG.encode()]).shape == (1,)
    none = T.fit_model(docs, labels, learn=F.lit(False))
    assert {r.score for r in T.score(odd, none).collect()} == {0.0}
    assert T.score(odd.limit(0), model).count() == 0
