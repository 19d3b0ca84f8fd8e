import numpy as np
import pytest

from tests.conftest import SMALL
from tidemark.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    """vec_id -> (links, component) of sound vectors, all pairs."""
    sound = [
        (i, np.array(v, dtype=np.float32).astype(float), y)
        for i, v, y in rows
        if y is not None and v and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(v)
    ]
    up, links = list(range(len(sound))), [0] * len(sound)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (_, x, p) in enumerate(sound):
        for b, (_, y, q) in enumerate(sound[:a]):
            if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a] += 1
                links[b] += 1
                r, s = find(a), find(b)
                up[max(r, s)] = min(r, s)
    names = {}
    for k, (i, _, _) in enumerate(sound):
        names.setdefault(find(k), []).append(i)
    out = {i: (0, i) for i, _, _ in rows}
    return out | {i: (links[k], min(names[find(k)])) for k, (i, _, _) in enumerate(sound)}


def corpus(n, dims, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base = rng.normal(size=dims)
        for _ in range(int(rng.choice([1, 1, 1, 2, 5, 30]))):
            v = base + rng.normal(size=dims) * np.linalg.norm(base) / np.sqrt(dims) * rng.choice([0.0, 0.1, 0.2, 0.27, 0.3])
            rows.append((len(rows), [float(np.float32(x)) for x in v], int(rng.integers(0, 3))))
    return rows


@pytest.mark.parametrize("dims", [5, 64])
def test_recall_against_brute_force(spark, dims):
    rows = corpus(700, dims)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    for search in (E.Search(), E.Search(block=16, max_lists=8)):
        got = {r.id: (r.n_links, r.component_id) for r in E.near_duplicates(frame, search).collect()}
        assert got.keys() == want.keys()
        assert all(got[i][0] <= want[i][0] for i in want)  # no link below the threshold
        found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
        assert there and found >= 0.99 * there
        if found == there:
            assert got == want


def hot(n, dims, seed=3):
    """A third of the rows is one group of near copies whose differences lie in few dimensions."""
    rng = np.random.default_rng(seed)
    base, rows = rng.normal(size=dims), []
    for i in range(n):
        v = rng.normal(size=dims)
        if i % 3 == 0:
            v, k = base.copy(), int(rng.choice([1, 2, 4, 8]))
            v[:k] += rng.normal(size=k) * np.linalg.norm(base) / np.sqrt(k) * rng.choice([0.1, 0.2, 0.27])
        rows.append((i, [float(np.float32(x)) for x in v], 1))
    return rows


def test_hot_group_that_differs_in_few_dimensions(spark):
    rows = hot(900, 64)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert sum(n for n, _ in want.values()) > 10_000
    for search in (E.Search(), E.Search(block=64)):
        assert {r.id: (r.n_links, r.component_id) for r in E.near_duplicates(frame, search).collect()} == want


def test_one_of_two_neighbours_visits_the_other():
    x = np.array([v for _, v, _ in hot(3000, 64)])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    index = E.Index(x, 64, E.Search())
    home, _, _ = index.encode(unit)
    visits = index.probes(unit, home)
    i, j = np.nonzero(np.triu(unit @ unit.T >= 0.93, 1))
    assert (home[i] != home[j]).sum() > 10_000
    assert (visits[i, home[j]] | visits[j, home[i]]).all()


def test_generated_vectors(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding, r.label) for r in vectors.collect()])
    rows = E.near_duplicates(vectors).collect()
    assert {r.id: (r.n_links, r.component_id) for r in rows} == want
    assert all(r.kept == (r.id == r.component_id) for r in rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1),
        (2, [2.0, 0.0], 1),
        (2, [2.0, 0.0], 1),
        (3, [1.0, 0.0], None),
        (4, None, 1),
        (5, [], 1),
        (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1),
        (8, [inf, 1.0], 1),
        (9, [None, 1.0], 1),
        (10, [1.0, 0.0], 2),
        (11, [1.0, 0.0, 0.0], 1),
        (12, [5.0, 0.0, 0.0], 1),
        (13, [-1.0, 0.0], 1),
        (14, [1e-40, 0.0], 1),
        (15, [3e38, 0.0], 1),
        (None, [3.0, 0.0], 1),
    ]
    frame = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA + ", id string, cls int")
    got = sorted(((r.id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(frame).collect()), key=str)
    assert len(got) == len(rows)
    for i, n, c, kept in got:
        if i in (1, 2, 14, 15, None):
            assert (n, c) == (5, 1)
        elif i in (11, 12):
            assert (n, c) == (1, 11)
        else:
            assert (n, c) == (0, i)
        assert kept == (i == c)
    assert E.near_duplicates(frame.limit(0)).count() == 0
    assert E.near_duplicates(frame.where("label IS NULL")).collect()[0].n_links == 0
    with pytest.raises(TypeError):
        E.near_duplicates(frame.withColumn("embedding", frame.label))


def test_table_distances_never_lose_a_neighbour():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 24))
    index = E.Index(x, 8, E.Search())
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    home, codes, loss = index.encode(unit)
    for list_ in np.unique(home):
        own = np.flatnonzero(home == list_)
        true = np.sqrt(np.maximum(2 - 2 * unit @ unit[own].T, 0))
        assert (index.distances(unit, int(list_), codes[own]) - loss[own][None, :] <= true + 1e-4).all()
