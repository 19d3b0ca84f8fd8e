import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, positives=5, negatives=3):
    """All scores of all anchors."""
    sound = {
        (i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v), y)
        for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)
    }
    out = []
    for i, q, y in sound:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, p)), j, z) for j, p, z in sound if j != i and len(p) == len(q)]
        for s, j, _ in sorted(x for x in scored if x[2] == y)[:positives]:
            fit = sorted((t, k) for t, k, z in scored if z != y and -50 * s <= -100 * t <= -95 * s)
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, settings=H.Mining(), every=50, parts=4):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = H.mine(frame, F.col("vec_id") % every == 0, settings).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


def corpus(n, dims, seed=1):
    """Groups of similar vectors of mixed labels, and a third of the rows near copies or copies of one vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(4, n // 25), dims))
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = centres[0] + (rng.normal(size=dims) * 0.02 if i % 2 else 0)
        else:
            v = centres[rng.integers(len(centres))] + rng.normal(size=dims) * rng.choice([0.2, 0.6])
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(0, 4))))
    return rows


SMALL = H.Mining(block_rows=4, group_blocks=3, unit_anchors=5, sample_rows=40, axes=3)


@pytest.mark.parametrize("dims", [2, 16])
@pytest.mark.parametrize("settings", [H.Mining(), SMALL])
def test_against_all_scores(spark, dims, settings):
    rows = corpus(400, dims)
    want = brute(rows, 10)
    assert len(want) > 200 and mined(spark, rows, settings, 10) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    plain = lambda n: [(i, [0.8 if i % 2 else 1.0, i / 100], i % 2) for i in range(n)]
    rows = plain(20) + plain(5)
    rows += [(50, None, 1), (50, [1.0, 0.5], None), (51, [nan, 1.0], 1), (52, [inf, 1.0], 1), (53, [None, 1.0], 1), (None, [1.0, 0.0], 1)]
    rows += [(54, [0.0, 0.0], 0), (55, [-1.0, 0.0], 0), (100, [], 1), (101, [], 1), (102, [], 0), (60, [1.0, 0.0, 0.0], 1), (61, [1.0] * 3, 1)]
    rows += [(150, [-1.0, 0.0], 0), (200, [0.0, 0.0], 0), (62, [0.7, 0.0, 0.0], 0), (1, [1.0, 0.3], 1)]
    want = brute(rows, 10)
    assert len(want) > 30
    assert mined(spark, rows, every=10) == want
    assert mined(spark, [*rows, (70, [3e38, 1.0], 1)], SMALL, 10) == want  # its scores would be no 64-bit numbers
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(5) for c in "id key grp block dims q goals rank score anchor".split()})
    assert H.mine(frame, F.col("vec_id") % 10 == 0).count() == len(want)
    assert H.mine(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert H.mine(frame.where("label IS NULL"), F.col("vec_id") % 10 == 0).count() == 0
    assert H.mine(frame, F.col("vec_id") < -1).count() == 0


def test_the_curve_visits_every_cell_and_moves_by_one():
    for dims, bits in ((1, 3), (2, 4), (3, 3), (5, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        place = H.hilbert(cells, bits)
        path = cells[np.argsort(place)]
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def _inside(spark, rows, settings):
    usable = H.usable(spark.createDataFrame(rows, SCHEMA), settings, F.lit(True), "vec_id", "embedding", "label").cache()
    return usable, H.blocks(usable, H.fit_axes(usable, settings), settings).toArrow()


def test_zone_maps_bound_every_score_and_spare_blocks(spark):
    """Of groups that lie apart most blocks are out of reach, and no score lies beyond its bounds."""
    rng = np.random.default_rng(4)
    centres = np.eye(8)
    rows = [(i, [float(x) for x in centres[i % 8] + rng.normal(size=8) * 0.01], i % 3) for i in range(800)]
    settings = H.Mining(block_rows=10, group_blocks=100, sample_rows=500)
    usable, table = _inside(spark, rows, settings)
    blocks = table.filter(table.column("block").is_valid())
    assert sum(blocks.column("n").to_pylist()) == 800
    anchors = usable.where("id < 40").selectExpr("id AS key", "id", "label", "dims", "q").toArrow()
    goals = [np.array([[0, 0, 60_000]], dtype="<i8").tobytes()] * 40
    readers = H.Readers(anchors.append_column("goals", [goals]), True, settings)
    lo, hi = H._matrix(blocks.column("lo"), "<i4", len(blocks)), H._matrix(blocks.column("hi"), "<i4", len(blocks))
    least, most = readers.bounds(lo, hi)
    for b, blob in enumerate(blocks.column("q").to_pylist()):
        score = readers.q @ np.frombuffer(blob, dtype="<i4").reshape(-1, 8).astype(np.int64).T
        assert (score >= least[:, b : b + 1]).all() and (score <= most[:, b : b + 1]).all()
    assert readers.reaches(least, most).mean() < 0.25
