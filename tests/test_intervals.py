"""Interval sets: worked examples, and random sets against sets of points."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import range_columns as rc
from tidemark.operators import intervals

WIDTHS = [1, 1 << 16]


def frame(spark, cases):
    rows = [(k, lo, hi) for k, ranges in cases.items() for lo, hi in ranges]
    return spark.createDataFrame(rows, "k STRING, from LONG, to LONG")


def collect(df):
    out = {}
    for row in df.collect():
        out.setdefault(row["k"], []).append((row["from"], row["to"]))
    return {k: sorted(v) for k, v in out.items()}


MERGES = {
    "same": ([(1, 10), (1, 10), (1, 10)], [(1, 10)]),
    "adjacent": ([(1, 10), (11, 20)], [(1, 20)]),
    "overlapping": ([(1, 10), (5, 15), (7, 25)], [(1, 25)]),
    "apart": ([(40, 50), (1, 10), (20, 30)], [(1, 10), (20, 30), (40, 50)]),
    "mixed": ([(1, 10), (30, 40), (7, 25)], [(1, 25), (30, 40)]),
    "chain": ([(1, 10), (10, 20), (21, 30), (32, 40), (41, 50)], [(1, 30), (32, 50)]),
    "nested": ([(1, 100), (5, 6), (8, 9), (101, 101)], [(1, 101)]),
    "negative": ([(-9, -5), (-4, 0)], [(-9, 0)]),
}


@pytest.mark.parametrize("width", WIDTHS)
def test_merge_examples(spark, width):
    got = collect(intervals.merge(frame(spark, {k: v[0] for k, v in MERGES.items()}), ["k"], cell_width=width))
    assert got == {k: v[1] for k, v in MERGES.items()}


EXCLUSIONS = {
    "after": ([(1, 10)], [(50, 60)], [(1, 10)]),
    "before": ([(1, 10)], [(-60, -50)], [(1, 10)]),
    "equal": ([(1, 10)], [(1, 10)], []),
    "wider": ([(1, 10)], [(0, 30)], []),
    "start": ([(1, 10)], [(0, 5)], [(6, 10)]),
    "end": ([(1, 10)], [(5, 12)], [(1, 4)]),
    "inside": ([(1, 10)], [(5, 6)], [(1, 4), (7, 10)]),
    "many": ([(1, 100)], [(5, 10), (8, 20), (50, 60)], [(1, 4), (21, 49), (61, 100)]),
    "many sets": ([(10, 20), (15, 35)], [(0, 14), (17, 20), (23, 25)], [(15, 16), (21, 22), (26, 35)]),
}


@pytest.mark.parametrize("width", WIDTHS)
def test_exclude_examples(spark, width):
    base = frame(spark, {k: v[0] for k, v in EXCLUSIONS.items()})
    removed = frame(spark, {k: v[1] for k, v in EXCLUSIONS.items()})
    got = collect(intervals.exclude(base, removed, ["k"], cell_width=width))
    assert got == {k: v[2] for k, v in EXCLUSIONS.items() if v[2]}


OVERLAPS = {
    "a": ([(1, 100)], [(1, 10)], True),
    "b": ([(1, 5), (7, 10)], [(2, 6), (8, 9)], True),
    "c": ([(1, 5), (7, 10)], [(5, 8), (11, 12)], True),
    "d": ([(1, 5)], [(5, 10)], True),
    "e": ([(1, 5), (6, 10)], [(11, 12)], False),
    "f": ([(-5, -1)], [(-4, 0)], True),
    "g": ([(0, 0)], [(0, 0)], True),
    "h": ([(1, 5), (7, 10), (11, 15)], [(16, 20), (21, 25)], False),
    "i": ([(1, 5)], [(6, 10)], False),
    "only left": ([(1, 5)], [], False),
}


def test_overlap_examples(spark):
    a = frame(spark, {k: v[0] for k, v in OVERLAPS.items()})
    b = frame(spark, {k: v[1] for k, v in OVERLAPS.items()})
    got = {r["k"]: r["has_overlap"] for r in intervals.overlaps_between(a, b, ["k"], cell_width=4).collect()}
    assert got == {k: v[2] for k, v in OVERLAPS.items()}
    within = frame(spark, {"yes": [(1, 10), (1, 9)], "touching": [(1, 10), (10, 12)], "no": [(1, 10), (11, 12)]})
    got = {r["k"]: r["has_overlap"] for r in intervals.overlaps_within(within, ["k"]).collect()}
    assert got == {"yes": True, "touching": True, "no": False}


def test_clip_cover_split(spark):
    r = frame(spark, {"x": [(0, 15), (17, 25), (40, 100), (200, 210)]})
    assert collect(intervals.clip(r, F.lit(10), F.lit(50))) == {"x": [(10, 15), (17, 25), (40, 50)]}
    assert collect(intervals.covering(r, ["k"])) == {"x": [(0, 210)]}
    pieces = collect(intervals.split(frame(spark, {"a": [(1, 18), (20, 27)], "b": [(1, 10)]}), 5))
    assert pieces == {"a": [(1, 5), (6, 10), (11, 15), (16, 18), (20, 24), (25, 27)], "b": [(1, 5), (6, 10)]}


SLICES = [
    ([(1, 10)], 5, 1, False, [(1, 5)]),
    ([(1, 100)], 5, 5, True, [(96, 100), (91, 95), (86, 90), (81, 85), (76, 80)]),
    ([(1, 100)], 5, 5, False, [(1, 5), (6, 10), (11, 15), (16, 20), (21, 25)]),
    ([(1, 3), (2, 4), (3, 9), (50, 100)], 5, 5, False, [(1, 5), (6, 9), (50, 54), (55, 59), (60, 64)]),
    ([(1, 50), (91, 95), (96, 97), (97, 100)], 5, 5, True, [(96, 100), (91, 95), (46, 50), (41, 45), (36, 40)]),
    ([(1, 1)], 0, 5, True, []),
    ([(1, 1)], 5, 0, True, []),
    ([(1, 1)], 5, 5, True, [(1, 1)]),
]


@pytest.mark.parametrize("ranges,length,take,descending,want", SLICES)
def test_plan_slices_examples(spark, ranges, length, take, descending, want):
    got = intervals.plan_slices(frame(spark, {"x": ranges}), ["k"], length, take, descending=descending)
    assert [(r["from"], r["to"]) for r in got.orderBy("rank").collect()] == want


def test_many_slices(spark):
    assert intervals.plan_slices(frame(spark, {"x": [(1, 10000)]}), ["k"], 1, 10000, descending=True).count() == 10000


def test_blobs(spark):
    states = [(200, 500), (300, 700), (480, 630), (1333, 1350)]
    assert collect(intervals.blobs(frame(spark, {"x": states}), ["k"], 100, 1000)) == {"x": [(200, 700), (1333, 1350)]}
    assert collect(intervals.blobs(frame(spark, {"x": states}), ["k"], 100, 200)) == {
        "x": [(200, 399), (400, 599), (600, 700), (1333, 1350)]
    }
    near = frame(spark, {"x": [(301, 500), (212, 244), (200, 209)]})
    assert collect(intervals.blobs(near, ["k"], 1, 100)) == {"x": [(200, 209), (212, 244), (301, 400), (401, 500)]}


BLOCK_LISTS = [
    ([1, 10], 100, 30, [(1, 9), (10, 39), (40, 69), (70, 99), (100, 100)]),
    ([1, *range(10, 101, 10)], 100, 30, [(1, 9), *[(b, b + 9) for b in range(10, 100, 10)]]),
    ([1, 10], 50, 15, [(1, 9), (10, 24), (25, 39), (40, 50)]),
    ([10, 20], 35, 10, [(1, 9), (10, 19), (20, 29), (30, 35)]),
    ([10, 10], 10, 10, [(1, 9)]),
    ([20, 10], 35, 10, [(1, 9), (10, 19), (20, 29), (30, 35)]),
    ([10], 35, 10, []),
]


@pytest.mark.parametrize("blocks,latest,length,want", BLOCK_LISTS)
def test_ranges_from_blocks(spark, blocks, latest, length, want):
    listed = spark.createDataFrame([("x", b) for b in blocks], "k STRING, b LONG")
    got = intervals.ranges_from_blocks(listed, ["k"], "b", F.lit(1), F.lit(latest), length)
    assert sorted((r["from"], r["to"]) for r in got.collect()) == want


def test_batched_request_keeps_own_ranges(spark):
    asked = frame(spark, {"0xA": [(200, 500)], "0xB": [(300, 700)], "0xC": [(480, 630)]})
    scanned = spark.createDataFrame([(k, p) for k in ("0xA", "0xB", "0xC") for p in range(200, 701, 10)], "k STRING, p LONG")
    got = intervals.points_inside(scanned, asked, ["k"], "p", cell_width=64).groupBy("k").agg(F.min("p"), F.max("p")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {"0xA": (200, 500), "0xB": (300, 700), "0xC": (480, 630)}


def test_column_functions(spark):
    row = spark.sql("SELECT 0L a, 10L b, array(named_struct('from', 0L, 'to', 9L), named_struct('from', 20L, 'to', 20L)) r, array() e")
    a, b = F.col("a"), F.col("b")
    got = row.select(
        rc.size(a, b), rc.size(b, a), rc.is_valid(a, a), rc.is_valid(b, a), rc.includes(a, b, F.lit(0), F.lit(11)),
        rc.overlaps(a, b, F.lit(10), F.lit(12)), rc.overlaps(a, b, F.lit(11), F.lit(12)), rc.ranges_size_sum(F.col("r")),
        rc.any_range_contains(F.col("r"), F.lit(20)), rc.midpoint(a, F.lit(5)),
    ).first()
    assert list(got) == [11, 0, True, False, False, True, False, 11, True, 3]


@pytest.mark.parametrize("width", [3, 50])
def test_random_sets(spark, width):
    rng = random.Random(7)
    a, b = {}, {}
    for k in range(60):
        # key 0 holds about a third of all ranges
        n = 200 if k == 0 else 8
        make = lambda: [(lo, lo + rng.randint(0, 9)) for lo in (rng.randint(0, 15 * n) for _ in range(rng.randint(0, n)))]
        a[str(k)], b[str(k)] = make(), make()
    members = lambda ranges: {p for lo, hi in ranges for p in range(lo, hi + 1)}

    def islands(points):
        out = []
        for p in sorted(points):
            if out and out[-1][1] == p - 1:
                out[-1] = (out[-1][0], p)
            else:
                out.append((p, p))
        return out

    def check(df, op):
        want = {k: islands(op(members(a[k]), members(b[k]))) for k in a}
        assert collect(df) == {k: v for k, v in want.items() if v}

    fa, fb = frame(spark, a), frame(spark, b)
    check(intervals.merge(fa, ["k"], cell_width=width), lambda x, y: x)
    check(intervals.exclude(fa, fb, ["k"], cell_width=width), lambda x, y: x - y)
    check(intervals.intersect(fa, fb, ["k"], cell_width=width), lambda x, y: x & y)
    check(intervals.union(fa, fb, ["k"], cell_width=width), lambda x, y: x | y)


def test_split_around_points(spark):
    ranges = frame(spark, {"x": [(1, 10)]})
    points = spark.createDataFrame([("x", 3), ("x", 3), ("x", 10), ("x", 50)], "k STRING, p LONG")
    got = intervals.split_around_points(ranges, points, ["k"], "p")
    assert sorted((r["from"], r["to"], r["has_events"]) for r in got.collect()) == [
        (1, 2, False), (3, 3, True), (4, 9, False), (10, 10, True),
    ]
