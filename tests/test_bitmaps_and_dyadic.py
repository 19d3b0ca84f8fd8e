"""Bitmaps of ids against sets, and the dyadic index against looking at every range."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.operators import bitmaps, dyadic, sketches
from tidemark.queries import REGISTRY

LEDGER = "product_id INT, investor_id INT, datetime TIMESTAMP, block_number LONG, balance DECIMAL(38,18)"
START = datetime(2024, 1, 1)


def test_holders_of_any_group(spark):
    rng, rows = random.Random(3), []
    for n in range(900):
        who = 7 if rng.random() < 0.3 else rng.choice([1, 2, 32_767, 32_768, 70_000, 2_000_000_000])
        at = START + timedelta(minutes=rng.randrange(60 * 24 * 9))
        rows.append((rng.randrange(4), who, at, n, rng.choice([None, Decimal(0), Decimal(1), Decimal(5)])))
    lo, hi = datetime(2024, 1, 2), datetime(2024, 1, 9, 12)
    frame = spark.createDataFrame(rows, LEDGER).repartition(5)
    stored = bitmaps.holders(frame, ["product_id"], "1day", F.lit(lo), F.lit(hi))
    want: dict = {}
    for product in range(4):
        for who in {r[1] for r in rows}:
            own = sorted((r[2], r[3], r[4]) for r in rows if r[:2] == (product, who) and lo <= r[2] <= hi)
            state = None
            for day in range(1, 9):
                last = [b for at, _, b in own if at.date() == (START + timedelta(days=day)).date()]
                state = last[-1] if last and last[-1] is not None else state
                if state:
                    want.setdefault((product, START + timedelta(days=day)), set()).add(who)
    got = {(r.product_id, r.datetime): r.investor_count for r in bitmaps.counts(stored, ["product_id", "datetime"]).collect()}
    assert got == {k: len(v) for k, v in want.items()}
    days = {}
    for (_, day), who in want.items():
        days.setdefault(day, set()).update(who)
    assert {r.datetime: r.investor_count for r in bitmaps.counts(stored, ["datetime"]).collect()} == {k: len(v) for k, v in days.items()}
    assert bitmaps.counts(stored, []).first()[0] == len(set().union(*want.values()))


def test_sketches_stay_within_their_error_of_the_bitmaps(spark):
    rows = spark.range(300_000).select((F.col("id") % 3).cast("int").alias("product_id"), (F.col("id") * 7919 % 400_009).cast("int").alias("investor_id"))
    exact = bitmaps.counts(bitmaps.build(rows, ["product_id"], "investor_id"), ["product_id"])
    near = rows.groupBy("product_id").agg(F.hll_sketch_estimate(F.hll_sketch_agg("investor_id", sketches.LG_K_ALL)).alias("near"))
    for r in exact.join(near, "product_id").collect():
        assert r.investor_count == 100_000 and abs(r.near - r.investor_count) < 4 * 0.83 / 2 ** (sketches.LG_K_ALL / 2) * r.investor_count


def test_exact_holders_plan(spark):
    plan = REGISTRY["exact_holders_daily"].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    # the ledger itself, a running balance, has three of them
    assert plan.count("Exchange") <= 5 + 3 and "SinglePartition" not in plan


def made(seed, n, hot=0.35):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < hot else rng.choice("abc")
    ranges = []
    for _ in range(n):
        lo = rng.randrange(-300, 300)
        ranges.append((key(), lo, lo + rng.choice([-1, 0, 1, 2, 3, 10, 63, 64, 65, 500]), rng.randrange(3)))
    return ranges, [(i, key(), rng.randrange(-400, 900)) for i in range(600)]


@pytest.mark.parametrize("seed", [1, 2])
def test_points_against_every_range(spark, seed):
    ranges, points = made(seed, 40)
    r = spark.createDataFrame(ranges, "k string, `from` long, `to` long, v int")
    p = spark.createDataFrame(points, "i int, k string, at long").repartition(4)
    held = {i: [v for rk, lo, hi, v in ranges if rk == k and lo <= at <= hi] for i, k, at in points}
    got = sorted(x.i for x in dyadic.points_inside(p, r, ["k"], "at").collect())
    assert got == sorted(i for i, own in held.items() if own)  # each once
    largest = dyadic.largest_at(p, r, ["k"], "at", F.col("v"), "worst")
    assert {x.i: x.worst for x in largest.collect()} == {i: max(own) for i, own in held.items() if own}
    assert dyadic.points_inside(p, r.limit(0), ["k"], "at").count() == 0


def test_blocks_are_few_disjoint_and_whole(spark):
    rng = random.Random(9)
    spans = [(0, 0), (-1, 0), (7, 8), (2**40, 2**40 + 2**33 - 1), (-(2**50), 2**50), (3, 2)]
    spans += [(lo, lo + rng.randrange(2000)) for lo in (rng.randrange(-5000, 5000) for _ in range(40))]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(spans)], "k int, `from` long, `to` long")
    found: dict = {}
    for r in dyadic.index(df, ["k"]).collect():
        found.setdefault(r.k, []).append((r._block << r._level, ((r._block + 1) << r._level) - 1))
    for i, (lo, hi) in enumerate(spans):
        blocks = sorted(found.get(i, []))
        assert len(blocks) <= 2 * max(1, (hi - lo + 1).bit_length())
        at = lo
        for first, last in blocks:
            assert first == at
            at = last + 1
        assert at == max(hi + 1, lo)


def test_import_results_scan_little(spark):
    plan = REGISTRY["import_results_over_time"].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 8


def test_a_point_is_asked_for_once_in_its_word(spark, monkeypatch):
    asked, real = [], dyadic._asked
    monkeypatch.setattr(dyadic, "_asked", lambda *a: asked.append(real(*a).count()) or real(*a))
    spans = [(lo, lo + n) for lo, n in ((-70, 0), (-3, 5), (0, 63), (64, 1), (100, 40), (63, 64), (300, 31), (500, 62))]
    r = spark.createDataFrame([("a", *s) for s in spans], "k string, `from` long, `to` long")
    p = spark.createDataFrame([("a", i) for i in range(-200, 700)], "k string, at long")
    got = sorted(x.at for x in dyadic.points_inside(p, r, ["k"], "at").collect())
    assert got == [i for i in range(-200, 700) if any(lo <= i <= hi for lo, hi in spans)]
    assert asked == [900]
