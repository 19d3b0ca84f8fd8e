"""Running values, as-of joins, gap filling and interpolation against brute force."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.timegrid import cell, epoch_seconds_between, iso_to_timestamp, time_bucket
from tidemark.operators import asof, gapfill
from tidemark.operators.latest import current_holders, keep_first
from tidemark.operators.scan import Run, running
from tidemark.plans import portfolio

START = datetime(2024, 1, 1)
at = lambda minutes: START + timedelta(minutes=minutes)


@pytest.mark.parametrize("hours", [0.5, 10000])
def test_running_values_with_a_hot_key(spark, hours):
    rng = random.Random(3)
    rows = []
    for i in range(1200):
        k = "hot" if i % 3 == 0 else str(i % 50)
        rows.append((k, at(rng.randint(0, 5000)), i, rng.randint(-9, 9), None if rng.random() < 0.5 else i))
    df = spark.createDataFrame(rows, "k STRING, datetime TIMESTAMP, n INT, v INT, w INT")
    got = running(
        df, ["k"], ["datetime", "n"], cell(F.col("datetime"), hours),
        {
            "total": Run("sum", F.col("v")),
            "low": Run("min", F.col("v"), exclusive=True),
            "high": Run("max", F.col("v")),
            "prev": Run("last", F.col("w"), exclusive=True),
            "next": Run("last", F.col("w"), reverse=True),
        },
    ).toPandas()
    want = pd.DataFrame(rows, columns=["k", "datetime", "n", "v", "w"]).sort_values(["k", "datetime", "n"])
    groups = want.groupby("k")
    want["total"] = groups["v"].cumsum()
    want["high"] = groups["v"].cummax()
    want["low"] = groups["v"].transform(lambda s: s.cummin().shift())
    want["prev"] = groups["w"].transform(lambda s: s.ffill().shift())
    want["next"] = groups["w"].transform(lambda s: s.bfill())
    got = got.sort_values(["k", "datetime", "n"])
    for c in ("total", "high", "low", "prev", "next"):
        assert got[c].astype(float).fillna(-99).tolist() == want[c].astype(float).fillna(-99).tolist(), c


def test_windows_run_per_cell(spark):
    df = spark.createDataFrame([("a", START, 1)], "k STRING, datetime TIMESTAMP, v INT")
    plan = running(df, ["k"], ["datetime"], cell(F.col("datetime")), {"s": Run("sum", F.col("v"))})
    assert "windowspecdefinition(k#" in plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_cell" in plan._jdf.queryExecution().optimizedPlan().toString()


def brute_nearest(ticks, k, t, tolerance):
    best = [x for x in ticks if x[0] == k and abs((x[1] - t).total_seconds()) <= tolerance]
    return min(best, key=lambda x: (abs((x[1] - t).total_seconds()), x[1], x[2]), default=None)


@pytest.mark.parametrize("hours", [0.1, 500])
def test_nearest(spark, hours):
    rng = random.Random(5)
    ticks = [(rng.choice([1, 1, 2]), at(rng.randint(0, 2000)), n, float(n)) for n in range(300)]
    probes = [(i, rng.choice([1, 2, 3]), at(rng.randint(-30, 2030))) for i in range(200)]
    got = asof.nearest(
        spark.createDataFrame(probes, "id INT, price_feed_id INT, datetime TIMESTAMP"),
        spark.createDataFrame(ticks, "price_feed_id INT, datetime TIMESTAMP, block_number INT, price DOUBLE"),
        "price_feed_id", F.expr("INTERVAL 10 MINUTE"), ["price", "block_number"], cell_hours=hours,
    )
    got = {r["id"]: (r["near_datetime"], r["near_block_number"]) for r in got.collect()}
    for i, k, t in probes:
        best = brute_nearest(ticks, k, t, 600)
        assert got[i] == ((best[1], best[2]) if best else (None, None))


def brute_interpolated(ticks, k, t):
    bucket = lambda d: START + timedelta(minutes=((d - START) // timedelta(minutes=15)) * 15)
    sums = {}
    for f, d, _, p in ticks:
        if f == k and abs(d - t) <= timedelta(days=3):
            sums.setdefault(bucket(d), []).append(p)
    series = {b: sum(v) / len(v) for b, v in sums.items()}
    b = bucket(t)
    if b in series:
        return series[b]
    prev, after = [x for x in series if x < b], [x for x in series if x > b]
    if not prev or not after:
        return None
    p, n = max(prev), min(after)
    return series[p] + (series[n] - series[p]) * ((b - p) / (n - p))


def test_interpolated_price_with_cut_end_buckets(spark):
    rng = random.Random(11)
    # sparse ticks, clustered three days before and after many probes
    days = [0, 3, 6, 9]
    ticks = [(rng.choice([1, 2]), START + timedelta(days=rng.choice(days), minutes=rng.randint(0, 59)), n, rng.random() * 10) for n in range(60)]
    probes = [(i, rng.choice([1, 2, 3]), START + timedelta(days=rng.choice(days), minutes=rng.randint(-90, 90))) for i in range(300)]
    got = asof.interpolated_price(
        spark.createDataFrame(probes, "id INT, price_feed_id INT, datetime TIMESTAMP"),
        spark.createDataFrame(ticks, "price_feed_id INT, datetime TIMESTAMP, block_number INT, price DOUBLE"),
    )
    got = {r["id"]: r["interpolated_price"] for r in got.collect()}
    seen = 0
    for i, k, t in probes:
        want = brute_interpolated(ticks, k, t)
        seen += want is not None
        assert got[i] == (pytest.approx(want) if want is not None else None), (k, t)
    assert seen > 100


def test_gapfill_locf_interpolate(spark):
    df = spark.createDataFrame([("a", at(60), 1.0), ("a", at(240), 4.0), ("b", at(120), 7.0)], "k STRING, datetime TIMESTAMP, v DOUBLE")
    filled = gapfill.gapfill(df, ["k"], "1hour", F.lit(at(0)), F.lit(at(300)), {"v": F.max("v")})
    carried = gapfill.locf(filled, ["k"], ["v"]).orderBy("k", "datetime")
    assert [r["v"] for r in carried.filter("k = 'a'").collect()] == [None, 1, 1, 1, 4, 4]
    lined = gapfill.interpolate(filled, ["k"], "v").orderBy("k", "datetime")
    assert [r["v"] for r in lined.filter("k = 'a'").collect()] == [None, 1, 2, 3, 4, None]
    edged = gapfill.interpolate(filled, ["k"], "v", next_at=F.lit(at(360)), next_value=F.lit(11.0)).orderBy("k", "datetime")
    assert [r["v"] for r in edged.filter("k = 'b'").collect()] == [None, None, 7, 8, 9, 10]


def test_buckets_and_clock(spark):
    row = spark.sql("SELECT timestamp'2024-01-03 05:00:00' t").select(
        time_bucket("1week", F.col("t")).cast("string"), time_bucket("4hour", F.col("t")).cast("string"),
        iso_to_timestamp(F.lit("2019-01-17T17:00:00.000-07:00")).cast("string"),
        epoch_seconds_between(F.lit(at(0)) + F.expr("INTERVAL 1500 MILLISECOND"), F.lit(at(0))),
    ).first()
    assert list(row) == ["2024-01-01 00:00:00", "2024-01-03 04:00:00", "2019-01-18 00:00:00", 2]


def test_last_values(spark):
    rows = [("a", at(1), 1, 5.0), ("a", at(2), 2, None), ("b", at(1), 1, 1.0), ("b", at(1), 2, 3.0), ("c", at(1), 1, 0.0)]
    df = spark.createDataFrame(rows, "k STRING, datetime TIMESTAMP, block_number INT, balance DOUBLE")
    assert [(r["k"], r["last_balance"]) for r in current_holders(df, ["k"]).collect()] == [("b", 3.0)]
    kept = keep_first(df, ["k"], ["datetime", "block_number"]).orderBy("k").collect()
    assert [(r["k"], r["balance"]) for r in kept] == [("a", 5.0), ("b", 1.0), ("c", 0.0)]


def test_exact_holders_match_the_dense_grid(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 20), at(rng.randint(0, 6000)), n, rng.choice([0.0, 0.0, 5.0])) for n in range(300)]
    df = spark.createDataFrame(rows, "investor_id INT, datetime TIMESTAMP, block_number INT, balance DOUBLE")
    lo, hi = at(0), at(6500)
    got = {r["datetime"]: r["investor_count"] for r in portfolio.exact_holders(df, "4hour", F.lit(lo), F.lit(hi)).collect()}
    want = {}
    for b in range(0, 6500, 240):
        state = {}
        for i, t, n, v in sorted(rows, key=lambda r: (r[1], r[2])):
            if t < at(b + 240):
                state[i] = v
        n = sum(v > 0 for v in state.values())
        if n:
            want[at(b)] = n
    assert got == want
