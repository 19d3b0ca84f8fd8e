"""First-in-first-out profit: worked steps, a real history, random lists against a literal loop."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.timegrid import cell
from tidemark.operators import fifo

SCHEMA = "k STRING, datetime TIMESTAMP, n INT, shares DECIMAL(38,18), price DOUBLE"


def trades(spark, lists):
    from decimal import Decimal

    start = datetime(2024, 1, 1)
    rows = [(k, start + timedelta(hours=7 * i), i, Decimal(str(s)), float(p)) for k, ts in lists.items() for i, (s, p) in enumerate(ts)]
    return spark.createDataFrame(rows, SCHEMA)


def report(spark, lists, price=None, hours=24):
    positions = fifo.pnl(trades(spark, lists), ["k"], ["datetime", "n"], cell(F.col("datetime"), hours))
    if price is not None:
        positions = fifo.unrealized(positions, F.lit(float(price)))
    return {r["k"]: r.asDict() for r in positions.collect()}


def test_steps(spark):
    buys = [(2, 10), (2, 15)]
    first = report(spark, {"x": buys[:1]}, 12)["x"]
    assert (first["realized_pnl"], first["unrealized_pnl"]) == (0, 4)
    assert report(spark, {"x": buys}, 15)["x"]["unrealized_pnl"] == 10
    assert report(spark, {"x": buys}, 17)["x"]["unrealized_pnl"] == 18
    sold = report(spark, {"x": [*buys, (-3, 20)]}, 20)["x"]
    assert (sold["realized_pnl"], sold["unrealized_pnl"]) == (25, 5)


# shares moved, share -> underlying rate, underlying -> USD price
HISTORY = [
    (20.27876253618866, 1.0072088101378458, 314.89874339460806),
    (0.6130937649548895, 1.0075970905895832, 347.50914177774484),
    (0.9812694933012761, 1.0079955733953208, 338.9687613836563),
    (1.3415799314318817, 1.0091310138565124, 357.83013067482005),
    (-23.214705725876705, 1.0109650927669185, 363.0589258226089),
    (29.516921045823203, 1.0181657075053454, 489.8806056476361),
]
RATE, USD = 1.021708071749255723, 477.57009640452765


def test_real_history(spark):
    lists = {"yield": [(s, r) for s, r, _ in HISTORY], "usd": [(s, r * u) for s, r, u in HISTORY]}
    close = lambda v: pytest.approx(v, abs=1e-10)
    y = report(spark, {"yield": lists["yield"]}, RATE)["yield"]
    assert y["remaining_shares"] == close(29.516921045823203)
    assert y["avg_entry_price"] == close(1.0181657075053454)
    assert y["realized_pnl"] == close(0.08361212681703376)
    assert y["unrealized_pnl"] == close(0.10455968570304802)
    u = report(spark, {"usd": lists["usd"]}, RATE * USD)["usd"]
    near = lambda v: pytest.approx(v, abs=1e-8)
    assert u["avg_entry_price"] == near(498.7796334423725)
    assert u["realized_pnl"] == near(1054.5381164228797)
    assert u["unrealized_pnl"] == near(-320.0345929693857)


def literal(ts):
    lots, realized = [], 0.0
    for shares, price in ts:
        if shares > 0:
            lots.append([shares, price])
        left = -shares
        while left > 0 and lots:
            sold = min(left, lots[0][0])
            realized += sold * (price - lots[0][1])
            left -= sold
            lots[0][0] -= sold
            if lots[0][0] == 0:
                lots.pop(0)
    return realized, sum(s for s, _ in lots), sum(s * p for s, p in lots)


@pytest.mark.parametrize("hours", [7, 100000])
def test_random_lists(spark, hours):
    rng = random.Random(hours)
    lists = {}
    for k in range(300):
        n = 400 if k == 0 else rng.randint(1, 12)
        lists[str(k)] = [(rng.choice([0, 1, 2, 3, 5, -1, -2, -4, -9]), rng.randint(1, 50)) for _ in range(n)]
    got = report(spark, lists, hours=hours)
    for k, ts in lists.items():
        realized, held, cost = literal(ts)
        row = got[k]
        assert (row["realized_pnl"], row["remaining_shares"], row["remaining_cost"]) == pytest.approx((realized, held, cost)), k
