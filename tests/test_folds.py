"""Positions folded trade by trade, some of them late, against all trades at once."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions.timegrid import cell
from tidemark.operators import fifo
from tidemark.streaming import folds

SCHEMA = "k STRING, datetime TIMESTAMP, n INT, shares DECIMAL(38,18), price DOUBLE"
START = datetime(2024, 1, 1)


def made(seed, n=240):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.4 else rng.choice("abcde")
    at = lambda: START + timedelta(hours=rng.randrange(24 * 8))
    return [(key(), at(), i, Decimal(rng.choice([1, 2, 3, 5, -1, -2, -4])), float(rng.randint(1, 50))) for i in range(n)]


def at_once(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    pnl = fifo.pnl(df, ["k"], ["datetime", "n"], cell(F.col("datetime"), 24)).join(df.groupBy("k").agg(F.sum("shares").alias("balance")), "k")
    return {r.k: (float(r.balance), *(pytest.approx(r[c]) for c in ("realized_pnl", "remaining_shares", "remaining_cost"))) for r in pnl.collect()}


def folded(spark, path, batches, again=()):
    come = []
    for n, rows in enumerate(batches):
        come += rows
        for _ in range(2 if n in again else 1):
            new, landed = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(come, SCHEMA)
            folds.fold(spark, path, new, landed, n, ["k"], ["datetime", "n"], cell(F.col("datetime"), 24))
    return {r.k: (float(r.balance), r.realized_pnl, r.remaining_shares, r.remaining_cost) for r in folds.positions(spark, path, ["k"]).collect()}


def test_days_in_their_order(spark, tmp_path):
    rows = made(1)
    days = [[r for r in rows if r[1].date() == (START + timedelta(days=d)).date()] for d in range(8)]
    assert folded(spark, str(tmp_path / "t"), days, again=(0, 5)) == at_once(spark, rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_late_trades_reopen_their_day(spark, tmp_path, seed):
    rows, rng = made(seed), random.Random(seed)
    on_time = [r for r in rows if rng.random() < 0.8]
    late = [r for r in rows if r not in on_time]
    batches = [[r for r in on_time if (r[1] - START).days // 2 == b] for b in range(4)]
    batches[2:2] = [[r for r in late[::2] if (r[1] - START).days < 4]]
    used = {r[2] for b in batches for r in b}
    batches.append([r for r in late if r[2] not in used])
    assert folded(spark, str(tmp_path / "t"), batches, again=(2,)) == at_once(spark, rows)


def test_trades_in_any_order(spark, tmp_path):
    rows = made(4, 90)
    random.Random(0).shuffle(rows)
    assert folded(spark, str(tmp_path / "t"), [rows[i::4] for i in range(4)]) == at_once(spark, rows)


def test_a_fold_reads_lots_and_new_trades_only(spark, tmp_path, monkeypatch):
    seen, real = [], fifo.inventory
    monkeypatch.setattr(folds.fifo, "inventory", lambda rows, *a: seen.append(rows.count()) or real(rows, *a))
    many = [("x", START + timedelta(minutes=i), i, Decimal(2 if i % 2 == 0 else -2), 1.0) for i in range(500)]
    open_ = [("x", START + timedelta(hours=20), 600 + i, Decimal(1), 1.0) for i in range(3)]
    later = [("x", START + timedelta(days=1), 700, Decimal(-1), 5.0), ("y", START + timedelta(days=1), 701, Decimal(1), 1.0)]
    got = folded(spark, str(tmp_path / "t"), [many + open_, later])
    assert seen == [503, 3 + 2]
    assert got["x"] == (2.0, 4.0, 2.0, 2.0)


def test_a_fold_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    rows, path, real = made(5, 120), str(tmp_path / "t"), folds.overwrite_partitions
    batches = [sorted(rows, key=lambda r: r[1])[i * 40 : i * 40 + 40] for i in range(3)]
    folded(spark, path, batches[:1])

    def dies(df, where, column):
        if where.endswith(folds.STATES):
            raise KeyboardInterrupt
        real(df, where, column)

    monkeypatch.setattr(folds, "overwrite_partitions", dies)
    with pytest.raises(KeyboardInterrupt):
        folds.fold(spark, path, spark.createDataFrame(batches[1], SCHEMA), spark.createDataFrame(batches[0] + batches[1], SCHEMA), 1, ["k"], ["datetime", "n"], cell(F.col("datetime"), 24))
    monkeypatch.setattr(folds, "overwrite_partitions", real)
    assert folded(spark, path, batches) == at_once(spark, rows)


def test_the_rows_of_a_fold_are_joined_once(spark, tmp_path, monkeypatch):
    rows = sorted(made(6, 60), key=lambda r: r[1])
    want, plans, real = at_once(spark, rows), [], fifo.inventory
    monkeypatch.setattr(folds.fifo, "inventory", lambda rows, *a: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or real(rows, *a))
    assert folded(spark, str(tmp_path / "t"), [rows[:30], rows[30:]]) == want
    assert len(plans) == 2 and not any("Join" in p for p in plans)


@pytest.mark.parametrize(("rows_of_a_task", "cut"), [(500_000, False), (10, True)])
def test_only_positions_too_large_for_a_task_are_cut_into_cells(spark, tmp_path, monkeypatch, rows_of_a_task, cut):
    monkeypatch.setattr(session, "ROWS_OF_A_TASK", rows_of_a_task)
    rows = sorted(made(7, 80), key=lambda r: r[1])
    want, plans, real = at_once(spark, rows), [], fifo.inventory

    def seen(*a):
        out = real(*a)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(folds.fifo, "inventory", seen)
    assert folded(spark, str(tmp_path / "t"), [rows[:40], rows[40:]]) == want
    assert ["Join" in p for p in plans] == [cut, cut]


def test_one_window_gives_what_cells_give(spark):
    rows = [*made(8, 200), ("a", START, 900, None, 1.0), (None, START, 901, Decimal(1), 1.0), ("z", START, 902, Decimal(-3), 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    columns = ["k", "n", "bought", "inventory", "inventory_before", "bought_before", "sold", "sold_before", "sold_in_all"]
    a, b = (fifo.inventory(df, ["k"], ["datetime", "n"], c).filter("shares IS NOT NULL").select(columns) for c in (cell(F.col("datetime"), 24), None))
    assert a.schema == b.schema and sorted(a.collect()) == sorted(b.collect())
