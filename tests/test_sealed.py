"""Sealed rollups and bucketed tables."""

import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.operators.ohlc import rollup
from tidemark.queries import prices, watch
from tidemark.sources.standins import Tables
from tidemark.streaming import sealed

TICKS = "datetime TIMESTAMP, price_feed_id INT, block_number LONG, price DECIMAL(38,18)"
START = datetime(2024, 1, 1)
COLUMNS = ["price_feed_id", "datetime", "price_avg", "price_high", "price_low", "price_open", "price_close"]


def deliveries(seed, n=9, rows=80):
    """Files of ticks that move on by five hours each; one tick in six is up to three days late."""
    rng = random.Random(seed)
    late = lambda: timedelta(hours=rng.randrange(72)) if rng.random() < 1 / 6 else timedelta(0)
    at = lambda i: START + timedelta(days=3, hours=5 * i, minutes=rng.randrange(300)) - late()
    return [[(at(i), rng.randint(1, 3), 1000 * i + k, Decimal(rng.randint(1, 999))) for k in range(rows)] for i in range(n)]


def land(spark, rows, folder, name):
    spark.createDataFrame(rows, TICKS).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, folder, path, checkpoint, every):
    ticks = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    sealed.write(ticks, path, checkpoint, "1hour", "4hour", every=every).awaitTermination()


def rows_of(df):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("every", [1, 3])
def test_many_batches_with_late_ticks(spark, tmp_path, every):
    folder, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp")
    files, final = deliveries(1), {}
    for i, rows in enumerate(files):
        land(spark, rows, folder, f"f{i}")
        run(spark, folder, path, checkpoint, every)  # one run per delivery goes on from the checkpoint
        number, mark = sealed._mark(spark, path)
        closed = sealed._table(spark, path, sealed.SEALED).filter(F.col("batch") <= number).collect()
        now = {(r.price_feed_id, r.bucket): r for r in closed}
        assert len(now) == len(closed) and all(now[k] == r for k, r in final.items())  # written once
        assert mark is None or all(b < mark for _, b in now)
        final = now
        kept = sealed._not_sealed(spark, path, number).groupBy(*sealed.KEYS).count().agg(F.max("count")).first()[0]
        assert kept is None or kept <= every + 1
    assert final
    everything = spark.createDataFrame([r for f in files for r in f], TICKS)
    late = sealed.late_counts(spark, path).agg(F.sum("late_ticks")).first()[0]
    assert late > 20
    assert rows_of(sealed.read(spark, path, with_late=True)) == rows_of(rollup(everything, "1hour"))
    on_time = sum(r["price_count"] for r in sealed._table(spark, path, sealed.SEALED).unionByName(sealed._not_sealed(spark, path, number)).collect())
    assert on_time + late == sum(map(len, files))
    assert len([d for d in os.listdir(f"{path}/open") if d.startswith("batch=")]) <= 2


@pytest.mark.parametrize("dies_at", [sealed.LATE, sealed.SEALED, sealed.OPEN, sealed.MARKS])
def test_a_seal_that_dies_is_repeated(spark, tmp_path, monkeypatch, dies_at):
    folder, files = str(tmp_path / "in"), deliveries(2, 6)
    for i, rows in enumerate(files):
        land(spark, rows, folder, f"f{i}")
    path, checkpoint, real, left = str(tmp_path / "t"), str(tmp_path / "cp"), sealed.overwrite_partitions, [3]

    def dies(df, where, column):
        if where.endswith(dies_at):
            left[0] -= 1
            if left[0] == 0:
                raise RuntimeError("lost")
        real(df, where, column)

    monkeypatch.setattr(sealed, "overwrite_partitions", dies)
    with pytest.raises(Exception, match="lost"):
        run(spark, folder, path, checkpoint, 2)
    whole = rows_of(sealed.read(spark, path, with_late=True))
    assert whole  # what stands is readable
    run(spark, folder, path, checkpoint, 2)
    want = rollup(spark.createDataFrame([r for f in files for r in f], TICKS), "1hour")
    assert rows_of(sealed.read(spark, path, with_late=True)) == rows_of(want)


def test_joins_and_roll_ups_on_bucketed_tables_move_no_row(spark):
    t = Tables(spark, SMALL)
    for df in (prices.bucketed_tick_join(t), watch.bucketed_tvl(t), watch.bucketed_tvl(t).groupBy("price_feed_2_id", "datetime").count()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert df.count() > 0
