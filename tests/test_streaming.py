"""Streams over files landing one by one, against the same computation in batch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.timegrid import cell
from tidemark.operators import fifo
from tidemark.operators.latest import last_by
from tidemark.operators.ohlc import rollup
from tidemark.streaming import positions, rollups

TICKS = "datetime TIMESTAMP, price_feed_id INT, block_number LONG, price DECIMAL(38,18)"
TRADES = "investor_id INT, product_id INT, datetime TIMESTAMP, block_number LONG, shares DOUBLE, price DOUBLE"
START = datetime(2024, 1, 1)


def land(spark, rows, schema, folder, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def ticks(rng, n, first_hour, last_hour, base):
    from decimal import Decimal

    minutes = lambda: rng.randint(first_hour * 60, last_hour * 60 - 1)
    return [(START + timedelta(minutes=minutes(), seconds=i % 60), rng.randint(1, 3), base + i, Decimal(rng.randint(1, 999))) for i in range(n)]


def test_rollup_over_several_deliveries(spark, tmp_path):
    rng = random.Random(1)
    landing, table, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    everything = []
    for i in range(3):
        rows = ticks(rng, 200, i * 5, i * 5 + 8, i * 1000)
        everything += rows
        land(spark, rows, TICKS, landing, f"f{i}")
        # one run per delivery: the next run continues from the checkpoint
        rollups.write_rollup(rollups.stream_rollup(stream(spark, TICKS, landing), "1hour"), table, checkpoint).awaitTermination()
    want = rollup(spark.createDataFrame(everything, TICKS), "1hour")
    columns = ["price_feed_id", "datetime", "price_avg", "price_high", "price_low", "price_open", "price_close"]
    key = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert key(spark.read.parquet(table)) == key(want)


def test_late_ticks_wait_for_a_refresh(spark, tmp_path):
    rng = random.Random(2)
    landing, table, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    run = lambda: rollups.write_rollup(rollups.stream_rollup(stream(spark, TICKS, landing), "1hour", "2 hours"), table, checkpoint).awaitTermination()
    first, late = ticks(rng, 100, 0, 20, 0), ticks(rng, 50, 1, 3, 5000)
    land(spark, first, TICKS, landing, "f0")
    run()
    before = spark.read.parquet(table).count()
    land(spark, late, TICKS, landing, "f1")
    run()
    columns = ["price_feed_id", "datetime", "price_avg"]
    key = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert key(spark.read.parquet(table)) == key(rollup(spark.createDataFrame(first, TICKS), "1hour")) and before > 0
    everything = spark.createDataFrame(first + late, TICKS)
    rollups.refresh_range(spark, everything, table, "1hour", START + timedelta(hours=1), START + timedelta(hours=3))
    assert key(spark.read.parquet(table)) == key(rollup(everything, "1hour"))


@pytest.mark.parametrize("lateness_hours", [0, 6])
def test_positions_apply_in_time_order(spark, tmp_path, lateness_hours):
    rng = random.Random(lateness_hours)
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = []
    for i in range(240):
        rows.append((i % 4, i % 2, START + timedelta(minutes=10 * i), i, float(rng.choice([3, 2, 1, -1, -2, -5])), float(rng.randint(1, 9))))
    # deliveries overlap in time by less than the lateness
    shuffled = sorted(rows, key=lambda r: r[2] + timedelta(minutes=rng.randint(0, lateness_hours * 50)))
    for i in range(4):
        land(spark, shuffled[i * 60 : (i + 1) * 60], TRADES, landing, f"f{i}")
    after = positions.positions(stream(spark, TRADES, landing), f"{lateness_hours} hours")
    with positions.rocksdb(spark):
        writer = after.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out)
    # what lies within the lateness of the newest event still waits
    reached = [r for r in rows if r[2] <= rows[-1][2] - timedelta(hours=lateness_hours)]
    assert got.count() == len(reached)
    batch = spark.createDataFrame(reached, TRADES)
    keys = ["investor_id", "product_id"]
    want = fifo.pnl(batch, keys, ["datetime", "block_number"], cell(F.col("datetime"), 5)).collect()
    last = got.groupBy(*keys).agg(*[last_by(c, "datetime", "block_number").alias(c) for c in ("realized_pnl", "remaining_shares", "remaining_cost")])
    got = {(r[0], r[1]): (r["realized_pnl"], r["remaining_shares"], r["remaining_cost"]) for r in last.collect()}
    assert got == {(r[0], r[1]): pytest.approx((r["realized_pnl"], r["remaining_shares"], r["remaining_cost"])) for r in want}


def in_files(spark, rows, schema, folder, n=20):
    """The rows as a folder of files, the newest rows landing first."""
    ordered = sorted(rows, key=lambda r: r[schema.split(", ").index("datetime TIMESTAMP")], reverse=True)
    for i in range(n):
        part = ordered[i * len(ordered) // n : (i + 1) * len(ordered) // n]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/f{i:02}")


def test_partials_do_not_depend_on_the_order_of_files(spark, tmp_path):
    rows = ticks(random.Random(3), 600, 0, 400, 0)
    landing, table, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    in_files(spark, rows, TICKS, landing)
    rollups.write_partials(stream(spark, TICKS, landing), "1day", table, checkpoint).awaitTermination()
    columns = ["price_feed_id", "datetime", "price_avg", "price_high", "price_low", "price_open", "price_close"]
    key = lambda df: sorted(tuple(r) for r in df.select(*columns).withColumn("price_avg", F.round("price_avg", 9)).collect())
    want = key(rollup(spark.createDataFrame(rows, TICKS), "1day"))
    assert key(rollups.read_partials(spark, table)) == want
    # a batch that is delivered again replaces its own parts
    again = str(tmp_path / "cp2")
    rollups.write_partials(stream(spark, TICKS, landing), "1day", table, again).awaitTermination()
    assert key(rollups.read_partials(spark, table)) == want


def test_keys_are_kept_once_whatever_the_order_of_files(spark, tmp_path):
    rows = [(START + timedelta(minutes=rng_minutes), i % 3, i // 4) for i, rng_minutes in enumerate(random.Random(4).sample(range(50_000), 800))]
    schema = "datetime TIMESTAMP, chain INT, block LONG"
    landing, table = str(tmp_path / "in"), str(tmp_path / "out")
    in_files(spark, rows, schema, landing)
    for checkpoint in ("cp", "cp2"):
        rollups.write_once(stream(spark, schema, landing), table, str(tmp_path / checkpoint), ["chain", "block"], F.floor(F.col("block") / 50)).awaitTermination()
        got = sorted((r["chain"], r["block"]) for r in spark.read.parquet(table).collect())
        assert got == sorted({(c, b) for _, c, b in rows})


def test_positions_are_complete_whatever_the_order_of_files(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i % 6, i % 2, START + timedelta(minutes=7 * i, microseconds=i), i, float(rng.choice([3, 2, 1, -1, -2, -5])), float(rng.randint(1, 9))) for i in range(300)]
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    in_files(spark, rows, TRADES, landing)
    with positions.rocksdb(spark):
        writer = positions.positions(stream(spark, TRADES, landing), "0 seconds").writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    trades = spark.createDataFrame(rows, TRADES)
    stored = spark.read.schema(positions.OUTPUT).parquet(out)
    assert stored.count() < len(rows)  # the late ones are not there
    keys, columns = ["investor_id", "product_id"], ["balance", "realized_pnl", "remaining_shares", "remaining_cost"]
    want = fifo.pnl(trades, keys, ["datetime", "block_number"], cell(F.col("datetime"), 5)).join(trades.groupBy(*keys).agg(F.sum("shares").alias("balance")), keys)
    got = positions.complete(stored, trades, cell(F.col("datetime"), 5))
    by = lambda df: {(r[0], r[1]): pytest.approx([float(r[c]) for c in columns]) for r in df.collect()}
    assert {k: list(v.expected) for k, v in by(got).items()} == by(want)


def test_registered_streams_read_a_folder_of_files(spark, tmp_path):
    import shutil

    from tidemark.queries import REGISTRY

    from .conftest import SMALL

    folder = tmp_path / "tables"
    folder.mkdir()
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    ordered = events.orderBy(F.desc("ts")).coalesce(1)
    ordered.write.option("maxRecordsPerFile", max(1, events.count() // 20 + 1)).parquet(f"{folder}/events.parquet")
    for name in ("part", "customer", "nation", "region"):
        shutil.copy(f"{SMALL}/{name}.parquet", folder / f"{name}.parquet")
    for name in ("stream_rollup_1h", "stream_rollup_1d", "stream_blocks_once", "stream_load_prices", "stream_positions"):
        one = sorted(map(str, REGISTRY[name].run(spark, SMALL).collect()))
        assert sorted(map(str, REGISTRY[name].run(spark, str(folder)).collect())) == one, name


def test_scratch_folders_are_cleared(spark, tmp_path):
    import os

    from tidemark import session

    session.clear_scratch(spark)
    path = session.scratch_path(spark, "any")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert session.clear_scratch(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
