"""Coverage kept up to date by streams, against the same results folded in one go."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import upsert
from tidemark.plans import coverage as cov
from tidemark.plans import live_coverage as live

RANGES = "import_key STRING, kind STRING, `from` LONG, `to` LONG"
RESULTS = "import_key STRING, `from` LONG, `to` LONG, success BOOLEAN"


def made(seed, n=120):
    rng = random.Random(seed)
    key = lambda: "hot" if rng.random() < 0.4 else f"k{rng.randrange(4)}"
    def span():
        lo = rng.randrange(400)
        return lo, lo + rng.choice([0, 1, 5, 30, 200]) - (rng.random() < 0.05) * 10
    stored = [(key(), rng.choice(["covered", "covered", "retry"]), *span()) for _ in range(n // 4)]
    return stored, [(key(), *span(), rng.random() < 0.6) for _ in range(n)]


def folded(spark, stored, results):
    """What ``fold_results`` makes of all results at once."""
    frame = spark.createDataFrame(results, RESULTS).filter("`from` <= `to`").withColumn("latest", F.col("to"))
    states = spark.createDataFrame([], "import_key STRING, chain_latest_block_number LONG, last_import_date TIMESTAMP")
    known = spark.createDataFrame(stored, RANGES).filter("`from` <= `to`")
    _, ranges = cov.fold_results(states, known, frame, datetime(2024, 1, 1), 64)
    return sorted(map(tuple, ranges.select("import_key", "kind", "from", "to").collect()))


def read(spark, path, width):
    return sorted(map(tuple, live.ranges_of(live.parts_of(spark, path, width)).select("import_key", "kind", "from", "to").collect()))


@pytest.mark.parametrize("width", [16, 1000])
def test_a_stream_of_results_equals_one_fold_in_any_file_order(spark, tmp_path, width):
    stored, results = made(1)
    want = folded(spark, stored, results)
    for order in range(2):
        rng = random.Random(order)
        shuffled = rng.sample(results, len(results))
        path, landing = str(tmp_path / f"t{order}"), str(tmp_path / f"in{order}")
        live.add(spark, path, spark.createDataFrame(stored, RANGES), width)
        for i in range(3):
            spark.createDataFrame(shuffled[i::3], RESULTS).coalesce(1).write.mode("append").parquet(f"{landing}/f{i}")
        for checkpoint in ("a", "b"):  # delivered twice
            stream = spark.readStream.schema(RESULTS).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
            live.write_results(stream, path, str(tmp_path / f"cp{order}{checkpoint}"), width).awaitTermination()
        assert read(spark, path, width) == want


def test_a_batch_reads_and_rewrites_only_the_cells_it_touches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    live.add(spark, path, spark.createDataFrame([("a", "covered", 0, 999), ("b", "retry", 250, 320)], RANGES), 100)
    files = lambda: {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("cell=")}
    before, plans, real = files(), [], live._merged
    monkeypatch.setattr(live, "_merged", lambda parts, w: plans.append(parts._jdf.queryExecution().executedPlan().toString()) or real(parts, w))
    batch = spark.createDataFrame([("b", 290, 310, True), ("c", 305, 306, False)], RESULTS)
    live.add(spark, path, live.kinds_of(batch), 100)
    after = files()
    assert sorted(d for d in after if after[d] != before.get(d)) == ["cell=2", "cell=3"]
    scans = [p.split("PartitionFilters: [")[1].split("]")[0] for p in plans if "PartitionFilters: [" in p and "cell" in p]
    assert scans and all("cell" in s and ("2" in s and "3" in s) for s in scans)
    assert read(spark, path, 100) == [
        ("a", "covered", 0, 999), ("b", "covered", 290, 310), ("b", "retry", 250, 289), ("b", "retry", 311, 320),
        ("c", "covered", 305, 306), ("c", "retry", 305, 306),
    ]


def test_parts_inside_their_cells_take_no_part_in_putting_together(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", "covered", 1, 5), ("a", "covered", 8, 25), ("a", "covered", 30, 39), ("a", "covered", 41, 48), ("a", "covered", -15, -1)]
    live.add(spark, path, spark.createDataFrame(rows, RANGES), 10)
    parts = live.parts_of(spark, path, 10)
    assert parts.filter("NOT at_start AND NOT at_end").count() == 2
    assert [r[2:] for r in read(spark, path, 10)] == [(-15, -1), (1, 5), (8, 25), (30, 39), (41, 48)]


def test_settled_failures_can_succeed_later(spark, tmp_path):
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    live.add(spark, first, live.kinds_of(spark.createDataFrame([("a", 0, 49, True), ("a", 20, 29, False)], RESULTS)), 16)
    live.settle(spark, first, second, 16)
    assert read(spark, second, 16) == read(spark, first, 16) == [("a", "covered", 0, 49), ("a", "retry", 20, 29)]
    live.add(spark, second, live.kinds_of(spark.createDataFrame([("a", 22, 60, True)], RESULTS)), 16)
    assert read(spark, second, 16) == [("a", "covered", 0, 60), ("a", "retry", 20, 21)]


def test_a_batch_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    path, real = str(tmp_path / "t"), upsert.overwrite_partitions
    live.add(spark, path, spark.createDataFrame([("a", "covered", 0, 49)], RANGES), 10)

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(upsert, "overwrite_partitions", dies)
    with pytest.raises(KeyboardInterrupt):
        live.add(spark, path, spark.createDataFrame([("a", "covered", 45, 70)], RANGES), 10)
    monkeypatch.setattr(upsert, "overwrite_partitions", real)
    assert read(spark, path, 10) == [("a", "covered", 0, 70)]


def test_a_result_is_stored_once_and_covered_on_reading(spark, tmp_path):
    path = str(tmp_path / "t")
    results = spark.createDataFrame([("a", 0, 24, True), ("a", 25, 29, False), (None, 3, 4, None)], RESULTS)
    live.add(spark, path, live.kinds_of(results), 10)
    stored = spark.read.parquet(path)
    assert {r.kind for r in stored.collect()} == {live.SUCCEEDED, live.FAILED}
    got = [tuple(r) for r in live.ranges_of(live.parts_of(spark, path, 10)).select("import_key", "kind", "from", "to").collect()]
    assert sorted(got, key=str) == sorted([("a", "covered", 0, 29), ("a", "retry", 25, 29), (None, "covered", 3, 4), (None, "retry", 3, 4)], key=str)
