"""Coverage windows, import planning and result folding: worked examples."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals
from tidemark.plans import coverage as cov


def ranges(spark, covered=(), retry=(), key="k"):
    rows = [(key, "covered", a, b) for a, b in covered] + [(key, "retry", a, b) for a, b in retry]
    return spark.createDataFrame(rows, "import_key STRING, kind STRING, from LONG, to LONG")


def windows(spark, *pairs):
    return spark.createDataFrame([("k", a, b) for a, b in pairs], "import_key STRING, from LONG, to LONG")


PLANS = [
    ([(1, 1000)], [(900, 1000)], [(901, 909)], 100, 10,
     [(800, 899), (700, 799), (600, 699), (500, 599), (400, 499), (300, 399), (200, 299), (100, 199), (1, 99), (901, 909)]),
    ([(1, 1000)], [(900, 1000)], [(901, 909)], 10, 10, [(890 - 10 * i, 899 - 10 * i) for i in range(10)]),
    ([(1, 1000)], [(900, 1000)], [(901, 909)], 500, 3, [(400, 899), (1, 399), (901, 909)]),
    ([(1, 500), (501, 1000)], [(900, 950), (920, 1000)], [(901, 909)], 500, 3, [(400, 899), (1, 399), (901, 909)]),
    ([(500, 1000)], [(900, 1000)], [(850, 860)], 100, 6,
     [(861, 899), (750, 849), (650, 749), (550, 649), (500, 549), (850, 860)]),
]


@pytest.mark.parametrize("full,covered,retry,length,limit,want", PLANS)
def test_import_plan(spark, full, covered, retry, length, limit, want):
    plan = cov.plan_import(windows(spark, *full), ranges(spark, covered, retry), length, limit, cell_width=64)
    assert [(r["from"], r["to"]) for r in plan.orderBy("rank").collect()] == want


def one_window(spark, created=None, latest=100, last_imported=None, **options):
    states = spark.createDataFrame([("k", created, last_imported)], "import_key STRING, contract_created_at_block LONG, seen LONG")
    options = {"historical": False, "max_blocks_per_query": 10, "ms_per_block": 1000, **options}
    row = cov.window_to_consider(states, F.lit(latest).cast("long"), last_imported=F.col("seen"), **options).first()
    return row["from"], row["to"]


def test_recent_windows(spark):
    assert one_window(spark) == (85, 95)
    assert one_window(spark, latest=200, lag=30) == (160, 170)
    assert one_window(spark, created=1, latest=200, lag=30, max_blocks_per_query=100) == (70, 170)
    assert one_window(spark, last_imported=90, max_blocks_per_query=100) == (91, 95)
    big = one_window(spark, latest=100_000_000, last_imported=100_000, max_blocks_per_query=100_000)
    assert big == (100_000_000 - 86400 - 5, 100_000_000 - 5)


def test_historical_windows(spark):
    base = dict(created=1, latest=200, historical=True)
    assert one_window(spark, latest=200, historical=True) == (185, 195)
    assert one_window(spark, **base) == (1, 195)
    assert one_window(spark, **base, skip_recent="all") == (1, 185)
    assert one_window(spark, **base, skip_recent="live", is_live=F.lit(True)) == (1, 185)
    assert one_window(spark, **base, skip_recent="live", is_live=F.lit(False)) == (1, 195)
    assert one_window(spark, **base, skip_recent="eol", is_live=F.lit(False)) == (1, 185)
    assert one_window(spark, **base, forced=(50, 100)) == (50, 100)
    with pytest.raises(ValueError):
        one_window(spark, **base, skip_recent="some")


def collect(df):
    return sorted((r["kind"], r["from"], r["to"]) for r in df.collect())


def test_update_ranges(spark):
    before = ranges(spark, [(1, 10), (20, 30)], [(5, 9), (22, 23)])
    w = lambda *p: windows(spark, *p)
    after = cov.update_ranges(before, w((11, 19), (31, 40)), w((5, 6)), w((31, 33)), cell_width=8)
    assert collect(after) == [("covered", 1, 40), ("retry", 7, 9), ("retry", 22, 23), ("retry", 31, 33)]


def test_fold_results(spark):
    states = spark.createDataFrame([("k", 50, None), ("other", 60, None)], "import_key STRING, chain_latest_block_number LONG, last_import_date TIMESTAMP")
    results = spark.createDataFrame(
        [("k", 1, 10, True, 55), ("k", 11, 20, False, 45), ("k", 15, 30, True, 70)],
        "import_key STRING, from LONG, to LONG, success BOOLEAN, latest LONG",
    )
    new_states, new_ranges = cov.fold_results(states, ranges(spark, [(0, 0)], [(5, 25)]), results, datetime(2024, 1, 1))
    assert {r[0]: r[1] for r in new_states.collect()} == {"k": 70, "other": 60}
    assert collect(new_ranges) == [("covered", 0, 30), ("retry", 11, 20)]
    assert [r[0] for r in cov.overlapping_results(results).collect()] == ["k"]


def test_schedule_reimport(spark):
    states = spark.createDataFrame([("k", 10, 50), ("new", 90, 60)], "import_key STRING, contract_created_at_block LONG, chain_latest_block_number LONG")
    after = cov.schedule_reimport(states, ranges(spark, [(10, 50)], [(12, 13)]), 5)
    assert collect(after) == [("covered", 10, 50), ("retry", 11, 50)]


def test_parents_fail_with_any_child(spark):
    items = spark.createDataFrame([(1,), (2,), (3,)], "p INT")
    children = spark.createDataFrame([(1, True), (1, False), (2, True)], "p INT, success BOOLEAN")
    got = {r["p"]: r["success"] for r in cov.parent_results(items, children, ["p"]).collect()}
    assert got == {1: False, 2: True, 3: True}


def test_slices_are_made_of_ranked_ranges(spark):
    # only ranges are ordered, of which there are far fewer
    plan = cov.plan_import(windows(spark, (1, 1000)), ranges(spark, [(900, 1000)], [(901, 909)]), 10, 50)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("explode(sequence(") < text.index("Window [")
    assert dict(plan.dtypes)["rank"] == "int"


def test_places_where_results_only_touch_are_not_swept(spark, monkeypatch):
    swept, real = [], intervals.running
    monkeypatch.setattr(intervals, "running", lambda df, *a, **k: swept.append(df.count()) or real(df, *a, **k))
    results = spark.range(500).select(
        F.lit("k").alias("import_key"), (F.col("id") * 10).alias("from"), (F.col("id") * 10 + 9).alias("to"),
        F.lit(True).alias("success"), F.lit(1).alias("latest"),
    )
    states = spark.createDataFrame([("k", 50, None)], "import_key STRING, chain_latest_block_number LONG, last_import_date TIMESTAMP")
    known = ranges(spark, [(0, 4)], [(100, 200), (6000, 6001)])
    _, after = cov.fold_results(states, known, results, datetime(2024, 1, 1), 64)
    assert collect(after) == [("covered", 0, 4999), ("retry", 6000, 6001)]
    assert sum(swept) < 10  # 0, 5, 100, 201, 5000, 6000 and 6002


def test_updates_treat_every_range_as_merge_and_combine_do(spark):
    # some end nowhere or before they start, some have no key, many are copies
    value = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n))
    some = lambda seed: spark.range(150).select(
        F.when(value(seed, 7) > 0, F.concat(F.lit("k"), value(seed, 7).cast("string"))).alias("import_key"),
        value(seed + 1, 300).alias("from"),
        F.when(value(seed + 2, 9) > 0, value(seed + 1, 300) + value(seed + 3, 25) - 5).alias("to"),
        F.when(value(seed + 4, 3) > 0, "covered").otherwise("retry").alias("kind"),
    )
    known, new, good, bad = some(1), some(11).drop("kind"), some(21).drop("kind"), some(31).drop("kind").limit(20)
    after = cov.update_ranges(known, new, good, bad, cell_width=16)
    rows = lambda df: sorted(map(str, df.collect()))
    covered = intervals.union(cov.of_kind(known, "covered"), new, ["import_key"], cell_width=16)
    sets = {"retry": cov.of_kind(known, "retry"), "succeeded": good, "failed": bad}
    queued = intervals.combine(sets, ["import_key"], lambda on: on["failed"] | (on["retry"] & ~on["succeeded"]), cell_width=16)
    assert covered.filter("`to` IS NULL").count() and covered.filter("`to` < `from`").count()
    assert rows(after.filter("kind = 'covered'").drop("kind")) == rows(covered)
    assert rows(after.filter("kind = 'retry'").drop("kind")) == rows(queued)
