"""Upserts, decoding, definitions, monitoring."""

import json
import os
import random
from datetime import datetime
from decimal import Context, Decimal, localcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions import evm
from tidemark.operators import json_merge, transfers, upsert
from tidemark.plans import dims, monitoring, portfolio, tvl, valuation

T = [datetime(2024, 1, d) for d in range(1, 32)]


def test_upsert_policies(spark):
    schema = "k INT, r STRING, n STRING, e STRING"
    stored = spark.createDataFrame([(1, "a", "a", "a"), (2, "b", "b", None), (3, "c", "c", "c")], schema)
    batch = spark.createDataFrame([(1, None, None, "z"), (2, "y", "y", "y"), (4, "x", None, "x")], schema)
    got = upsert.upsert(stored, batch, ["k"], {"n": upsert.NEW_NON_NULL, "e": upsert.EXISTING_NON_NULL}).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, None, "a", "a"), (2, "y", "y", "y"), (3, "c", "c", "c"), (4, "x", None, "x")]


def test_conflicts_are_null_safe(spark):
    rows = [(1, 1.0, None), (1, 1.0, None), (2, 1.0, None), (2, 1.0, 5.0), (3, 1.0, 2.0), (3, 2.0, 2.0)]
    batch = spark.createDataFrame(rows, "k INT, a DOUBLE, b DOUBLE")
    assert sorted(r["k"] for r in upsert.find_conflicts(batch, ["k"], ["a", "b"]).collect()) == [2, 3]


def test_surrogate_ids_are_stable_and_dense(spark):
    stored = spark.createDataFrame([(7, "a"), (3, "b")], "id INT, name STRING")
    batch = spark.createDataFrame([(n,) for n in ["a", "c", "d", "c", *[f"n{i}" for i in range(500)]]], "name STRING")
    got = [r["id"] for r in upsert.assign_ids(stored, batch, "name", "id").collect()]
    assert sorted(got) == list(range(8, 8 + 502))


def test_merge_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "d1", 1.0), (2, "d2", 2.0)]
    upsert.merge_into_partitions(spark, path, spark.createDataFrame(rows, "k INT, day STRING, v DOUBLE"), ["k", "day"], "day")
    before = os.listdir(f"{path}/day=d1")
    new = spark.createDataFrame([(2, "d2", 9.0), (3, "d2", 3.0), (4, "d3", 4.0)], "k INT, day STRING, v DOUBLE")
    upsert.merge_into_partitions(spark, path, new, ["k", "day"], "day")
    assert os.listdir(f"{path}/day=d1") == before
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1.0), (2, 9.0), (3, 3.0), (4, 4.0)]


MERGES = [
    ('{"a":1}', '{"b":2}', {"a": 1, "b": 2}),
    ('{"a":{"x":1,"y":2}}', '{"a":{"y":3,"z":null}}', {"a": {"x": 1, "y": 3, "z": None}}),
    ('{"a":[1,2]}', '{"a":[3]}', {"a": [1, 2, 3]}),
    ('{"a":[]}', '{"a":[3]}', {"a": [3]}),
    ('{"a":[1]}', '{"a":{"b":1}}', {"a": [1, {"b": 1}]}),
    ('{"a":{"b":{"c":{"d":1}}}}', '{"a":{"b":{"c":{"e":2}}}}', {"a": {"b": {"c": {"d": 1, "e": 2}}}}),
    ('{"a":1}', '{"a":{"b":1}}', {"a": {"b": 1}}),
    ('{"a":{"b":{"c":{"d":{"x":1}}}}}', '{"a":{"b":{"c":{"d":{"y":2}}}}}', {"a": {"b": {"c": {"d": {"x": 1, "y": 2}}}}}),
    ('{"a":"q\\"u","k\\"y":"x"}', "{}", {"a": 'q"u', 'k"y': "x"}),
    (None, '{"a":1}', {"a": 1}),
    ('{"a":1}', None, {"a": 1}),
]


def merged(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i INT, a STRING, b STRING")
    return {r["i"]: r["m"] for r in json_merge.merge_column(df, ["i"], "a", "b", "m").collect()}


def merge_by_hand(a, b):
    if isinstance(a, dict) and isinstance(b, dict):
        return {k: merge_by_hand(a[k], b[k]) if k in a and k in b else a.get(k, b.get(k)) for k in a | b}
    if a == b and type(a) is type(b):
        return a
    return a + (b if isinstance(b, list) else [b]) if isinstance(a, list) else b


def test_json_merge(spark):
    got = merged(spark, [m[:2] for m in MERGES])
    assert {i: json.loads(m) for i, m in got.items()} == {i: w for i, (_, _, w) in enumerate(MERGES)}


def test_json_merge_of_texts_that_are_no_objects(spark):
    pairs = [("[1]", "[2]"), ("[1]", '{"a":1}'), ("1", '{"a":1}'), ('{"a":1}', "1"), ("{}", "{}"), ("{ }", '{"a":{}}'), (None, None), ("null", "2"), ("2", "null")]
    assert merged(spark, pairs) == dict(enumerate(["[1,2]", '[1,{"a":1}]', '{"a":1}', "1", "{}", '{"a":{}}', None, "2", "null"]))


def random_json(rng, depth):
    kind = rng.choice(["object", "object", "object", "list", "leaf"]) if depth else "leaf"
    if kind == "object":
        return {rng.choice(['a', 'b', 'c"d', "e\\f", "ü", "{", ""]): random_json(rng, depth - 1) for _ in range(rng.randint(0, 4))}
    if kind == "list":
        return [random_json(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([None, True, 1, -2, "x", 'q"', "}{", "a,b"])


def test_json_merge_at_any_depth(spark):
    rng = random.Random(7)
    pairs = [(random_json(rng, d), random_json(rng, d)) for d in [1, 2, 4, 9, 15] * 30]
    for levels in (1, 7, 40, 60):
        deep = [{"x": 1, "same": [1]}, {"y": 2, "same": [1]}]
        for i in range(levels):
            deep = [{f"l{i}": deep[0], "a": [i]}, {f"l{i}": deep[1], "a": [i + 1]}]
        pairs.append(tuple(deep))
    got = merged(spark, [(json.dumps(a), json.dumps(b)) for a, b in pairs])
    for i, (a, b) in enumerate(pairs):
        assert json.loads(got[i]) == merge_by_hand(a, b), (a, b)


def test_rounds_follow_the_data(spark, monkeypatch):
    made = []
    real = json_merge.scratch_path
    monkeypatch.setattr(json_merge, "scratch_path", lambda *a: made.append(a) or real(*a))
    deep = lambda field, n: '{"k":' * n + field + "}" * n
    merged(spark, [(deep('{"x":1}', 40), deep('{"x":1}', 40)), ('{"a":1}', '{"a":2}')])
    assert len(made) == 1  # nothing differs further down
    merged(spark, [(deep('{"x":1}', 40), deep('{"y":1}', 40))])
    assert len(made) == 1 + -(-41 // json_merge.LEVELS)


def test_any_number_of_batches_fold_into_one_grouping(spark):
    schema = "k INT, r STRING, n STRING, e STRING, j STRING"
    stored = spark.createDataFrame([(1, "a", "a", None, '{"a":[1]}'), (2, "b", None, "b", None)], schema)
    first = spark.createDataFrame([(1, None, "x", "x", '{"a":[2],"b":1}'), (3, "y", None, None, "[1]")], schema)
    second = spark.createDataFrame([(1, "z", '{"a":3,"b":2}'), (2, "q", '{"c":1}')], "k INT, n STRING, j STRING")
    policies = {"n": upsert.NEW_NON_NULL, "e": upsert.EXISTING_NON_NULL, "j": upsert.MERGE_JSON}
    got = upsert.fold([stored, first, second], ["k"], policies)
    rows = {r["k"]: tuple(r)[1:] for r in got.collect()}
    assert rows == {1: (None, "z", "x", '{"a":[1,2,3],"b":2}'), 2: ("b", "q", "b", '{"c":1}'), 3: ("y", None, None, "[1]")}
    one_by_one = upsert.upsert(upsert.upsert(stored, first, ["k"], policies), second, ["k"], policies)
    assert {r["k"]: tuple(r)[1:] for r in one_by_one.collect()} == rows
    plan = upsert.fold([stored, first, second], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_amounts_that_do_not_fit(spark):
    cases = [("-5", 1, True), ("-123456789", 4, True), (str(10**34), 14, False), (str(-(10**34)), 14, False), (str(10**34 - 1), 14, True), (None, 3, True)]
    df = spark.createDataFrame([(i, a, d) for i, (a, d, _) in enumerate(cases)], "i INT, a STRING, d INT").withColumn("a", F.col("a").cast("decimal(38,0)"))
    fits = evm.fits_scaled(F.col("a"), F.col("d"))
    assert {r["i"]: r["f"] for r in df.select("i", fits.alias("f")).collect()} == {i: f for i, (*_, f) in enumerate(cases)}
    got = {r["i"]: r["v"] for r in df.filter(fits).select("i", evm.scaled(F.col("a"), F.col("d")).alias("v")).collect()}
    with localcontext(Context(prec=60)):
        assert got == {i: a and Decimal(a).scaleb(-d) for i, (a, d, f) in enumerate(cases) if f}
    with pytest.raises(Exception, match="CAST|NUMERIC"):
        df.filter("i = 2").select(evm.scaled(F.col("a"), F.col("d"))).collect()


def test_net_does_not_pass_over_a_missing_amount(spark):
    rows = [("c", "t", "o", 1, "0x1", 1, None), ("c", "t", "o", 1, "0x2", 2, Decimal(5))]
    legs = spark.createDataFrame(rows, "chain STRING, token_address STRING, owner_address STRING, block_number LONG, transaction_hash STRING, log_index LONG, amount_transferred DECIMAL(38,18)")
    assert [r["amount_transferred"] for r in transfers.net(legs).collect()] == [None]


def test_uint256(spark):
    values = [0, 1, 255, 10**18, 2**60, 2**60 - 1, 2**64, 2**120, 75 * 2**120 - 1, 75 * 2**120, 10**38, 2**255]
    df = spark.createDataFrame([(i, f"0x{v:064x}") for i, v in enumerate(values)], "i INT, w STRING")
    got = {r["i"]: r["v"] for r in df.select("i", evm.uint256(F.col("w")).alias("v")).collect()}
    assert got == {i: (Decimal(v) if v < 75 * 2**120 else None) for i, v in enumerate(values)}


def test_scaling_is_exact(spark):
    cases = [("123456789012345678", 18), ("1", 18), ("5", 0), ("1500000", 6), ("99999999999999999999", 2)]
    df = spark.createDataFrame([(a, d) for a, d in cases], "a STRING, d INT")
    got = [r["v"] for r in df.select(evm.scaled(F.col("a").cast("decimal(38,0)"), F.col("d")).alias("v")).collect()]
    assert got == [Decimal(a).scaleb(-d) for a, d in cases]


def test_net_transfers(spark):
    rows = [
        ("c", "t", "o", 1, "0x1", 1, Decimal(5)), ("c", "t", "o", 1, "0x2", 2, Decimal(-2)), ("c", "t", "o", 1, "0x3", 3, Decimal(0)),
        ("c", "t", "p", 1, "0x1", 1, Decimal(4)), ("c", "t", "p", 1, "0x2", 2, Decimal(-4)),
    ]
    legs = spark.createDataFrame(rows, "chain STRING, token_address STRING, owner_address STRING, block_number LONG, transaction_hash STRING, log_index LONG, amount_transferred DECIMAL(38,18)")
    got = transfers.net(legs).collect()
    assert [(r["owner_address"], r["amount_transferred"], r["transaction_hash"]) for r in got] == [("o", 3, "0x2")]


def literal_reduction(history, dates):
    acc = {}
    for v, date in enumerate(dates):
        present = {k: s for k, s in history[v].items()}
        for k, status in present.items():
            old = acc.get(k)
            acc[k] = ((old[0] if old else None) or date) if status == "eol" else None, v
        for k in acc:
            if k not in present:
                acc[k] = acc[k][0] or date, acc[k][1]
    return acc


def test_definition_reduction_matches_a_literal_one(spark):
    rng = random.Random(4)
    dates = T[:9]
    keys = [f"k{i}" for i in range(150)]
    history = [{k: rng.choice(["eol", "active", "active"]) for k in keys if rng.random() < 0.8} for _ in dates]
    rows = [(v, dates[v], k, s) for v, listed in enumerate(history) for k, s in listed.items()]
    definitions = spark.createDataFrame(rows, "n INT, version_date TIMESTAMP, k STRING, status STRING")
    versions = spark.createDataFrame(list(enumerate(dates)), "n INT, version_date TIMESTAMP")
    got = dims.newest_definitions(versions, definitions, ["k"], ["n"], F.col("status") == "eol").collect()
    want = literal_reduction(history, dates)
    assert {r["k"]: (r["eol_date"], r["version_date"]) for r in got} == {k: (e, dates[v]) for k, (e, v) in want.items()}


def test_boost_needs_its_vault(spark):
    vaults = spark.createDataFrame([("c", "v-eol", 1, 2)], "chain STRING, id STRING, price_feed_1_id INT, price_feed_2_id INT")
    boosts = spark.createDataFrame([("c", "v", "b1"), ("c", "gone", "b2")], "chain STRING, vault_id STRING, boost STRING")
    kept = dims.attach_boosts(boosts, vaults, require=False).orderBy("boost").collect()
    assert [(r["boost"], r["price_feed_1_id"]) for r in kept] == [("b1", 1), ("b2", None)]
    with pytest.raises(PySparkException, match="boost without its vault"):
        dims.attach_boosts(boosts, vaults).collect()


def test_unreferenced_feeds(spark):
    feeds = spark.createDataFrame([(1,), (2,), (3,)], "price_feed_id INT")
    products = lambda rows: spark.createDataFrame(rows, "price_feed_1_id INT, price_feed_2_id INT")
    count = lambda rows, **o: monitoring.unreferenced_feeds(feeds, products(rows), **o).count()
    assert count([(1, 2)]) == 1
    assert count([(1, None)]) == 0
    assert count([(1, None)], null_safe=True) == 2


def test_readiness(spark):
    states = spark.createDataFrame([("k", 10, 100)], "import_key STRING, contract_created_at_block LONG, chain_latest_block_number LONG")
    ranges = spark.createDataFrame([("k", "retry", 60, 70)], "import_key STRING, kind STRING, from LONG, to LONG")
    portfolio.check_ready(states, ranges, 50)
    for block, later in ((5, True), (200, True), (80, True), (50, False)):
        with pytest.raises(portfolio.NotReady):
            portfolio.check_ready(states, ranges, block, later)
    with pytest.raises(portfolio.NotReady):
        portfolio.check_ready(states.limit(0), ranges, 50)


def test_tvl_of_product(tables):
    args = (tables.vault_stats, tables.products, tables.price_1d)
    assert tvl.tvl_of_product(*args, 1, T[0], T[6]).count() > 0
    with pytest.raises(ValueError):
        tvl.tvl_of_product(*args, 1, T[0], T[10])
    with pytest.raises(ValueError):
        tvl.tvl_of_product(*args, 7, T[0], T[6])  # a boost
    with pytest.raises(ValueError):
        tvl.tvl_of_product(*args, 11, T[0], T[6])  # retired


def test_snapshot_readings_need_exactly_one_answer(spark):
    asked = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "product_id INT, snapshot_block LONG")
    read = spark.createDataFrame([(1, 5, 1.0), (2, 5, 1.0), (2, 5, 1.0), (3, 6, 1.0)], "product_id INT, block_number LONG, v DOUBLE")
    good, bad = valuation.match_readings(asked, read, ["product_id"])
    assert [r["product_id"] for r in good.collect()] == [1]
    assert sorted(r["product_id"] for r in bad.collect()) == [2, 3]


def test_protocols(spark):
    names = ["aave-eth-usdc", "beFTM", "TIDE", "solo"]
    df = spark.createDataFrame([(n,) for n in names], "o STRING").select(*dims.protocol_columns(F.col("o"), "tide", ["TIDE"]).values())
    assert [tuple(r) for r in df.collect()] == [("aave", "eth-usdc"), ("tide", "beFTM"), ("tide", "TIDE"), ("unknown", "solo")]


PRICES = "k INT, day STRING, v INT"


def stored_prices(spark, path):
    upsert.overwrite_partitions(spark.createDataFrame([(i, f"2024-01-{1 + i % 10:02}", i) for i in range(100)], PRICES), path, "day")


def test_merge_reads_and_rewrites_only_its_partitions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    stored_prices(spark, path)
    files = lambda: {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("day=")}
    before = files()
    read = []
    real = upsert.upsert
    monkeypatch.setattr(upsert, "upsert", lambda stored, *a: read.append(stored) or real(stored, *a))
    batch = spark.createDataFrame([(1, "2024-01-02", -1), (500, "2024-01-02", 5)], PRICES)
    upsert.merge_into_partitions(spark, path, batch, ["k", "day"], "day")
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-02" in plan.split("PartitionFilters: [")[1].split("]")[0]
    after = files()
    assert [d for d in after if after[d] != before.get(d)] == ["day=2024-01-02"]
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {i: i for i in range(100)} | {1: -1, 500: 5}


def test_merge_of_a_partition_without_a_value(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, None, 1), (2, None, 2), (3, "2024-01-01", 3)], PRICES).write.partitionBy("day").parquet(path)
    batch = spark.createDataFrame([(9, None, 9), (3, "2024-01-01", 30)], PRICES)
    upsert.merge_into_partitions(spark, path, batch, ["k"], "day")
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {1: 1, 2: 2, 3: 30, 9: 9}


@pytest.mark.parametrize("at", ["before", "within", "after"])
def test_a_killed_overwrite_repeats_to_the_same_table(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "t")
    stored_prices(spark, path)
    batch = spark.createDataFrame([(i, f"2024-01-{1 + i % 10:02}", -i) for i in range(30)], PRICES)
    real = upsert.overwrite_partitions

    def dies(df, *where):
        if at == "within":  # one partition is new, one is gone, the others are old
            real(df.filter("day = '2024-01-02'"), *where)
            root, fs = upsert._file_system(spark, f"{path}/day=2024-01-04")
            fs.delete(root, True)
        if at == "after":
            real(df, *where)
        raise KeyboardInterrupt

    monkeypatch.setattr(upsert, "overwrite_partitions", dies)
    with pytest.raises(KeyboardInterrupt):
        upsert.merge_into_partitions(spark, path, batch, ["k", "day"], "day")
    monkeypatch.setattr(upsert, "overwrite_partitions", real)
    want = {i: -i if i < 30 else i for i in range(100)}
    read = lambda: {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    if at == "before":
        assert read() == {i: i for i in range(100)}
    for _ in range(2):
        upsert.finish_merge(spark, path, "day")
        assert read() == want
    upsert.merge_into_partitions(spark, path, batch.withColumn("v", F.col("v") - 1), ["k", "day"], "day")
    assert read() == {i: -i - 1 if i < 30 else i for i in range(100)}


def test_a_merge_that_dies_before_its_copy_is_whole_has_changed_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    stored_prices(spark, path)
    batch = spark.createDataFrame([(1, "2024-01-02", 1)], PRICES).withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("lost"))).cast("int"))
    with pytest.raises(Exception, match="lost"):
        upsert.merge_into_partitions(spark, path, batch, ["k", "day"], "day")
    upsert.finish_merge(spark, path, "day")
    assert {r["k"]: r["v"] for r in spark.read.parquet(path).collect()} == {i: i for i in range(100)}


def test_rows_before_the_first_tick_ask_for_one_place(spark, monkeypatch):
    rows = spark.createDataFrame([(1, i, 10, 500 + i) for i in range(300)] + [(2, 0, 5, 7)], "price_feed_id INT, n INT, _need_from LONG, _need_to LONG")
    ranges = spark.createDataFrame([(1, 0, 600), (2, 6, 9)], "price_feed_id INT, `from` LONG, `to` LONG")
    seen, real = [], valuation.running
    monkeypatch.setattr(valuation, "running", lambda df, *a: seen.append(df.count()) or real(df, *a))
    got = valuation._inside_one_range(rows, ranges).groupBy("price_feed_id", "_is_green").count().collect()
    assert seen == [4]  # two places and two ranges, however many rows ask
    assert sorted(map(tuple, got)) == [(1, False, 199), (1, True, 101), (2, False, 1)]


def test_a_hot_feed_is_cut_into_cells(spark, monkeypatch):
    from tidemark.operators import asof

    rng, start = random.Random(8), datetime(2024, 1, 1)
    at = lambda: start.replace(day=rng.randint(1, 10), hour=rng.randrange(24), minute=rng.randrange(60), second=rng.randrange(60))
    feed = lambda i: 1 if i % 3 == 0 else rng.randint(2, 40)
    probes = spark.createDataFrame([(i, feed(i), at()) for i in range(3000)], "n INT, price_feed_id INT, datetime TIMESTAMP")
    ticks = spark.createDataFrame([(feed(i), at(), i, Decimal(i)) for i in range(3000)], "price_feed_id INT, datetime TIMESTAMP, block_number LONG, price DECIMAL(38,18)")
    largest, real = [], asof.running

    def spy(df, keys, order, cell, outputs):
        sizes = df.withColumn("_c", cell).groupBy(*keys, "_c").count()
        largest.append(sizes.agg(F.max("count")).first()[0])
        return real(df, keys, order, cell, outputs)

    monkeypatch.setattr(asof, "running", spy)
    assert asof.interpolated_price(probes, ticks).count() == 3000
    assert len(largest) == 2 and max(largest) < 40  # a third of the rows, 1000 probes and as many ticks, over 240 hours


def test_readings_are_matched_in_tasks_that_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_OF_A_TASK", 10)
    asked = spark.createDataFrame([(i, 7) for i in range(40)] + [(3, 7)], "product_id int, snapshot_block int")
    read = spark.createDataFrame([(i, 7, float(i)) for i in range(1, 40)] + [(5, 7, 0.0), (6, 8, 1.0)], "product_id int, block_number int, v double")
    good, bad = valuation.match_readings(asked, read, ["product_id"])
    assert good.rdd.getNumPartitions() == bad.rdd.getNumPartitions() == 9
    assert sorted(r.product_id for r in good.collect()) == sorted([*range(1, 5), 3, *range(6, 40)])
    assert sorted((r.product_id, r._answers or 0) for r in bad.collect()) == [(0, 0), (5, 2)]
