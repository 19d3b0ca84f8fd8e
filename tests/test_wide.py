"""Numbers of up to 93 digits against Python's."""

import random
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from tidemark.functions import wide
from tidemark.operators import transfers as tr


def numbers(seed=1):
    rng = random.Random(seed)
    edges = [0, 1, 2**24 - 1, 2**24, 2**24 + 1, 10**9, 10**18, 2**63, 2**128, 2**240, 2**255, 2**256 - 1]
    return edges + [rng.randrange(2 ** rng.randrange(1, 257)) for _ in range(60)]


def test_words_and_text(spark):
    known = numbers()
    df = spark.createDataFrame([(i, f"0x{n:064x}", str(n), i % 40) for i, n in enumerate(known)], "i int, w string, t string, d int")
    number, of_text = wide.from_word(F.col("w")), wide.from_text(F.col("t"))
    got = df.select(
        "i", "d", wide.text(number).alias("t"), wide.text(of_text, F.col("d")).alias("s"), wide.to_word(of_text).alias("w"),
        wide.to_double(number).alias("x"), wide.text(wide.negated(number), F.col("d")).alias("m"), wide.to_word(wide.negated(number)).alias("mw"),
    ).collect()
    getcontext().prec = 200
    for r in got:
        n = known[r.i]
        assert r.t == str(n) and r.w == f"0x{n:064x}" and abs(r.x - n) <= n * 1e-14
        assert Decimal(r.s) == Decimal(n).scaleb(-r.d) and len(r.s.partition(".")[2]) == r.d
        assert Decimal(r.m) == -Decimal(n).scaleb(-r.d)
        assert (r.mw is None) == (n > 0)


def test_sums_of_any_sign(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(5), rng.choice(numbers(i)) * rng.choice([1, -1])) for i in range(400)]
    rows += [(9, 2**255), (9, -(2**255)), (10, 2**256 - 1), (10, 2**256 - 1), (11, -1), (12, 2**255), (12, -(2**255) - 1)]
    df = spark.createDataFrame([(k, str(n)) for k, n in rows], "k int, t string").repartition(7)
    got = df.groupBy("k").agg(wide.total(wide.from_text(F.col("t"))).alias("n"))
    got = got.select("k", wide.text(F.col("n")).alias("t"), wide.is_zero(wide.normalised(F.col("n"))).alias("zero"), wide.to_double(F.col("n")).alias("x"))
    want = {}
    for k, n in rows:
        want[k] = want.get(k, 0) + n
    for r in got.collect():
        assert int(r.t) == want[r.k] and r.zero == (want[r.k] == 0)
        assert abs(r.x - want[r.k]) <= abs(want[r.k]) * 1e-14


def test_text_of_fractions_and_what_does_not_fit(spark):
    rows = ["1.5", "-0.000001", "-12.340", "0", "00012", "7.", "1.1234567", "", "x", "1e5", None, "9" * 93, "9" * 95, "-", "--1", " 1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    got = {rows[r.i]: r.n for r in df.select("i", wide.text(wide.from_text(F.col("t"), 6)).alias("n")).collect()}
    want = {"1.5": "1500000", "-0.000001": "-1", "-12.340": "-12340000", "0": "0", "00012": "12000000", "7.": "7000000"}
    assert {k: v for k, v in got.items() if v is not None} == want
    whole = df.select(wide.text(wide.from_text(F.col("t"))).alias("n"), "t").where("length(t) > 90").collect()
    assert {r.t: r.n for r in whole} == {"9" * 93: "9" * 93, "9" * 95: None}
    odd = spark.createDataFrame([(w,) for w in ["0x12", None, "", "0x" + "g" * 64, "0X" + "0" * 64, "0x" + "0" * 65]], "w string")
    assert all(r.n is None for r in odd.select(wide.text(wide.from_word(F.col("w"))).alias("n")).collect())


def test_missing_amounts_show(spark):
    df = spark.createDataFrame([(1, "5"), (1, None), (2, "7"), (3, None)], "k int, t string")
    got = df.groupBy("k").agg(wide.total(wide.from_text(F.col("t"))).alias("n")).select("k", wide.text(F.col("n")).alias("t"))
    assert {r.k: r.t for r in got.collect()} == {1: None, 2: "7", 3: None}


def _events(spark, rows):
    """(product, log index, kind, from, to, amount) as usable events."""
    full = [("c", f"0xt{p}", p, 18, False, i, 10 + i // 3, f"h{i}", kind, a, b, f"0x{n:064x}") for p, i, kind, a, b, n in rows]
    columns = "chain string, address string, product_id int, decimals int, removed boolean, log_index long, block_number long, transaction_hash string"
    df = spark.createDataFrame(full, f"{columns}, event_name string, first_party string, second_party string, w string")
    return df.withColumn("amount", wide.from_word(F.col("w")))


def test_transfers_of_two_to_the_255_net_out(spark):
    big = 2**255
    rows = [(0, 0, "Transfer", "a", "b", big), (0, 1, "Transfer", "b", "a", big), (0, 2, "Transfer", "a", "a", big), (0, 3, "Staked", "c", None, big)]
    rows += [(0, 4, "Withdrawn", "c", None, big - 1), (0, 5, "Staked", "d", None, big), (0, 6, "Staked", "d", None, big), (0, 7, "Withdrawn", "e", None, big)]
    legs = tr.to_wide_legs(_events(spark, rows))
    netted = tr.net_wide(legs, ["owner_address"])
    got = {r.owner_address: (r.t, r.transaction_hash) for r in netted.withColumn("t", wide.text(F.col("amount_transferred"))).collect()}
    assert got == {"c": ("1", "h4"), "d": (str(2 * big), "h6"), "e": (str(-big), "h7")}
    held = tr.wide_running_balance(legs.where("owner_address = 'c' OR owner_address = 'd'"), ["owner_address"], ["log_index"], F.floor(F.col("log_index") / 2))
    got = {r.log_index: r.t for r in held.select("log_index", wide.text(F.col("balance")).alias("t")).collect()}
    assert got == {3: str(big), 4: "1", 5: str(big), 6: str(2 * big)}


def test_sums_combine_before_the_shuffle(spark):
    legs = tr.to_wide_legs(_events(spark, [(0, i, "Transfer", "a", "b", 2**200 + i) for i in range(50)]))
    plan = tr.net_wide(legs, ["owner_address"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1


def test_digits_are_worked_out_by_batches_of_rows(spark):
    # by lambdas over arrays of limbs they took some tenths of a millisecond a row
    read = spark.range(3).select(wide.from_text(F.col("id").cast("string")).alias("n"))
    shown = read.select(wide.text(F.col("n"), 2).alias("t"), wide.to_double(F.col("n")).alias("d"), wide.to_word(F.col("n")).alias("w"))
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambdafunction" not in plan
    assert [tuple(r) for r in shown.collect()] == [(f"0.0{i}", float(i), f"0x{i:064x}") for i in range(3)]


def test_a_full_limb_fails_the_job(spark):
    full = F.struct(*(F.lit(2**63 - 1 if f in wide.FIELDS[:2] else 0).cast("bigint").alias(f) for f in wide.FIELDS))
    with pytest.raises(Exception, match="full"):
        spark.range(1).select(wide.text(full)).collect()
