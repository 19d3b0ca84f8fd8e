"""What must hold as tables grow: what plans broadcast, how rows are dealt out, and that whole tables are read."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.operators import json_merge
from tidemark.plans import coverage as cov
from tidemark.queries import REGISTRY
from tidemark.sources.standins import SCHEMAS, Tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["tvl_daily", "tvl_one_week", "tvl_growth", "tvl_growth_live", "tvl_growth_per_chain", "capture_daily", "capture_change", "midnight_staked_value"])
def test_products_are_not_broadcast_by_the_size_of_their_files(spark, name):
    plan = plan_of(REGISTRY[name].build(Tables(spark, SMALL)))
    joins = [line for line in plan.splitlines() if "Join" in line and "product_id" in line]
    assert joins and not any("Broadcast" in line for line in joins)


@pytest.fixture(scope="module")
def few_events(spark, tmp_path_factory):
    """Five holders of two products, in blocks above three fifths of the highest; a tick of each feed in the hour of the report."""
    path = str(tmp_path_factory.mktemp("few"))
    ticks = [(8 * n + 7, datetime(2024, 1, 20, 12, 10), 9, kind, 2.0, "{}") for n, kind in enumerate(["click", "error", "purchase", "signup", "view"])]
    held = [(80 + 8 * n + k, datetime(2024, 1, 15 - n), n, "view", float(n), "{}") for n in range(1, 6) for k in (0, 4)]
    rows = {
        "events": ticks + held,
        "part": [(key, "part", "brand", "type", 1, 1.0) for key in (0, 4)],
        "customer": [(n, "name", 0, 1.0, "segment") for n in range(1, 6)],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, SCHEMAS[name]).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize(
    ("name", "products"),
    [("balances_at_block", [1, 5]), ("balances_at_block_unpriced", [1, 5]), ("chain_balances_at_block", [5]), ("points_balances_at_block", [1])],
)
def test_holders_of_the_newest_blocks_are_in_the_report(spark, few_events, name, products):
    found = {(r["product_id"], r["share_token_balance"]) for r in REGISTRY[name].run(spark, few_events).collect()}
    assert found == {(p, float(n)) for p in products for n in range(1, 6)}


@pytest.mark.parametrize("name", ["long_hex_round_trip", "usable_definitions", "newest_definitions"])
def test_rows_that_grow_on_the_way_are_dealt_out_first(spark, name):
    assert "REPARTITION_BY_NUM" in plan_of(REGISTRY[name].build(Tables(spark, SMALL)))


def test_the_scope_meets_its_steps_dealt_out(spark):
    # by chain, of which there are few, it would lie in as many tasks
    tables = Tables(spark, SMALL)
    scope = tables.states.select("import_key", "product_id", "chain")
    plan = plan_of(cov.sampled_points(scope, tables.blocks))
    assert "REPARTITION_BY_NUM" in plan and "BroadcastHashJoin [chain" in plan


def test_texts_of_one_file_are_merged_by_many_tasks(spark):
    rows = spark.range(40).select("id", F.lit('{"a":{"b":1}}').alias("old"), F.lit('{"a":{"c":2}}').alias("new"))
    found = json_merge.leaves(rows.coalesce(1), ["id"], "old", "new")
    assert len(found.inputFiles()) > 1 and found.count() == 80
