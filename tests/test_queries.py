"""Every registered query against its SQL, and the shape of every plan."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tidemark.queries import REGISTRY

from .conftest import SMALL

GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in GIVEN.split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def comparable(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if "datetime" in str(frame[c].dtype):
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        elif str(frame[c].dtype) in ("object", "str", "string"):
            frame[c] = frame[c].map(lambda v: None if v is None or v is pd.NA or v != v else str(v))
        else:
            frame[c] = frame[c].astype(float)
    cell = lambda v: "" if v is None or v != v else repr(v)
    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, duck, name):
    query = REGISTRY[name]
    frame = query.run(spark, SMALL)
    got = frame.toPandas()
    plan = frame._jdf.queryExecution().optimizedPlan().toString() + frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    sql = query.oracle()
    if sql is None:
        assert len(got) > 0
        return
    want = duck.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert comparable(got) == comparable(want)


def test_entry_points(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_filters_and_columns_reach_the_files(spark):
    plan = REGISTRY["time_bounded_scan"].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "event_type" not in plan


@pytest.mark.parametrize("name", ["balances_at_block", "price_series_1h_week", "tvl_one_week"])
def test_time_bounds_reach_the_ticks(spark, name):
    plan = REGISTRY[name].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert any("GreaterThanOrEqual(ts" in part.split("]")[0] for part in plan.split("PushedFilters: [")[1:])


# exchanges of the initial plan; adaptive execution reuses some of them
EXCHANGES = {"import_plan": 15, "ranges_excluded": 6, "ranges_intersected": 6, "coverage_after_results": 13}


@pytest.mark.parametrize("name", EXCHANGES)
def test_interval_sweeps_shuffle_little(spark, name):
    plan = REGISTRY[name].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= EXCHANGES[name]
