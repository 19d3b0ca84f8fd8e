import duckdb
import pytest

from tests.conftest import SMALL
from tests.test_queries import comparable
from tidemark.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", list(SQL))
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want, got = con.sql(SQL[name]).df(), QUERIES[name](spark, SMALL).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert comparable(got) == comparable(want)
