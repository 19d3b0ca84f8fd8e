"""A refresh of prices reads and rewrites the days that depend on it, and no others."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.plans import repricing
from tidemark.queries import holdings
from tidemark.sources.standins import Tables


def test_the_index_names_the_days_of_a_feed(spark, tmp_path):
    rows = [(1, "2024-01-01 10:00:00"), (1, "2024-01-02 10:00:00"), (2, "2024-01-02 23:00:00"), (3, "2024-01-03 01:00:00")]
    timeline = spark.createDataFrame(rows, "product_id INT, at STRING").select("product_id", F.col("at").cast("timestamp").alias("datetime"))
    products = spark.createDataFrame([(1, 7, 7), (2, None, 8), (3, 9, None)], "product_id INT, price_feed_1_id INT, price_feed_2_id INT")
    repricing.store(timeline, products, str(tmp_path))

    def days(feed, lo, hi):
        refreshed = spark.createDataFrame([(feed, datetime(*lo), datetime(*hi))], "price_feed_id INT, `from` TIMESTAMP, `to` TIMESTAMP")
        return sorted(r[0].day for r in repricing.touched_days(spark, str(tmp_path), refreshed).collect())

    whole = (2024, 1, 1), (2024, 1, 9)
    assert [days(f, *whole) for f in (7, 8, 9, 10)] == [[1, 2], [2], [3], []]
    assert days(7, (2024, 1, 1, 11), (2024, 1, 2, 10)) == [2] and days(8, (2024, 1, 2), (2024, 1, 2, 22)) == []


def test_only_the_days_of_the_refresh_are_read_and_rewritten(spark, monkeypatch):
    seen, real = [], repricing.rewrite_partitions

    def watched(session, path, batch, partition, change):
        files = lambda: {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("day=")}
        before = files()
        plans = lambda stored: seen.append(stored._jdf.queryExecution().executedPlan().toString()) or change(stored)
        real(session, path, batch, partition, plans)
        after = files()
        seen.append(sorted(d for d in after if after[d] != before[d]))

    monkeypatch.setattr(repricing, "rewrite_partitions", watched)
    _, priced = holdings.repriced(Tables(spark, SMALL))
    plan, rewritten = seen
    assert rewritten == [f"day=2024-01-{d}" for d in range(10, 20)]
    assert "2024-01-10" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0] and "2024-01-20" not in plan
    assert {r[0] for r in priced.select("tier").distinct().collect()} == {1, 2, 3, 4}
