"""Tables laid out for a join: rows are hashed into files by the join's keys when they are written, so that every later
join or roll-up on these keys reads matching files together and moves no row."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.session import scratch_path


def write(df: DataFrame, label: str, keys: Sequence[str], buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """The frame as a bucketed table in the shared folder. ``keys`` are all keys of the join, so that a key value of which
    there are many is not one bucket; two tables must be written with as many buckets, which grow with the data."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*(order or keys))
    writer.option("path", scratch_path(spark, label)).saveAsTable(name)
    return spark.table(name)
