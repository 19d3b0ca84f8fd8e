"""What the operators share: reading a table, mapping Arrow batches, splits by checksum, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: Rows that one Python step holds at a time, whatever size Spark gives its batches.
SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(key: str | Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % divisor


def map_slices(
    df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = SLICE
) -> DataFrame:
    """Apply ``step`` to every slice of at most ``rows`` rows; a step may return nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = step(batch.slice(at, rows))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(batch.schema.names.index(column)).cast(pa.binary()).to_pylist()


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back: lineage ends here and both readers see the same rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sampled(df: DataFrame, key: str, fraction: Column) -> DataFrame:
    """Rows whose hashed key falls below ``fraction``: the same rows on every run, whatever the partitions."""
    share = F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return df.where(F.col(key).isNotNull() & (share < fraction))


def whole_units(batches: Iterator[pa.RecordBatch], unit: list[str]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Rows sorted by the ``unit`` columns (numbers without nulls) as tables of whole units, with where each unit starts
    and its size."""
    carry: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        part = part if carry is None else pa.concat_tables([carry, part])
        new = np.zeros(part.num_rows, dtype=bool)
        new[0] = True
        for c in unit:
            values = part.column(c).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        carry = part.slice(starts[-1])
        if len(starts) > 1:
            yield part.slice(0, starts[-1]), starts[:-1], np.diff(starts)
    if carry is not None:
        yield carry, np.zeros(1, dtype=np.int64), np.array([carry.num_rows])


def all_pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows (i before j) within each of some consecutive groups."""
    end = np.repeat(starts + sizes, sizes)
    row = np.arange(starts[0], starts[0] + sizes.sum())
    more = end - row - 1
    i = np.repeat(row, more)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(more) - more, more)
    return i, j
