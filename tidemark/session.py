"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan relies on; static and sizing settings stay the cluster's."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can see: the cluster's ``spark.checkpoint.dir``. Only a local session may do without."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext.getCheckpointDir()
        folder = os.path.dirname(current) if current else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by their keys: a small file is read by one task, however much is made of each of its rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


# rows that a task may have to hold at once: about 200 MB of them
ROWS_OF_A_TASK = 500_000


def tasks_for(*frames: DataFrame) -> int:
    """Tasks over which the rows of some frames together are to be dealt, so that what one holds does not grow with them."""
    rows = sum(df.count() for df in frames)
    return max(int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_OF_A_TASK))


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; ``clear_scratch`` removes what was written there."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders of this session, once nothing reads frames made before any more; returns how many."""
    removed = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        removed += int(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return removed


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local one."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
