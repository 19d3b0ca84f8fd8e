"""Keyed upserts with a policy per column, and the partition-scoped rewrites built on them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.json_merge import merge_column
from tidemark.operators.latest import keep_first

REPLACE = "replace"          # new row's value, even if NULL
NEW_NON_NULL = "new"         # new value unless NULL
EXISTING_NON_NULL = "existing"  # stored value unless NULL
MERGE_JSON = "merge_json"    # deep merge of two JSON texts
KEEP = "keep"                # never changed once stored

# per-column policies of the engine tables; columns not listed are replaced
POLICIES = {
    "price_ts": {},
    "vault_stats_ts": {},
    "investment_balance_ts": {"pending_rewards": EXISTING_NON_NULL, "pending_rewards_diff": EXISTING_NON_NULL},
    "investor_timeline_ts": {
        c: NEW_NON_NULL
        for c in (
            "transaction_hash", "balance", "balance_diff", "share_to_underlying_price",
            "underlying_balance", "underlying_diff", "pending_rewards", "pending_rewards_diff",
        )
    },
    "price_feed": {"price_feed_data": MERGE_JSON},
    "investor": {"investor_data": MERGE_JSON},
    "import_state": {"import_data": MERGE_JSON},
}


def _kept(policy: str, values: Sequence[str]) -> dict[str, Column]:
    """Aggregates over the rows of a key, each with its ``_turn``, that give what the policy keeps of some columns. They do
    not depend on the order in which rows are seen."""
    turn = F.col("_turn")
    if policy in (REPLACE, KEEP):
        pick = F.max_by if policy == REPLACE else F.min_by
        whole = pick(F.struct(*values), turn)
        return {v: whole[v] for v in values}
    if policy in (NEW_NON_NULL, EXISTING_NON_NULL):
        pick = F.max_by if policy == NEW_NON_NULL else F.min_by
        return {v: pick(v, F.when(F.col(v).isNotNull(), turn)) for v in values}
    raise ValueError(f"unknown policy: {policy}")


def fold(
    parts: Sequence[DataFrame], keys: Sequence[str], policies: Mapping[str, str] | None = None, default: str = REPLACE
) -> DataFrame:
    """Stored rows and any number of batches, in the order in which they came, as one grouping by key.

    Each part must hold a key once. Every row carries the turn of its part, and a policy is an aggregate over the rows of a
    key: the latest row, the latest or first value that is not NULL. A column that a part lacks is left alone by it. A
    NULL in a key is a value like any other. Deep merges of JSON are made by path, part by part.
    """
    policies, columns = dict(policies or {}), parts[0].columns
    values = [c for c in columns if c not in keys]
    policy = {c: policies.get(c, default) for c in values}
    # a column that some batch lacks: what a batch without it says must not replace it
    lacking = {c for c in values if any(c not in p.columns for p in parts[1:])}
    given = {c: f"_given_{c}" for c in sorted(lacking)}
    types = {f.name: f.dataType for f in parts[0].schema}
    rows = None
    for turn, part in enumerate(parts):
        own = [F.col(f"`{c}`").cast(types[c]).alias(c) if c in part.columns else F.lit(None).cast(types[c]).alias(c) for c in columns]
        flags = [F.lit(c in part.columns).alias(f) for c, f in given.items()]
        part = part.select(*own, *flags, F.lit(turn).alias("_turn"))
        rows = part if rows is None else rows.unionByName(part)

    kept: dict[str, Column] = {}
    for kind in dict.fromkeys(policy.values()):
        own = [c for c in values if policy[c] == kind]
        if kind == MERGE_JSON:
            for c in own:
                kept |= {f"_{n}_{c}": F.max(F.when(F.col("_turn") == n, F.col(c))) for n in range(len(parts))}
            continue
        if whole := [c for c in own if c not in lacking]:
            kept |= _kept(kind, whole)
        for c in (c for c in own if c in lacking):
            there = F.when(F.col(given[c]), F.col("_turn"))
            if kind in (REPLACE, KEEP):
                kept[c] = (F.max_by if kind == REPLACE else F.min_by)(F.struct(c), there)[c]
            else:
                kept |= _kept(kind, [c])
    # one exchange: rows meet by key and are sorted once for all aggregates
    merged = rows.repartition(*keys).groupBy(*keys).agg(*(x.alias(c) for c, x in kept.items()))
    for c in (c for c in values if policy[c] == MERGE_JSON):
        merged = merged.withColumnRenamed(f"_0_{c}", c)
        for n in range(1, len(parts)):
            merged = merge_column(merged, keys, c, f"_{n}_{c}", c)
    return merged.select(*columns)


def upsert(
    stored: DataFrame, batch: DataFrame, keys: Sequence[str], policies: Mapping[str, str] | None = None, default: str = REPLACE
) -> DataFrame:
    """Stored rows with the batch applied; the batch must hold each key once (see ``keep_first``)."""
    return fold([stored, batch], keys, policies, default)


def insert_if_absent(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only the batch rows whose key is not stored yet."""
    return batch.join(stored.select(*keys), list(keys), "left_anti")


def update_from(stored: DataFrame, values: DataFrame, keys: Sequence[str], assignments: Mapping[str, Column]) -> DataFrame:
    """Keyed update: where ``values`` has the key, set each column to its expression (over both rows)."""
    hit = values.withColumn("_hit", F.lit(True))
    joined = stored.join(hit, list(keys), "left")
    updated = [
        (F.when(F.col("_hit"), assignments[c]).otherwise(F.col(c)) if c in assignments else F.col(c)).alias(c)
        for c in stored.columns
    ]
    return joined.select(*updated)


def nullify(stored: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    """Invalidate derived columns on the rows a condition selects."""
    hit = F.coalesce(condition, F.lit(False))
    return stored.withColumns({c: F.when(~hit, F.col(c)) for c in columns})


def delete_where_in(stored: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    return stored.join(keys_df.select(*on), list(on), "left_anti")


def find_conflicts(batch: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys whose rows in one batch disagree on a value (NULL counts as a value)."""
    differs = None
    for v in values:
        column = F.col(v)
        this = (F.min(column) != F.max(column)) | ((F.count(column) > 0) & (F.count(column) < F.count("*")))
        this = F.coalesce(this, F.lit(False))
        differs = this if differs is None else differs | this
    return (
        batch.groupBy(*keys)
        .agg(F.count("*").alias("rows"), differs.alias("_differs"))
        .filter(F.col("_differs"))
        .drop("_differs")
    )


def quarantine_conflicts(batch: DataFrame, keys: Sequence[str], values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows safe to load, conflicting rows)."""
    bad = find_conflicts(batch, keys, values).select(*keys)
    return batch.join(bad, list(keys), "left_anti"), batch.join(bad, list(keys), "left_semi")


def strict(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Fail the job on the first row that breaks the condition."""
    return df.filter(F.coalesce(F.assert_true(condition, message).isNull(), F.lit(True)))


def assign_ids(
    stored: DataFrame, batch: DataFrame, natural_key: str, id_column: str, arrival: Sequence[str] = ()
) -> DataFrame:
    """Surrogate ids: stored keys keep theirs, new keys get the next free ones.

    New keys are numbered by the order of their md5. They are counted per md5 prefix first, so numbering runs in
    4096 independent windows; only those 4096 counts are summed in one place.
    """
    from pyspark.sql import Window

    rest = [c for c in batch.columns if c != natural_key]
    if not rest:
        single = batch.select(natural_key).distinct()
    else:
        single = keep_first(batch, [natural_key], arrival or rest)
    fresh = (
        single.join(stored.select(natural_key), natural_key, "left_anti")
        .withColumn("_digest", F.md5(F.col(natural_key).cast("string")))
        .withColumn("_slot", F.conv(F.substring("_digest", 1, 3), 16, 10).cast("int"))
    )
    offsets = (
        fresh.groupBy("_slot")
        .agg(F.count("*").alias("_n"))
        .withColumn("_offset", F.sum("_n").over(Window.partitionBy().orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)))
        .select("_slot", F.coalesce("_offset", F.lit(0)).alias("_offset"))
    )
    highest = F.coalesce(stored.agg(F.max(id_column)).scalar(), F.lit(0))
    numbered = (
        fresh.withColumn("_n", F.row_number().over(Window.partitionBy("_slot").orderBy("_digest")))
        .join(offsets, "_slot")
        .withColumn(id_column, (highest + F.col("_offset") + F.col("_n")).cast(stored.schema[id_column].dataType))
    )
    return numbered.select(id_column, natural_key, *rest)


# partition values that a merge lists one by one; a batch that touches more is joined instead
LISTED_PARTITIONS = 10_000


def merge_into_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition: str,
    policies: Mapping[str, str] | None = None,
    arrival: Sequence[str] = (),
) -> None:
    """MERGE for a plain partitioned parquet table: read and rewrite only the partitions the batch touches.

    ``keys`` must include or determine ``partition``. The merged partitions are written out first, under the table's
    ``_pending`` folder, which readers pass over; one dynamic partition overwrite then puts them into the table. A merge
    that dies before the copy is whole has changed nothing; one that dies later is repeated from the copy by the next
    merge (or ``finish_merge``) and comes to the same table. One writer at a time.
    """
    clean = keep_first(batch, keys, arrival) if arrival else batch
    rewrite_partitions(spark, path, clean, partition, lambda stored: upsert(stored, clean, keys, policies))


def rewrite_partitions(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    partition: str,
    change: Callable[[DataFrame], DataFrame],
    first: DataFrame | None = None,
) -> None:
    """Replace the partitions that ``batch`` touches by ``change`` of their stored rows; the first batch makes the table, as
    it is or as ``first`` has it."""
    finish_merge(spark, path, partition)
    listed = [r[0] for r in batch.select(partition).distinct().limit(LISTED_PARTITIONS + 1).collect()]
    values = sorted(listed, key=lambda v: (v is not None, v))  # the filter reads the same however they came
    if not values:
        return
    new = batch if first is None else first
    if table_exists(spark, path):
        stored = spark.read.parquet(path)
        if len(values) <= LISTED_PARTITIONS:
            current = stored.filter(one_of(F.col(partition), values))
        else:
            touched = batch.select(F.col(partition).alias("_touched")).distinct()
            current = stored.join(touched, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")
        new = change(current)
    new.write.mode("overwrite").parquet(_pending(path))
    finish_merge(spark, path, partition)


def finish_merge(spark: SparkSession, path: str, partition: str) -> None:
    """Put a merge that was written out whole into the table; doing so again gives the same table."""
    success, fs = _file_system(spark, f"{_pending(path)}/_SUCCESS")
    if not fs.exists(success):
        return
    merged = spark.read.parquet(_pending(path))
    if not merged.isEmpty():
        overwrite_partitions(merged, path, partition)
        spark.createDataFrame([], merged.schema).write.mode("overwrite").parquet(_pending(path))


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}/_pending"


def one_of(column: Column, values: Sequence) -> Column:
    """Whether a column is one of some values; None stands for NULL."""
    known = sorted(v for v in values if v is not None)  # in order, so that plans list them alike
    found = column.isin(known) if known else F.lit(False)
    return found | column.isNull() if len(known) < len(values) else found


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace exactly the partitions present in ``df``; running it again gives the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hadoop_path))
