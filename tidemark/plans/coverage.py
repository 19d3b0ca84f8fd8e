"""What has been imported, what must be retried, and what to import next.

Coverage is two frames: ``states`` (one row per import key) and ``ranges`` (import_key, kind, from, to) with kind
``covered`` or ``retry``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timegrid import SAMPLING_MS, interval
from tidemark.operators import dyadic, intervals
from tidemark.session import dealt

COVERED, RETRY = "covered", "retry"
KEY = ["import_key"]
EOL_DELAY_DAYS = 100
_SETS = ["covered", "retry", "succeeded", "failed"]


def of_kind(ranges: DataFrame, kind: str) -> DataFrame:
    return ranges.filter(F.col("kind") == kind).drop("kind")


def as_ranges(covered: DataFrame, retry: DataFrame) -> DataFrame:
    columns = ["import_key", "kind", "from", "to"]
    return (
        covered.withColumn("kind", F.lit(COVERED)).select(*columns)
        .unionByName(retry.withColumn("kind", F.lit(RETRY)).select(*columns))
    )


def success_ranges(ranges: DataFrame, cell_width: int = intervals.DEFAULT_CELL) -> DataFrame:
    return intervals.exclude(of_kind(ranges, COVERED), of_kind(ranges, RETRY), KEY, cell_width=cell_width)


def update_ranges(
    ranges: DataFrame, covered: DataFrame, succeeded: DataFrame, failed: DataFrame, cell_width: int = intervals.DEFAULT_CELL
) -> DataFrame:
    """covered := covered + new; retry := (retry - succeeded) + failed, per import key."""
    marked = [_known(ranges), *(_marked(df, **{mark: F.lit(True)}) for mark, df in (("covered", covered), ("succeeded", succeeded), ("failed", failed)))]
    return _updated(reduce(DataFrame.unionByName, marked), cell_width)


def _marked(df: DataFrame, **sets: Column) -> DataFrame:
    """Ranges marked with the sets they are in."""
    return df.select("import_key", "from", "to", *(sets.get(mark, F.lit(False)).alias(mark) for mark in _SETS))


def _known(ranges: DataFrame) -> DataFrame:
    return _marked(ranges, covered=F.col("kind") == COVERED, retry=F.col("kind") == RETRY)


def _updated(marked: DataFrame, cell_width: int) -> DataFrame:
    outcomes = {COVERED: lambda on: on["covered"], RETRY: lambda on: on["failed"] | (on["retry"] & ~on["succeeded"])}
    return intervals.combine_marked(marked, KEY, _SETS, outcomes, whole=COVERED, cell_width=cell_width)


def fold_results(states: DataFrame, ranges: DataFrame, results: DataFrame, import_date: datetime, cell_width: int = intervals.DEFAULT_CELL) -> tuple[DataFrame, DataFrame]:
    """Apply import results (import_key, from, to, success, latest) to the coverage.

    A stretch that both failed and succeeded counts as failed. The key's latest known block only grows.
    Returns (states, ranges).
    """
    # as ``update_ranges``, but each result is read once. Failed stretches stay queued whatever else succeeded on them, so
    # what succeeded need not be cut first
    noted = _marked(results, covered=F.lit(True), succeeded=F.col("success"), failed=~F.col("success"))
    new_ranges = _updated(_known(ranges).unionByName(noted), cell_width)
    seen = results.groupBy("import_key").agg(F.max("latest").alias("_latest"), F.lit(True).alias("_touched"))
    new_states = (
        states.join(seen, "import_key", "left")
        .withColumns(
            {
                "chain_latest_block_number": F.greatest("chain_latest_block_number", "_latest"),
                "last_import_date": F.when(F.col("_touched"), F.lit(import_date)).otherwise(F.col("last_import_date")),
            }
        )
        .select(*states.columns)
    )
    return new_states, new_ranges


def overlapping_results(results: DataFrame, cell_width: int = intervals.DEFAULT_CELL) -> DataFrame:
    """Import keys whose results overlap each other: the same range was asked for twice."""
    return intervals.overlaps_within(results, KEY, cell_width=cell_width).filter("has_overlap").select("import_key")


def parent_results(items: DataFrame, children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """An item succeeds only if all its children did; an item without children succeeds."""
    outcome = children.groupBy(*parent).agg(F.bool_and("success").alias("_ok"))
    return items.join(outcome, list(parent), "left").withColumn("success", F.coalesce("_ok", F.lit(True))).drop("_ok")


def window_to_consider(
    states: DataFrame,
    latest: Column,
    *,
    historical: bool,
    max_blocks_per_query: int | Column,
    ms_per_block: int | Column,
    lag: int = 5,
    last_imported: Column | None = None,
    is_live: Column | None = None,
    skip_recent: str = "none",
    forced: tuple[int, int] | None = None,
) -> DataFrame:
    """Add ``from`` and ``to``: the block window each state should import now.

    Recent: at most a day of blocks and one query's worth, ending ``lag`` blocks before the latest one.
    Historical: from contract creation on, leaving the recent window out for ``skip_recent`` all, live or eol
    products. ``forced`` clamps the window. It may come out empty (``from`` > ``to``).
    """
    if skip_recent not in ("all", "none", "live", "eol"):
        raise ValueError(f"invalid skip_recent: {skip_recent}")
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    per_day = F.floor(F.lit(SAMPLING_MS["1day"]) / as_col(ms_per_block)).cast("long")
    blocks = [as_col(max_blocks_per_query).cast("long"), per_day]
    if last_imported is not None:
        since = F.greatest(F.lit(0).cast("long"), latest - (last_imported + F.lit(lag + 1)))
        blocks.append(F.when(last_imported.isNotNull() & (last_imported != 0), since))
    recent_from = F.greatest(F.lit(lag).cast("long"), latest - F.least(*blocks)) - F.lit(lag)
    recent_to = latest - F.lit(lag)
    if historical:
        live = is_live if is_live is not None else F.lit(True)
        skip = {"all": F.lit(True), "none": F.lit(False), "live": live, "eol": ~live}[skip_recent]
        created = F.col("contract_created_at_block")
        lo = F.when(created.isNull(), recent_from).otherwise(created)
        hi = F.when(created.isNull() | ~skip, recent_to).otherwise(F.least(recent_to, recent_from))
    else:
        lo, hi = recent_from, recent_to
    if forced is not None:
        lo, hi = F.greatest(lo, F.lit(forced[0])), F.least(hi, F.lit(forced[1]))
    return states.withColumns({"from": lo.cast("long"), "to": hi.cast("long")})


def clamp_retries(retries: DataFrame, lo: int, hi: int, cell_width: int = intervals.DEFAULT_CELL) -> DataFrame:
    return intervals.merge(intervals.clip(retries, F.lit(lo), F.lit(hi)), KEY, cell_width=cell_width)


def recent_date_window(last_imported: Column, as_of: datetime, max_period: str) -> tuple[Column, Column]:
    """From the last import, but not further back than one query reaches, to now."""
    now = F.lit(as_of)
    start = F.greatest(F.coalesce(last_imported, F.timestamp_seconds(F.lit(0))), now - interval(max_period))
    return start, now


def plan_import(
    windows: DataFrame,
    ranges: DataFrame,
    max_length: int,
    limit: int,
    *,
    ignore_state: bool = False,
    cell_width: int = intervals.DEFAULT_CELL,
) -> DataFrame:
    """Ranges to import per key, best first: new ones newest first, then retries newest first, at most ``limit``.

    ``windows`` has import_key, from and to.
    """
    full = windows.filter(F.col("from") <= F.col("to")).select("import_key", "from", "to")
    if not ignore_state:
        full = intervals.exclude(full, ranges.select("import_key", "from", "to"), KEY, cell_width=cell_width)
    else:
        full = intervals.merge(full, KEY, gap=0, cell_width=cell_width)
    queued = intervals.merge(of_kind(ranges, RETRY), KEY, gap=0, cell_width=cell_width)
    wanted = full.withColumn("is_retry", F.lit(False)).unionByName(queued.withColumn("is_retry", F.lit(True)))
    return intervals.plan_slices(wanted, KEY, max_length, limit, descending=True, disjoint=True, first=["is_retry"])


def schedule_reimport(states: DataFrame, ranges: DataFrame, start: int, end: int | None = None, cell_width: int = intervals.DEFAULT_CELL) -> DataFrame:
    """Ranges after queueing [start, end] for another import, clamped to after creation and to the latest block."""
    to = F.lit(end) if end else F.col("chain_latest_block_number")
    asked = (
        states.select(
            "import_key",
            F.greatest(F.lit(start), F.col("contract_created_at_block") + 1).cast("long").alias("from"),
            to.cast("long").alias("to"),
        )
        .filter(F.col("from") <= F.col("to"))
    )
    return update_ranges(ranges, asked, asked.limit(0), asked, cell_width)


def reset_ranges(ranges: DataFrame, keys: DataFrame) -> DataFrame:
    """Forget the coverage of some import keys."""
    return ranges.join(keys.select("import_key"), "import_key", "left_anti")


def work_order(states: DataFrame, is_live: Column) -> DataFrame:
    """Least recently imported first; retired products wait 100 days longer. Adds the sort key."""
    delay = F.when(is_live, F.lit(0)).otherwise(F.lit(EOL_DELAY_DAYS))
    due = F.timestamp_micros(F.unix_micros("last_import_date") + delay.cast("long") * F.lit(SAMPLING_MS["1day"] * 1000))
    return states.withColumn("due", due).orderBy("due", "import_key")


def metrics(products: DataFrame, states: DataFrame, ranges: DataFrame, as_of: datetime) -> DataFrame:
    """Failed, imported and missing block counts per chain, import type and dashboard state."""
    latest = (
        states.filter(F.col("type") == "product:investment")
        .groupBy("chain")
        .agg(F.max("chain_latest_block_number").alias("_latest"))
    )
    size = F.col("to") - F.col("from") + 1
    sizes = ranges.groupBy("import_key").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == COVERED, size)), F.lit(0)).alias("_covered"),
        F.coalesce(F.sum(F.when(F.col("kind") == RETRY, size)), F.lit(0)).alias("_retry"),
    )
    eol = F.coalesce(F.get_json_object("product_data", "$.dashboardEol"), F.lit("false")) == "true"
    per_product = (
        products.select("product_id", "chain", eol.alias("eol"))
        .join(states.select("product_id", "import_key", F.col("type").alias("import_type"), "contract_created_at_block"), "product_id")
        .join(sizes, "import_key", "left")
        .join(latest, "chain", "left")
    )
    covered, retry = F.coalesce("_covered", F.lit(0)), F.coalesce("_retry", F.lit(0))
    expected = F.col("_latest") - F.col("contract_created_at_block") + 1
    return per_product.groupBy("chain", "import_type", "eol").agg(
        F.sum(retry).alias("errors_count"),
        (F.sum(covered) - F.sum(retry)).alias("success_count"),
        (F.sum(expected) - F.sum(covered)).alias("not_covered_yet"),
    ).withColumn("datetime", F.lit(as_of))


def chain_latest(states: DataFrame) -> DataFrame:
    return states.groupBy("chain", "type").agg(F.max("chain_latest_block_number").alias("latest_indexed_block"))


def chain_has_retries(states: DataFrame, ranges: DataFrame) -> DataFrame:
    queued = of_kind(ranges, RETRY).groupBy("import_key").agg(F.lit(True).alias("_queued"))
    return (
        states.join(queued, "import_key", "left")
        .groupBy("chain", "type")
        .agg(F.bool_or(F.coalesce("_queued", F.lit(False))).alias("has_anything_to_retry"))
    )


def block_status(states: DataFrame, ranges: DataFrame, block: int, as_of: datetime) -> DataFrame:
    """Per key: is a block covered, is it queued for retry, and how long ago was the last import."""
    hit = ranges.filter(F.lit(block).between(F.col("from"), F.col("to"))).groupBy("import_key").agg(
        F.bool_or(F.col("kind") == RETRY).alias("is_in_retry_queue"), F.bool_or(F.col("kind") == COVERED).alias("is_covered")
    )
    age = (F.unix_micros(F.lit(as_of)) - F.unix_micros("last_import_date")) / F.lit(1e6)
    return states.join(hit, "import_key", "left").select(
        "import_key",
        age.alias("last_import_age_sec"),
        F.coalesce("is_in_retry_queue", F.lit(False)).alias("is_in_retry_queue"),
        F.coalesce("is_covered", F.lit(False)).alias("is_covered"),
    )


def sampled_points(scope: DataFrame, blocks: DataFrame) -> DataFrame:
    """The steps of each import key's chain. A row becomes one per step, so the rows are dealt out by key and the few steps
    sent to them; joined by chain they would lie in as many tasks as there are chains."""
    steps = dealt(scope, "import_key").join(F.broadcast(blocks), "chain")
    return steps.select("import_key", "product_id", "datetime", "block_number").distinct()


def import_results_over_time(blocks: DataFrame, products: DataFrame, states: DataFrame, ranges: DataFrame, latest: DataFrame) -> DataFrame:
    """Worst status of each product at each sampled block: 2 failed, 1 imported, 0 expected but missing.

    ``blocks``: chain, datetime, block_number (one per time step); ``latest``: chain, max_block.
    """
    scope = states.select("import_key", "product_id", "contract_created_at_block").join(
        products.select("product_id", "chain"), "product_id"
    )
    expected = scope.join(latest, "chain").select(
        "import_key", F.lit(0).alias("status"), F.col("contract_created_at_block").cast("long").alias("from"), F.col("max_block").cast("long").alias("to")
    )
    known = ranges.join(scope.select("import_key"), "import_key", "left_semi").select(
        "import_key", F.when(F.col("kind") == RETRY, 2).otherwise(1).alias("status"), "from", "to"
    )
    valid = expected.unionByName(known).filter(F.col("from") <= F.col("to"))
    points = sampled_points(scope, blocks)
    found = dyadic.largest_at(points, valid, KEY, "block_number", F.col("status"), "range_result")
    return found.select("product_id", "datetime", "range_result")


def creation_info(products: DataFrame, states: DataFrame, by: str = "product_id") -> DataFrame:
    """First block and date of each product, or of each feed through its products."""
    created = states.filter(F.col("type") == "product:investment").select(
        "product_id", "contract_created_at_block", "contract_creation_date"
    )
    joined = products.select("product_id", "chain", "price_feed_1_id", "price_feed_2_id").join(created, "product_id")
    if by == "product_id":
        return joined.select("product_id", "chain", "contract_created_at_block", "contract_creation_date")
    return (
        joined.filter(F.col(by).isNotNull())
        .groupBy(F.col(by).alias("price_feed_id"))
        .agg(F.min(F.struct("contract_creation_date", "contract_created_at_block", "product_id", "chain")).alias("_first"))
        .select("price_feed_id", "_first.product_id", "_first.chain", "_first.contract_created_at_block", "_first.contract_creation_date")
    )


def trusted_blocks(rows: DataFrame, latest: DataFrame, lag: int = 5) -> DataFrame:
    """Rows at least ``lag`` blocks behind their chain's latest one."""
    return rows.join(latest, "chain").filter(F.col("block_number") <= F.col("max_block") - F.lit(lag)).drop("max_block")
