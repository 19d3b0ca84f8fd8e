"""First-in-first-out positions kept up to date by folds of new trades.

A fold works out only the positions that have new trades, from where they stood: the lots still open then are buys at the
head of the new trades, and the closed form of ``operators.fifo`` runs over these alone. It leaves one row per position
(totals, and the day that it reaches) and the lots that are open now. Trades of a day that a position has reached or
passed reopen it: the position goes back to its last state before that day and takes up all landed trades behind that
state, and its states from that day on no longer count.

Each fold writes its own partition, ``states`` last, so a fold that runs again replaces what it had written and changes
nothing else. Trades must have landed before the fold that names them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import fifo
from tidemark.operators.upsert import overwrite_partitions, table_exists
from tidemark.schema import AMOUNT

STATES, LOTS, FOLD = "states", "lots", "fold"
_TOTALS = "since date, day date, balance decimal(38,18), realized_pnl double"


def _table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    where = f"{path}/{name}"
    return spark.read.schema(schema).parquet(where) if table_exists(spark, where) else spark.createDataFrame([], schema)


def _written(df: DataFrame, where: str) -> DataFrame:
    df.write.mode("overwrite").parquet(where)
    return df.sparkSession.read.parquet(where)


def _types(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _valid(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States that no later fold has reopened."""
    later = Window.partitionBy(*keys).orderBy(F.col(FOLD).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return states.withColumn("_reopened", F.min("since").over(later)).filter(
        F.col("_reopened").isNull() | (F.col("_reopened") > F.col("day"))
    )


def fold(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    landed: DataFrame,
    number: int,
    keys: Sequence[str],
    order: Sequence[str],
    cell: Column,
    shares: str = "shares",
    price: str = "price",
) -> None:
    """Take up new trades. ``landed`` are all trades that have come, the new ones among them; both have ``datetime``."""
    keys, order = list(keys), list(order)
    kept = list(dict.fromkeys([*keys, *order, "datetime", shares, price]))
    touched = new.groupBy(*keys).agg(F.min(F.to_date("datetime")).alias("since"))
    known = _table(spark, path, STATES, f"{_types(landed, keys)}, {_TOTALS}, {FOLD} int").filter(F.col(FOLD) < number)
    own = known.join(touched.select(*keys, F.col("since").alias("_since")), keys)
    base = _valid(own, keys).filter(F.col("day") < F.col("_since")).groupBy(*keys)
    base = base.agg(F.max_by(F.struct(FOLD, "day", "balance", "realized_pnl"), "day").alias("base"))
    # from where trades are taken up: behind the state to go back to, else from the first trade ever folded
    began = own.groupBy(*keys).agg(F.min("since").alias("_began"))
    at = F.coalesce(F.date_add("base.day", 1), F.least("since", "_began"))
    touched = touched.join(base, keys, "left").join(began, keys, "left").select(*keys, "since", at.alias("_at"), "base")
    touched = _written(touched, f"{path}/_touched")  # read by four steps
    first = touched.agg(F.min("_at")).first()[0]
    if first is None:
        return

    lots = _table(spark, path, LOTS, f"{_types(landed, kept)}, held {AMOUNT}, {FOLD} int").filter(F.col(FOLD) < number)
    head = lots.join(touched.select(*keys, F.col(f"base.{FOLD}").alias(FOLD)), [*keys, FOLD]).select(*kept, "held")
    # the bound reaches the files; each position then takes its own days
    recent = landed.filter(F.col("datetime") >= F.lit(first).cast("timestamp"))
    day = F.to_date("datetime")
    trades = recent.join(touched.select(*keys, "_at"), keys).filter(day >= F.col("_at")).select(*kept, F.col(shares).cast(AMOUNT).alias("held"))
    rows = head.withColumn("_new", F.lit(False)).unionByName(trades.withColumn("_new", F.lit(True)))
    rows = _written(rows, f"{path}/_rows")  # counted, then read by the running sums

    # only a position with more rows than a task may hold is cut into cells
    most = rows.groupBy(*keys).count().agg(F.max("count")).first()[0]
    tracked = fifo.inventory(rows, keys, order, cell if (most or 0) > session.ROWS_OF_A_TASK else None, "held")
    zero, cost = F.lit(0).cast(AMOUNT), F.col(price).cast("double")
    is_buy = F.col("held") > 0
    used = F.greatest(zero, F.least(F.col("bought"), F.col("sold_in_all")) - F.col("bought_before"))
    gone = F.when(is_buy, -used.cast("double") * cost).otherwise((F.col("sold") - F.col("sold_before")).cast("double") * cost)
    tracked = tracked.withColumns({"_left": F.when(is_buy, F.col("held") - used).cast(AMOUNT), "_gain": gone})
    # both tables come from one result, written once
    tracked = _written(tracked.select(*kept, "held", "_new", "_left", "_gain", F.lit(number).alias(FOLD)), f"{path}/_whole")
    left = tracked.filter(F.col("_left") > 0).select(*kept, F.col("_left").alias("held"), FOLD)
    overwrite_partitions(left, f"{path}/{LOTS}", FOLD)
    totals = tracked.groupBy(*keys).agg(
        F.max(day).alias("day"),
        F.sum(F.when(F.col("_new"), F.col("held"))).alias("_moved"),
        F.coalesce(F.sum("_gain"), F.lit(0.0)).alias("_gained"),
    )
    states = totals.join(touched, keys)
    states = states.select(
        *keys,
        "since",
        "day",
        (F.coalesce("base.balance", zero) + F.col("_moved")).cast(AMOUNT).alias("balance"),
        (F.coalesce("base.realized_pnl", F.lit(0.0)) + F.col("_gained")).alias("realized_pnl"),
        F.lit(number).alias(FOLD),
    )
    overwrite_partitions(states, f"{path}/{STATES}", FOLD)


def positions(spark: SparkSession, path: str, keys: Sequence[str], price: str = "price") -> DataFrame:
    """Every position as its last fold left it: ``balance``, ``realized_pnl``, ``remaining_shares``, ``remaining_cost`` and
    ``avg_entry_price``."""
    keys = list(keys)
    last = spark.read.parquet(f"{path}/{STATES}").groupBy(*keys).agg(
        F.max(FOLD).alias(FOLD), F.max_by(F.struct("balance", "realized_pnl"), FOLD).alias("_s")
    )
    open_lots = spark.read.parquet(f"{path}/{LOTS}").join(last.select(*keys, FOLD), [*keys, FOLD])
    held = F.col("held").cast("double")
    sums = open_lots.groupBy(*keys).agg(F.sum(held).alias("_held"), F.sum(held * F.col(price).cast("double")).alias("_cost"))
    shares, cost = F.coalesce("_held", F.lit(0.0)), F.coalesce("_cost", F.lit(0.0))
    return last.join(sums, keys, "left").select(
        *keys,
        "_s.balance",
        "_s.realized_pnl",
        shares.alias("remaining_shares"),
        cost.alias("remaining_cost"),
        F.when(shares == 0, F.lit(0.0)).otherwise(cost / shares).alias("avg_entry_price"),
    )
