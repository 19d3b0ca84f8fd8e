"""First-in-first-out profit and loss, in closed form.

With S the running sum of shares, the inventory after each transaction is ``I = S - min(0, min S so far)``: a sale
beyond the inventory is dropped, as selling what was never bought has no entry price. Laid end to end, the buys form
one axis and what has been sold so far is always its first ``E = bought - I`` units. So the cost of everything sold is
the cost of a prefix of that axis, and no sale is ever paired with a buy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SHARES = "decimal(38,18)"


def _shares(column: Column) -> Column:
    return column.cast(_SHARES)


def _in_one_window(transactions: DataFrame, keys: Sequence[str], order: Sequence[str], shares: str) -> DataFrame:
    by_key = Window.partitionBy(*keys).orderBy(*order)
    here = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    amount, zero = F.col("_d"), F.lit(0).cast(_SHARES)
    # as in the join by cells, rows without a key take no part
    tracked = transactions.dropna(subset=list(keys)).withColumn("_d", _shares(F.col(shares)))
    tracked = tracked.withColumns(
        {"_sum": _shares(F.sum(amount).over(here)), "bought": _shares(F.sum(F.when(amount > 0, amount).otherwise(F.lit(0))).over(here))}
    )
    lowest = {"_low": here, "_low_before": by_key.rowsBetween(Window.unboundedPreceding, -1)}
    tracked = tracked.withColumns({name: F.least(zero, F.coalesce(F.min("_sum").over(w), zero)) for name, w in lowest.items()})
    tracked = tracked.withColumns(
        {
            "inventory": _shares(F.col("_sum") - F.col("_low")),
            "inventory_before": _shares(F.col("_sum") - amount - F.col("_low_before")),
            "bought_before": _shares(F.col("bought") - F.greatest(amount, zero)),
        }
    )
    tracked = tracked.withColumns(
        {"sold": _shares(F.col("bought") - F.col("inventory")), "sold_before": _shares(F.col("bought_before") - F.col("inventory_before"))}
    )
    # what has been sold never falls
    return tracked.withColumn("sold_in_all", F.max("sold").over(Window.partitionBy(*keys))).drop("_d", "_sum", "_low", "_low_before")


def inventory(
    transactions: DataFrame, keys: Sequence[str], order: Sequence[str], cell: Column | None, shares: str = "shares"
) -> DataFrame:
    """Transactions with running ``bought`` (buys so far), ``inventory`` and ``sold`` (matched sales so far), before
    and after the transaction, plus ``sold_in_all``, the key's final matched sales. Without a ``cell`` a task takes the
    whole of each key: one exchange and one sort, for keys that are known to fit."""
    keys, order = list(keys), list(order)
    if cell is None:
        return _in_one_window(transactions, keys, order, shares)
    in_cell = Window.partitionBy(*keys, "_cell").orderBy(*order)
    here = in_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    amount = F.col("_d")
    local = (
        transactions.withColumns({"_cell": cell, "_d": F.col(shares).cast(_SHARES)})
        .withColumn("_sum", _shares(F.sum(amount).over(here)))
        .withColumn("_low", F.min("_sum").over(here))
        .withColumn("_low_before", F.min("_sum").over(in_cell.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_buys", _shares(F.sum(F.when(amount > 0, amount).otherwise(F.lit(0))).over(here)))
    )
    # per cell: net shares, lowest running sum inside it, buys
    cells = local.groupBy(*keys, "_cell").agg(
        _shares(F.sum("_d")).alias("_net"),
        F.min("_low").alias("_cell_low"),
        _shares(F.sum(F.when(amount > 0, amount).otherwise(F.lit(0)))).alias("_cell_buys"),
    )
    by_key = Window.partitionBy(*keys).orderBy("_cell")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    zero = F.lit(0).cast(_SHARES)
    carried = (
        cells.withColumns(
            {
                "_sum_in": F.coalesce(_shares(F.sum("_net").over(earlier)), zero),
                "_buys_in": F.coalesce(_shares(F.sum("_cell_buys").over(earlier)), zero),
                "_net_all": _shares(F.sum("_net").over(whole)),
                "_buys_all": _shares(F.sum("_cell_buys").over(whole)),
            }
        )
        .withColumn("_low_here", _shares(F.col("_sum_in") + F.col("_cell_low")))
        .withColumns({"_low_in": F.min("_low_here").over(earlier), "_low_all": F.min("_low_here").over(whole)})
        .withColumn("sold_in_all", _shares(F.col("_buys_all") - (F.col("_net_all") - F.least(zero, "_low_all"))))
        .select(*keys, "_cell", "_sum_in", "_buys_in", "_low_in", "sold_in_all")
    )

    def lowest(in_this_cell: str) -> Column:
        return F.least(zero, F.coalesce("_low_in", zero), _shares(F.col("_sum_in") + F.coalesce(in_this_cell, zero)))

    total = F.col("_sum_in") + F.col("_sum")
    # before the first transaction of a cell the running sum is what came in, which the summaries already cover
    return (
        local.join(carried, [*keys, "_cell"])
        .withColumns(
            {
                "bought": _shares(F.col("_buys_in") + F.col("_buys")),
                "inventory": _shares(total - lowest("_low")),
                "inventory_before": _shares(total - amount - lowest("_low_before")),
            }
        )
        .withColumn("bought_before", _shares(F.col("bought") - F.greatest(amount, zero)))
        .withColumns(
            {
                "sold": _shares(F.col("bought") - F.col("inventory")),
                "sold_before": _shares(F.col("bought_before") - F.col("inventory_before")),
            }
        )
        .drop("_cell", "_d", "_sum", "_low", "_low_before", "_buys", "_sum_in", "_buys_in", "_low_in")
    )


def pnl(
    transactions: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cell: Column,
    shares: str = "shares",
    price: str = "price",
) -> DataFrame:
    """Per key: realised profit, remaining shares, their cost and average entry price (0 when nothing remains)."""
    keys, order = list(keys), list(order)
    tracked = inventory(transactions, keys, order, cell, shares)
    amount, cost = F.col(shares).cast("double"), F.col(price).cast("double")
    # the part of a buy that has been sold in the end, and the part of a sale that was matched
    used = F.greatest(F.lit(0).cast(_SHARES), F.least(F.col("bought"), F.col("sold_in_all")) - F.col("bought_before"))
    is_buy = amount > 0
    held = F.when(is_buy, F.col("bought") - F.col("bought_before") - used).cast("double")
    out_cost = F.when(is_buy, used.cast("double") * cost)
    matched = F.when(amount < 0, (F.col("sold") - F.col("sold_before")).cast("double") * cost)
    totals = tracked.groupBy(*keys).agg(
        F.coalesce(F.sum(matched), F.lit(0.0)).alias("_proceeds"),
        F.coalesce(F.sum(out_cost), F.lit(0.0)).alias("_cost_of_sold"),
        F.coalesce(F.sum(held), F.lit(0.0)).alias("remaining_shares"),
        F.coalesce(F.sum(F.when(is_buy, held * cost)), F.lit(0.0)).alias("remaining_cost"),
    )
    return totals.select(
        *keys,
        (F.col("_proceeds") - F.col("_cost_of_sold")).alias("realized_pnl"),
        "remaining_shares",
        "remaining_cost",
        F.when(F.col("remaining_shares") == 0, F.lit(0.0))
        .otherwise(F.col("remaining_cost") / F.col("remaining_shares"))
        .alias("avg_entry_price"),
    )


def unrealized(positions: DataFrame, current_price: Column) -> DataFrame:
    """Profit on the remaining shares at a current price."""
    value = F.col("remaining_shares") * current_price - F.col("remaining_cost")
    return positions.withColumn("unrealized_pnl", value)
