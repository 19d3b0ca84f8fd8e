"""Ordered running values per key, split over cells of the order axis.

A plain ``Window.partitionBy(key)`` puts a whole key into one task. Here each key is cut into cells along its
order axis: a map-side-combined summary per (key, cell) gives the value each cell starts with, that value enters
the cell as one extra row, and the row-level window runs per (key, cell). A key holding a third of the table
therefore spreads over as many tasks as it has cells; only the summary, one row per (key, cell), is ever ordered
per key.

The input is read by two branches (rows and summary). Ask for all running values of a step in one call, so that a
chain of steps does not double its input each time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KINDS = ("sum", "min", "max", "last")


@dataclass(frozen=True)
class Run:
    """One running value: ``kind`` is sum, min, max or last (last non-null).

    ``exclusive`` leaves the current row out; ``reverse`` runs from the end, so ``last`` means "next non-null".
    """

    kind: str
    value: Column
    exclusive: bool = False
    reverse: bool = False

    def __post_init__(self) -> None:
        if self.kind not in _KINDS:
            raise ValueError(f"unknown running value: {self.kind}")

    def of_cell(self, held: str, order: Sequence[str]) -> Column:
        value = F.col(held)
        if self.kind != "last":
            return getattr(F, self.kind)(value)
        at = F.when(value.isNotNull(), F.struct(*order))
        return F.min_by(value, at) if self.reverse else F.max_by(value, at)

    def over(self, held: str, window) -> Column:
        if self.kind == "last":
            return F.last(held, ignorenulls=True).over(window)
        return getattr(F, self.kind)(held).over(window)

    def along(self, columns: Sequence[str]) -> list[Column]:
        return [F.col(c).desc() if self.reverse else F.col(c).asc() for c in columns]


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cell: Column, outputs: Mapping[str, Run], keep_cell: bool = False
) -> DataFrame:
    """Add the running values of ``outputs`` to every row; ``cell`` must never decrease along ``order``. With ``keep_cell``
    the rows keep theirs as ``_cell``: they lie together by key and cell, so that a window over these needs no exchange."""
    keys, order = list(keys), list(order)
    held = {name: f"_held_{name}" for name in outputs}
    rows = df.withColumn("_cell", cell).withColumns({held[n]: run.value for n, run in outputs.items()})

    def before(run: Run):
        return Window.partitionBy(*keys).orderBy(*run.along(["_cell"])).rowsBetween(Window.unboundedPreceding, -1)

    def within(run: Run):
        end = -1 if run.exclusive else Window.currentRow
        return (
            Window.partitionBy(*keys, "_cell")
            .orderBy("_inner", *run.along(order))
            .rowsBetween(Window.unboundedPreceding, end)
        )

    carried = (
        rows.groupBy(*keys, "_cell")
        .agg(*[run.of_cell(held[n], order).alias(held[n]) for n, run in outputs.items()])
        .select(
            *keys,
            "_cell",
            F.lit(0).alias("_inner"),
            *[
                run.over(held[n], before(run)).cast(rows.schema[held[n]].dataType).alias(held[n])
                for n, run in outputs.items()
            ],
        )
    )
    return (
        rows.withColumn("_inner", F.lit(1))
        .unionByName(carried, allowMissingColumns=True)
        .withColumns({n: run.over(held[n], within(run)) for n, run in outputs.items()})
        .filter(F.col("_inner") == 1)
        .drop("_inner", *held.values(), *([] if keep_cell else ["_cell"]))
    )


def running_balance(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], diff: str, cell: Column, out: str = "balance"
) -> DataFrame:
    """Balance after each event, rebuilt from the diffs."""
    added = running(df, keys, order, cell, {out: Run("sum", F.col(diff))})
    return added.withColumn(out, F.col(out).cast(df.schema[diff].dataType))
