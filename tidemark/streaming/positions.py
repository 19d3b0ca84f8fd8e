"""Per-position state over ordered events: running balance and first-in-first-out profit.

Events of a position must be applied in time order, so they wait in state until the watermark has passed them.
What waits is bounded by the lateness allowed, not by the length of the stream. It is kept in chunks of trades, and one
timer, set to the earliest of them, takes up all that the watermark has passed by then: a position costs a few calls to
its state for each micro-batch, however many trades it has.

Trades that come behind the watermark never reach the state, and the newest ones are still waiting when a run ends.
``complete`` finds both as landed trades without a result and works their positions out again from all their trades.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators import fifo
from tidemark.operators.latest import last_by

OUTPUT = (
    "investor_id INT, product_id INT, datetime TIMESTAMP, block_number BIGINT, balance DOUBLE, "
    "realized_pnl DOUBLE, remaining_shares DOUBLE, remaining_cost DOUBLE"
)
_BY_MICROS = OUTPUT.replace("datetime TIMESTAMP", "at BIGINT")
_RESULT = Row(*(c.split()[0] for c in _BY_MICROS.split(", ")))
# trades of a chunk lie within ``lo`` and ``hi``; times are epoch microseconds
_WAITING = "lo BIGINT, hi BIGINT, at ARRAY<BIGINT>, block_number ARRAY<BIGINT>, shares ARRAY<DOUBLE>, price ARRAY<DOUBLE>"
_LOTS = "shares ARRAY<DOUBLE>, price ARRAY<DOUBLE>"
# lots are numbered; those from ``head`` up to ``tail`` are open
_TOTALS = "balance DOUBLE, realized DOUBLE, held DOUBLE, cost DOUBLE, head BIGINT, tail BIGINT"
_NEVER = -(2**63)  # the time of a trade that has none
CHUNK = 4096  # trades of one entry of what waits
PAGE = 256  # lots of one state entry


class _Book:
    """The open lots of a position, in pages: only the first and the last one are held, and only what changed is written."""

    def __init__(self, pages, head: int, tail: int) -> None:
        self.pages, self.head, self.tail = pages, head, tail
        self.held, self.changed = {}, set()
        self.before, self.written = range(head // PAGE, -(-tail // PAGE)), set()  # pages that the state has

    def _page(self, n: int) -> tuple[list[float], list[float]]:
        if n not in self.held:
            self.held[n] = tuple(map(list, self.pages.getValue((n,)))) if self._stored(n) else ([], [])
        return self.held[n]

    def _stored(self, n: int) -> bool:
        return n in self.before or n in self.written

    def _write(self, n: int) -> None:
        if n in self.changed:
            self.pages.updateValue((n,), self.held[n])
            self.changed.discard(n)
            self.written.add(n)

    def open(self, shares: float, price: float) -> None:
        n = self.tail // PAGE
        page = self._page(n)
        page[0].append(shares)
        page[1].append(price)
        self.changed.add(n)
        self.tail += 1
        if self.tail % PAGE == 0 and n > self.head // PAGE:
            self._write(n)
            del self.held[n]

    def first(self) -> tuple[float, float]:
        shares, price = self._page(self.head // PAGE)
        at = self.head % PAGE
        return shares[at], price[at]

    def shorten(self, shares: float) -> None:
        n = self.head // PAGE
        self._page(n)[0][self.head % PAGE] = shares
        self.changed.add(n)

    def close(self) -> None:
        n = self.head // PAGE
        self.head += 1
        if self.head % PAGE == 0:
            self.held.pop(n, None)
            self.changed.discard(n)
            if self._stored(n):
                self.pages.removeKey((n,))

    def save(self) -> tuple[int, int]:
        for n in sorted(self.changed):
            self._write(n)
        return self.head, self.tail


class PositionProcessor(StatefulProcessor):
    """Open lots lie in pages of some hundreds: a trade touches only the pages of the lots it opens, closes or shortens."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.lots = handle.getMapState("lots", "n BIGINT", _LOTS)
        self.totals = handle.getValueState("totals", _TOTALS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = None
        # what has no block has no place in the order: it is left to ``complete``; what has no time comes first
        placed = (r for r in rows if r.block_number is not None)
        while own := [(_NEVER if r.at is None else r.at, r.block_number, _number(r.shares), _number(r.price)) for r in islice(placed, 16 * CHUNK)]:
            own.sort()
            self.waiting.appendList(list(_chunks(map(list, zip(*own)))))
            first = min(own[0][0], own[0][0] if first is None else first)
        if first is not None:
            self.handle.registerTimer(_due(first))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        ready, rest = [], []
        for chunk in self.waiting.get():
            lo, hi, *trades = chunk
            if hi <= reached:
                ready.append(trades)
            elif lo > reached:
                rest.append(chunk)
            else:  # sorted by time
                n = int(np.searchsorted(np.array(trades[0]), reached, side="right"))
                ready.append([column[:n] for column in trades])
                rest.extend(_chunks(column[n:] for column in trades))
        if not ready:  # an earlier timer has taken them up
            return
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(_due(min(chunk[0] for chunk in rest)))
        else:
            self.waiting.clear()
        yield from self._apply(key, _ordered(ready))

    def _apply(self, key, ready) -> Iterator[Row]:
        balance, realized, held, cost, head, tail = self.totals.get() or (0.0, 0.0, 0.0, 0.0, 0, 0)
        book = _Book(self.lots, head, tail)
        for at, block, shares, price in ready:
            balance += shares
            if shares > 0:
                book.open(shares, price)
                held, cost = held + shares, cost + shares * price
            left = -shares
            while left > 0 and book.head < book.tail:
                lot, entry = book.first()
                sold = min(left, lot)
                realized += sold * (price - entry)
                held, cost, left = held - sold, cost - sold * entry, left - sold
                if sold < lot:
                    book.shorten(lot - sold)
                else:
                    book.close()
            if book.head == book.tail:  # nothing held: shed what rounding left behind
                held = cost = 0.0
            shown = [None if math.isnan(x) else x for x in (balance, realized, held, cost)]
            yield _RESULT(key[0], key[1], None if at == _NEVER else at, block, *shown)
        self.totals.update((balance, realized, held, cost, *book.save()))

    def close(self) -> None:
        pass


def _number(value: float | None) -> float:
    return math.nan if value is None else value


def _due(at: int) -> int:
    return -(-at // 1000)


def _chunks(columns) -> Iterator[tuple]:
    """Columns of trades, in the order of time, as entries of what waits."""
    columns = list(columns)
    for n in range(0, len(columns[0]), CHUNK):
        part = [list(column[n : n + CHUNK]) for column in columns]
        yield (part[0][0], part[0][-1], *part)


def _ordered(chunks: list) -> Iterator[tuple]:
    """Trades of some chunks in the order of time, then block."""
    columns = [np.concatenate([np.asarray(chunk[c]) for chunk in chunks]) for c in range(4)]
    order = np.lexsort(columns[::-1])
    for n in range(0, len(order), CHUNK):
        yield from zip(*(column[order[n : n + CHUNK]].tolist() for column in columns))


def positions(trades: DataFrame, lateness: str) -> DataFrame:
    """Position after each trade. ``trades``: investor_id, product_id, datetime, block_number, shares, price.

    Start it inside ``rocksdb(spark)``.
    """
    applied = (
        trades.withWatermark("datetime", lateness)
        .withColumn("at", F.unix_micros("datetime"))
        .groupBy("investor_id", "product_id")
        .transformWithState(
            statefulProcessor=PositionProcessor(), outputStructType=_BY_MICROS, outputMode="Append", timeMode="EventTime"
        )
    )
    at = F.timestamp_micros("at").alias("datetime")
    return applied.select(*(at if c.startswith("datetime ") else c.split()[0] for c in OUTPUT.split(", ")))


def complete(stored: DataFrame, trades: DataFrame, cell: Column) -> DataFrame:
    """The last state of every position, whatever the order in which its trades came: from the stream's results where
    each of its landed trades has one, else worked out again from all of them."""
    keys = ["investor_id", "product_id"]
    columns = ["balance", "realized_pnl", "remaining_shares", "remaining_cost"]
    open_ = trades.join(stored.select(*keys, "datetime", "block_number"), [*keys, "datetime", "block_number"], "left_anti")
    affected = open_.select(*keys).distinct()
    settled = stored.join(affected, keys, "left_anti").groupBy(*keys)
    kept = settled.agg(*[last_by(c, "datetime", "block_number").alias(c) for c in columns])
    again = trades.join(affected, keys, "left_semi")
    worked_out = fifo.pnl(again, keys, ["datetime", "block_number"], cell).join(
        again.groupBy(*keys).agg(F.sum("shares").alias("balance")), keys
    )
    return kept.unionByName(worked_out.select(*keys, *columns))


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)
