"""Interval sets as frames: one row per (keys, ``from``, ``to``), both ends included.

Integer axes step by 1; dates are carried as epoch milliseconds, which also step by 1. Everything is a sweep over
interval ends with running counts (see ``scan``), so no pairs of intervals are formed and a key with very many
intervals is spread over axis cells. ``cell_width`` is the length of such a cell in axis units.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.scan import Run, running

DEFAULT_CELL = 1 << 16


def _cell(position: str, width: int) -> Column:
    return F.floor(F.col(position) / F.lit(width)).cast("long")


def from_dates(df: DataFrame, lo: str = "from", hi: str = "to") -> DataFrame:
    """Date ranges on the millisecond axis; give operators on them a cell width in milliseconds (a day, say)."""
    return df.withColumns({lo: F.unix_millis(lo), hi: F.unix_millis(hi)})


def to_dates(df: DataFrame, lo: str = "from", hi: str = "to") -> DataFrame:
    return df.withColumns({lo: F.timestamp_millis(lo), hi: F.timestamp_millis(hi)})


def merge(
    ranges: DataFrame,
    keys: Sequence[str],
    *,
    gap: int = 1,
    cell_width: int = DEFAULT_CELL,
    distinct_starts: bool = False,
) -> DataFrame:
    """Union of each key's ranges as disjoint ranges.

    Ranges join when the next one starts at most ``gap`` after the previous end: 1 also joins adjacent ones, 0 only
    overlapping ones, larger values bridge holes (``from <= to + gap``). ``distinct_starts`` promises that no two
    ranges of a key start at the same place.
    """
    keys = list(keys)
    step = F.lit(gap)
    if not distinct_starts:  # copies collapse before the shuffle, however many there are
        ranges = ranges.groupBy(*keys, "from").agg(F.max("to").alias("to"))
    by_cell = Window.partitionBy(*keys, "_cell").orderBy("from")
    # 1. merge inside each cell
    local = (
        ranges.select(*keys, "from", "to")
        .withColumn("_cell", _cell("from", cell_width))
        .withColumn("_reach", F.max("to").over(by_cell.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_starts", F.col("_reach").isNull() | (F.col("from") > F.col("_reach") + step))
        .withColumn("_island", F.max(F.when(F.col("_starts"), F.col("from"))).over(by_cell))
        .groupBy(*keys, "_cell", "_island")
        .agg(F.max("to").alias("to"))
    )
    # 2. what reaches into each cell from the ones before, and the island it belongs to
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.col("_cell_reach_in").isNull() | (F.col("_last_start") > F.col("_cell_reach_in") + step)
    carried = (
        local.groupBy(*keys, "_cell")
        .agg(F.max("to").alias("_cell_reach"), F.max("_island").alias("_last_start"))
        .withColumn("_cell_reach_in", F.max("_cell_reach").over(earlier))
        .withColumn("_cell_island_in", F.max(F.when(begins, F.col("_last_start"))).over(earlier))
        .select(*keys, "_cell", "_cell_reach_in", "_cell_island_in")
    )
    # 3. join the islands across cells
    whole_cell = Window.partitionBy(*keys, "_cell")
    own = F.col("_reach_in").isNull() | (F.col("_island") > F.col("_reach_in") + step)
    return (
        local.unionByName(carried, allowMissingColumns=True)
        .withColumns({"_reach_in": F.max("_cell_reach_in").over(whole_cell), "_island_in": F.max("_cell_island_in").over(whole_cell)})
        .filter(F.col("_island").isNotNull())
        .withColumn("from", F.when(own, F.col("_island")).otherwise(F.col("_island_in")))
        .groupBy(*keys, "from")
        .agg(F.max("to").alias("to"))
    )


def _ends(ranges: DataFrame, keys: Sequence[str], counter: str) -> DataFrame:
    """+1 where a range starts, -1 just after it ends."""
    ends = ranges.select(*keys, "from", "to", F.explode(F.array(F.lit(1), F.lit(-1))).alias(counter))
    return ends.select(*keys, _end_place(counter).alias("_pos"), counter)


def _end_place(step: str) -> Column:
    return F.when(F.col(step) > 0, F.col("from")).otherwise(F.col("to") + F.lit(1)).cast("long")


def _boundaries(sets: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per key and position where any set changes, with each set's change there."""
    bounds = None
    for name, ranges in sets.items():
        ends = _ends(ranges, keys, f"_{name}")
        bounds = ends if bounds is None else bounds.unionByName(ends, allowMissingColumns=True)
    return bounds.groupBy(*keys, "_pos").agg(*[F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(f"_{n}") for n in sets])


def combine(
    sets: Mapping[str, DataFrame],
    keys: Sequence[str],
    inside: Callable[[Mapping[str, Column]], Column],
    *,
    cell_width: int = DEFAULT_CELL,
) -> DataFrame:
    """Maximal ranges on which a condition over the sets holds, per key, in one sweep over all their ends.

    ``inside`` gets, per set name, whether the set covers a stretch: ``lambda on: on["a"] & ~on["b"]``.
    """
    keys = list(keys)
    # where ranges only touch, one set's ends cancel out: nothing turns there, so these places are not swept
    bounds = _boundaries(sets, keys).filter(_any(F.col(f"_{name}") != 0 for name in sets))
    runs = {f"_open_{name}": Run("sum", F.col(f"_{name}")) for name in sets}
    swept = running(bounds, keys, ["_pos"], _cell("_pos", cell_width), runs, keep_cell=True)
    # the counts before a position are those after it less its own changes
    now = inside({name: F.col(f"_open_{name}") > 0 for name in sets})
    before = inside({name: F.col(f"_open_{name}") - F.col(f"_{name}") > 0 for name in sets})
    turns = swept.withColumn("_on", now).filter(F.col("_on") != before).select(*keys, "_cell", "_pos", "_on")
    return _between_turns(turns, keys).select(*keys, F.col("_pos").alias("from"), (F.col("_end") - 1).alias("to"))


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def _between_turns(turns: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each turn on with ``_end``, the key's next turn off. Turns (``_on``, ``_pos``) lie together by the keys and ``_cell``, or
    some of these."""
    # on and off alternate, so a range that begins at a turn ends at the next one: mostly in the same cell
    in_cell = Window.partitionBy(*keys, "_cell").orderBy("_pos")
    turns = turns.withColumns({"_next": F.lead("_pos").over(in_cell), "_previous": F.lag("_pos").over(in_cell)})
    # a turn whose counterpart lies in another cell meets those of its key, two of each cell at most
    is_edge = F.when(F.col("_on"), F.col("_next").isNull()).otherwise(F.col("_previous").isNull())
    turns = turns.withColumn("_edge", is_edge).filter(F.col("_on") | F.col("_edge"))
    together = Window.partitionBy(*keys, F.when(~F.col("_edge"), F.col("_cell"))).orderBy("_pos")
    end = F.when(F.col("_edge"), F.lead("_pos").over(together)).otherwise(F.col("_next"))
    return turns.withColumn("_end", end).filter("_on")


def combine_marked(
    ranges: DataFrame,
    keys: Sequence[str],
    marks: Sequence[str],
    outcomes: Mapping[str, Callable[[Mapping[str, Column]], Column]],
    *,
    kind: str = "kind",
    whole: str | None = None,
    cell_width: int = DEFAULT_CELL,
) -> DataFrame:
    """As ``combine``, for several conditions in one sweep. A row of ``ranges`` says by boolean columns, the ``marks``, in which
    sets it is; ``outcomes`` has a condition for each ``kind`` of range wanted. Of the mark and kind ``whole`` the ranges
    that end nowhere or before they start are kept as ``merge`` keeps them: with the largest end of their start, unless it
    touches others."""
    keys = list(keys)
    right = F.coalesce(F.col("from") <= F.col("to"), F.lit(False))
    # what counts of each mark, and a start of which only the largest end is to be known
    counts = {m: F.col(m) & right if m == whole else F.col(m) for m in marks}
    odd = F.lit(False) if whole is None else F.col(whole) & ~right & F.col("from").isNotNull() & (F.col("_step") > 0)
    bounds = (
        ranges.select(*keys, "from", "to", *marks, F.explode(F.array(F.lit(1), F.lit(-1))).alias("_step"))
        .groupBy(*keys, _end_place("_step").alias("_pos"))
        .agg(
            *(F.sum(F.when(c, F.col("_step")).otherwise(0)).alias(f"_{m}") for m, c in counts.items()),
            F.coalesce(F.max(odd), F.lit(False)).alias("_odd"),
            F.max(F.when(odd, F.col("to"))).cast("long").alias("_odd_to"),
        )
        # naming all columns here, so that both readers of the places (see ``running``) share their one exchange
        .filter(_any([F.col("_odd"), F.col("_odd_to").isNotNull(), *(F.col(f"_{m}") != 0 for m in marks)]))
    )
    runs = {f"_open_{m}": Run("sum", F.col(f"_{m}")) for m in marks}
    swept = running(bounds, keys, ["_pos"], _cell("_pos", cell_width), runs, keep_cell=True)
    now, before = {m: F.col(f"_open_{m}") > 0 for m in marks}, {m: F.col(f"_open_{m}") - F.col(f"_{m}") > 0 for m in marks}
    turn = lambda k, alone, on: F.struct(F.lit(k).alias(kind), F.lit(alone).alias("_alone"), on.alias("_on"))
    turns = [F.when(inside(now) != inside(before), turn(k, False, inside(now))) for k, inside in outcomes.items()]
    if whole is not None:
        turns.append(F.when(F.col("_odd") & ~now[whole] & ~before[whole], turn(whole, True, F.lit(True))))
    turned = (
        swept.filter(_any(t.isNotNull() for t in turns))
        .select(*keys, "_cell", "_pos", "_odd_to", F.explode(F.array_compact(F.array(*turns))).alias("_t"))
        .select(*keys, "_cell", "_pos", "_odd_to", f"_t.{kind}", "_t._alone", "_t._on")
    )
    to = F.when(F.col("_alone"), F.col("_odd_to")).otherwise(F.col("_end") - 1)
    return _between_turns(turned, [*keys, kind, "_alone"]).select(*keys, kind, F.col("_pos").alias("from"), to.alias("to"))


def combine_bounded(
    ranges: DataFrame,
    keys: Sequence[str],
    kind: str,
    kinds: Sequence[str],
    outcomes: Mapping[str, Callable[[Mapping[str, Column]], Column]],
) -> DataFrame:
    """As ``combine``, for sets told apart by a column ``kind`` and keys of which each holds no more than a task can: the
    parts of one cell, say. The ends of a key meet in one exchange, in one sweep for all conditions. ``outcomes`` has a
    condition for each kind of range wanted."""
    keys = list(keys)
    bounds = _ends(ranges.filter(F.col(kind).isin(list(kinds))).repartition(*keys), [*keys, kind], "_step")
    along = Window.partitionBy(*keys).orderBy("_pos")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = {f"_open_{i}": F.sum(F.when(F.col(kind) == k, F.col("_step")).otherwise(0)).over(so_far) for i, k in enumerate(kinds)}
    # the last of the ends at a place has counted them all
    swept = bounds.withColumns({**steps, "_next": F.lead("_pos").over(along)}).filter(F.col("_next").isNull() | (F.col("_next") != F.col("_pos")))
    on = {k: F.col(f"_open_{i}") > 0 for i, k in enumerate(kinds)}
    now = swept.select(*keys, "_pos", *(inside(on).alias(f"_on_{i}") for i, inside in enumerate(outcomes.values())))
    was = {f"_was_{i}": F.coalesce(F.lag(f"_on_{i}").over(along), F.lit(False)) for i in range(len(outcomes))}
    turn = lambda i, k: F.when(F.col(f"_on_{i}") != F.col(f"_was_{i}"), F.struct(F.lit(k).alias(kind), F.col(f"_on_{i}").alias("_on")))
    turns = F.filter(F.array(*(turn(i, k) for i, k in enumerate(outcomes))), lambda t: t.isNotNull())
    turned = now.withColumns(was).select(*keys, "_pos", F.explode(turns).alias("_t")).select(*keys, f"_t.{kind}", "_t._on", "_pos")
    # on and off alternate, so a range that begins at a turn ends at the next one
    end = F.lead("_pos").over(Window.partitionBy(*keys, kind).orderBy("_pos"))
    return turned.withColumn("_end", end).filter("_on").select(*keys, kind, F.col("_pos").alias("from"), (F.col("_end") - 1).alias("to"))


def exclude(
    base: DataFrame, removed: DataFrame, keys: Sequence[str], *, cell_width: int = DEFAULT_CELL
) -> DataFrame:
    """What is left of ``base`` after taking ``removed`` out, merged and disjoint."""
    return combine({"base": base, "removed": removed}, keys, lambda on: on["base"] & ~on["removed"], cell_width=cell_width)


def intersect(a: DataFrame, b: DataFrame, keys: Sequence[str], *, cell_width: int = DEFAULT_CELL) -> DataFrame:
    """Stretches covered by both sets."""
    return combine({"a": a, "b": b}, keys, lambda on: on["a"] & on["b"], cell_width=cell_width)


def union(a: DataFrame, b: DataFrame, keys: Sequence[str], *, cell_width: int = DEFAULT_CELL) -> DataFrame:
    columns = [*keys, "from", "to"]
    return merge(a.select(*columns).unionByName(b.select(*columns)), keys, cell_width=cell_width)


def clip(ranges: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Intersection with a single range; ranges outside it vanish."""
    return (
        ranges.filter((F.col("from") <= hi) & (F.col("to") >= lo))
        .withColumns({"from": F.greatest("from", lo), "to": F.least("to", hi)})
    )


def overlaps_within(
    ranges: DataFrame, keys: Sequence[str], *, cell_width: int = DEFAULT_CELL
) -> DataFrame:
    """Per key: does any range overlap another one of the same set?"""
    keys = list(keys)
    deepest = running(
        _boundaries({"a": ranges}, keys), keys, ["_pos"], _cell("_pos", cell_width), {"_open": Run("sum", F.col("_a"))}
    )
    return deepest.groupBy(*keys).agg((F.max("_open") > 1).alias("has_overlap"))


def overlaps_between(
    a: DataFrame, b: DataFrame, keys: Sequence[str], *, cell_width: int = DEFAULT_CELL
) -> DataFrame:
    """Per key of either set: does any range of ``a`` overlap one of ``b``?"""
    opened = {"_open_a": Run("sum", F.col("_a")), "_open_b": Run("sum", F.col("_b"))}
    swept = running(_boundaries({"a": a, "b": b}, keys), keys, ["_pos"], _cell("_pos", cell_width), opened)
    return swept.groupBy(*keys).agg(F.max((F.col("_open_a") > 0) & (F.col("_open_b") > 0)).alias("has_overlap"))


def covering(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ranges.groupBy(*keys).agg(F.min("from").alias("from"), F.max("to").alias("to"))


def _pieces(max_length: int | Column) -> Column:
    length = max_length if isinstance(max_length, Column) else F.lit(max_length)
    return F.ceil((F.col("to") - F.col("from") + F.lit(1)) / length).cast("long")


def split(ranges: DataFrame, max_length: int | Column, *, descending: bool = False, take: int | None = None) -> DataFrame:
    """Cut each range into pieces of at most ``max_length``, counted from its start, or from its end.

    With ``take`` only the first pieces of each range are made: no key can need more of one range than it keeps.
    """
    pieces = _pieces(max_length)
    if take is not None:
        pieces = F.least(pieces, F.lit(take).cast("long"))
    return _cut(ranges.filter(pieces > 0), max_length, pieces, descending).drop("_piece")


def _cut(ranges: DataFrame, max_length: int | Column, pieces: Column, descending: bool) -> DataFrame:
    """The first ``pieces`` of each range, numbered from 0 as ``_piece``."""
    length = max_length if isinstance(max_length, Column) else F.lit(max_length)
    numbered = ranges.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    if descending:
        to = F.col("to") - F.col("_piece") * length
        return numbered.withColumns({"to": to, "from": F.greatest("from", to - length + F.lit(1))})
    start = F.col("from") + F.col("_piece") * length
    return numbered.withColumns({"from": start, "to": F.least("to", start + length - F.lit(1))})


def plan_slices(
    ranges: DataFrame,
    keys: Sequence[str],
    max_length: int,
    take: int,
    *,
    descending: bool = False,
    cell_width: int = DEFAULT_CELL,
    disjoint: bool = False,
    first: Sequence[str] = (),
) -> DataFrame:
    """Merge overlapping ranges, cut them to ``max_length`` and keep the first ``take`` per key, ranked from 1.

    ``disjoint`` says the ranges are merged already; only then may columns be named that come ``first`` in the order. Ranges are
    ranked by how many slices lie before them, so that only they are ordered, and no slice is made that is not kept.
    """
    if max_length <= 0 or take <= 0:
        return ranges.select(*keys, "from", "to").limit(0).withColumn("rank", F.lit(0)).withColumns({c: F.lit(None) for c in first})
    merged = ranges.select(*keys, "from", "to", *first) if disjoint else merge(ranges, keys, gap=0, cell_width=cell_width)
    newest = F.col("from").desc() if descending else F.col("from").asc()
    earlier = Window.partitionBy(*keys).orderBy(*first, newest).rowsBetween(Window.unboundedPreceding, -1)
    counted = merged.withColumn("_pieces", F.least(_pieces(max_length), F.lit(take).cast("long"))).filter("_pieces > 0")
    placed = counted.withColumn("_before", F.coalesce(F.sum("_pieces").over(earlier), F.lit(0))).filter(F.col("_before") < take)
    kept = _cut(placed, max_length, F.least("_pieces", F.lit(take) - F.col("_before")), descending)
    return kept.select(*keys, "from", "to", (F.col("_before") + F.col("_piece") + 1).cast("int").alias("rank"), *first)


def blobs(
    ranges: DataFrame, keys: Sequence[str], merge_if_closer_than: int, slice_size: int, *, cell_width: int = DEFAULT_CELL
) -> DataFrame:
    """Ranges closer than a distance form one blob; blobs are cut into slices."""
    near = merge(ranges, keys, gap=max(1, merge_if_closer_than), cell_width=cell_width)
    return split(near, slice_size)


def tag_points(
    points: DataFrame,
    ranges: DataFrame,
    keys: Sequence[str],
    position: str,
    tags: Sequence[str | int],
    *,
    tag: str = "tag",
    cell_width: int = DEFAULT_CELL,
) -> DataFrame:
    """Add ``open_<tag>``: how many of the key's ranges carrying that tag contain the point."""
    keys = list(keys)
    counters = {f"open_{t}": F.coalesce(F.sum(F.when(F.col(tag) == F.lit(t), F.col("_end._step"))), F.lit(0)) for t in tags}
    ends = F.array(
        F.struct(F.col("from").cast("long").alias("_pos"), F.lit(1).alias("_step")),
        F.struct((F.col("to") + F.lit(1)).cast("long").alias("_pos"), F.lit(-1).alias("_step")),
    )
    bounds = (
        ranges.select(*keys, tag, F.explode(ends).alias("_end"))
        .groupBy(*keys, F.col("_end._pos").alias("_pos"))
        .agg(*[c.alias(f"_{n}") for n, c in counters.items()])
        .withColumn("_is_point", F.lit(0))
    )
    stream = (
        points.withColumns({"_pos": F.col(position).cast("long"), "_is_point": F.lit(1)})
        .unionByName(bounds, allowMissingColumns=True)
    )
    counted = running(
        stream,
        keys,
        ["_pos", "_is_point"],
        _cell("_pos", cell_width),
        {n: Run("sum", F.col(f"_{n}")) for n in counters},
    )
    return (
        counted.filter(F.col("_is_point") == 1)
        .withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in counters})
        .drop("_pos", "_is_point", *[f"_{n}" for n in counters])
    )


def points_inside(
    points: DataFrame, ranges: DataFrame, keys: Sequence[str], position: str, *, cell_width: int = DEFAULT_CELL
) -> DataFrame:
    """Points lying in at least one range of their key."""
    tagged = tag_points(points, ranges.withColumn("_in", F.lit(1)), keys, position, [1], tag="_in", cell_width=cell_width)
    return tagged.filter(F.col("open_1") > 0).drop("open_1")


def split_around_points(
    ranges: DataFrame, points: DataFrame, keys: Sequence[str], position: str, *, cell_width: int = DEFAULT_CELL
) -> DataFrame:
    """Scanned ranges as one-point ranges where something happened and the empty remainders around them."""
    hits = points_inside(points.select(*keys, position).distinct(), ranges, keys, position, cell_width=cell_width).select(
        *keys, F.col(position).cast("long").alias("from"), F.col(position).cast("long").alias("to")
    )
    empty = exclude(ranges, hits, keys, cell_width=cell_width)
    return hits.withColumn("has_events", F.lit(True)).unionByName(empty.withColumn("has_events", F.lit(False)))


def ranges_from_blocks(
    blocks: DataFrame,
    keys: Sequence[str],
    block: str,
    first_block: Column,
    latest_block: Column,
    max_length: Column | int,
) -> DataFrame:
    """Consecutive ranges between sampled blocks, stretched to the first and latest block, cut to ``max_length``.

    ``blocks`` holds one sample per time step, so a key's window is as long as the sampled grid.
    ``first_block`` and ``latest_block`` may use columns constant per key.
    """
    keys = list(keys)
    ordered = Window.partitionBy(*keys).orderBy("from")
    listed = (
        blocks.select(*keys, F.col(block).cast("long").alias("from"), first_block.alias("_first"), latest_block.alias("_latest"))
        .withColumns({"_next": F.lead("from").over(ordered), "_previous": F.lag("from").over(ordered)})
        .withColumn("_head", F.col("_previous").isNull())
        .filter(F.col("_next").isNotNull() | F.col("_previous").isNotNull())  # a single sample says nothing
    )
    between = listed.filter(F.col("_next").isNotNull()).select(*keys, "from", (F.col("_next") - 1).alias("to"))
    tail = listed.filter(F.col("_next").isNull() & (F.col("_latest") > F.col("from"))).select(
        *keys, "from", F.col("_latest").cast("long").alias("to")
    )
    head = listed.filter(F.col("_head") & (F.col("from") > F.col("_first"))).select(
        *keys, F.col("_first").cast("long").alias("from"), (F.col("from") - 1).alias("to")
    )
    whole = between.unionByName(tail).unionByName(head).filter(F.col("from") <= F.col("to"))
    return split(whole, max_length)
