"""Interval sets and import coverage. Blocks of the stand-in coverage are epoch days."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import range_columns as rc
from tidemark.operators import dyadic, intervals
from tidemark.plans import coverage as cov
from tidemark.plans import live_coverage as live
from tidemark.plans import valuation
from tidemark.queries.registry import query
from tidemark.session import scratch_path

AS_OF = datetime(2024, 2, 1)
KEY = ["import_key"]
CELL = 256

COVERED = "SELECT import_key, \"from\", \"to\" FROM coverage WHERE kind = 'covered'"
RETRY = "SELECT import_key, \"from\", \"to\" FROM coverage WHERE kind = 'retry'"
ALL = 'SELECT import_key, "from", "to" FROM coverage'


def merged_sql(source: str, gap: int = 1, key: str = "import_key") -> str:
    return f"""SELECT {key}, min("from") AS "from", max("to") AS "to" FROM (
        SELECT *, sum(starts) OVER (PARTITION BY {key} ORDER BY "from", "to" ROWS UNBOUNDED PRECEDING) AS island FROM (
          SELECT *, CASE WHEN "from" <= max("to") OVER (PARTITION BY {key} ORDER BY "from", "to" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 0 ELSE 1 END AS starts
          FROM ({source}))) GROUP BY {key}, island"""


def points_sql(source: str, key: str = "import_key") -> str:
    return f'SELECT DISTINCT {key}, unnest(generate_series("from", "to")) AS d FROM ({source})'


def islands_sql(points: str, key: str = "import_key") -> str:
    """Point set back to ranges."""
    return f"""SELECT {key}, min(d) AS "from", max(d) AS "to" FROM (
        SELECT {key}, d, d - row_number() OVER (PARTITION BY {key} ORDER BY d) AS g FROM ({points})) GROUP BY {key}, g"""


def excluded_sql(base: str, removed: str) -> str:
    return islands_sql(f"SELECT * FROM ({points_sql(base)}) EXCEPT SELECT * FROM ({points_sql(removed)})")


def covered(t):
    return cov.of_kind(t.coverage, cov.COVERED)


def retry(t):
    return cov.of_kind(t.coverage, cov.RETRY)


@query(
    "range_predicates", "I1 P18 F3",
    """SELECT import_key, "from", "to", "from" <= "to" AS valid, greatest(0, "to" - "from" + 1) AS size, 10000 BETWEEN "from" AND "to" AS holds,
       "from" <= 9990 AND 10010 <= "to" AS includes_window, "from" <= 10010 AND 9990 <= "to" AS overlaps_window, ("from" + "to" + 1) // 2 AS middle FROM coverage""",
)
def _(t):
    lo, hi, at = F.col("from"), F.col("to"), F.lit(10000)
    return t.coverage.select(
        "import_key", "from", "to",
        rc.is_valid(lo, hi).alias("valid"),
        rc.size(lo, hi).alias("size"),
        rc.contains_value(lo, hi, at).alias("holds"),
        rc.includes(lo, hi, F.lit(9990), F.lit(10010)).alias("includes_window"),
        rc.overlaps(lo, hi, F.lit(9990), F.lit(10010)).alias("overlaps_window"),
        rc.midpoint(lo, hi).alias("middle"),
    )


@query("ranges_merged", "I2 T12", merged_sql(COVERED))
def _(t):
    return intervals.merge(covered(t), KEY, cell_width=CELL)


@query("ranges_merged_overlapping_only", "I10 T12", merged_sql(COVERED, 0))
def _(t):
    return intervals.merge(covered(t), KEY, gap=0, cell_width=CELL)


@query(
    "ranges_overlap_within", "I3",
    """SELECT import_key, coalesce(bool_or("from" <= prev), false) AS has_overlap FROM (
       SELECT *, max("to") OVER (PARTITION BY import_key ORDER BY "from", "to" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM coverage WHERE kind = 'covered') GROUP BY 1""",
)
def _(t):
    return intervals.overlaps_within(covered(t), KEY, cell_width=CELL)


@query(
    "ranges_overlap_between", "I4",
    """SELECT k.import_key, EXISTS (SELECT 1 FROM coverage a JOIN coverage b ON a.import_key = b.import_key AND a.kind = 'covered' AND b.kind = 'retry' AND a."from" <= b."to" AND b."from" <= a."to"
       WHERE a.import_key = k.import_key) AS has_overlap FROM (SELECT DISTINCT import_key FROM coverage) k""",
)
def _(t):
    return intervals.overlaps_between(covered(t), retry(t), KEY, cell_width=CELL)


@query(
    "ranges_clipped", "I5",
    """SELECT import_key, greatest("from", 9800) AS "from", least("to", 10200) AS "to" FROM coverage WHERE kind = 'covered' AND "from" <= 10200 AND "to" >= 9800""",
)
def _(t):
    return intervals.clip(covered(t), F.lit(9800), F.lit(10200))


@query("ranges_excluded", "I6", excluded_sql(COVERED, RETRY))
def _(t):
    return intervals.exclude(covered(t), retry(t), KEY, cell_width=CELL)


@query(
    "ranges_intersected", "I5 O4",
    islands_sql(f"SELECT * FROM ({points_sql(COVERED)}) INTERSECT SELECT * FROM ({points_sql(RETRY)})"),
)
def _(t):
    return intervals.intersect(covered(t), retry(t), KEY, cell_width=CELL)


@query("ranges_covering", "I7 I8", 'SELECT import_key, min("from") AS "from", max("to") AS "to" FROM coverage GROUP BY 1')
def _(t):
    return intervals.covering(t.coverage, KEY)


@query(
    "ranges_split", "I9",
    f"""SELECT import_key, "from" + 15 * i AS "from", least("to", "from" + 15 * i + 14) AS "to" FROM (
       SELECT *, unnest(generate_series(0, ("to" - "from") // 15)) AS i FROM ({merged_sql(COVERED)}))""",
)
def _(t):
    return intervals.split(intervals.merge(covered(t), KEY, cell_width=CELL), 15)


_SLICES_DESC = """SELECT import_key, greatest("from", "to" - 10 * i - 9) AS "from", "to" - 10 * i AS "to" FROM (SELECT *, unnest(generate_series(0, ("to" - "from") // 10)) AS i FROM ({source}))"""
_SLICES_ASC = """SELECT import_key, "from" + 10 * i AS "from", least("to", "from" + 10 * i + 9) AS "to" FROM (SELECT *, unnest(generate_series(0, ("to" - "from") // 10)) AS i FROM ({source}))"""


def _ranked(source: str, direction: str, take: int) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY import_key ORDER BY "from" {direction}) AS rank FROM ({source})) WHERE rank <= {take}"""


@query("ranges_sliced_newest", "I10 L6", _ranked(_SLICES_DESC.format(source=merged_sql(COVERED, 0)), "DESC", 7))
def _(t):
    return intervals.plan_slices(covered(t), KEY, 10, 7, descending=True, cell_width=CELL).withColumn("rank", F.col("rank").cast("bigint"))


@query("ranges_sliced_oldest", "I10", _ranked(_SLICES_ASC.format(source=merged_sql(COVERED, 0)), "ASC", 7))
def _(t):
    return intervals.plan_slices(covered(t), KEY, 10, 7, cell_width=CELL).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "range_blobs", "I11",
    f"""SELECT import_key, "from" + 100 * i AS "from", least("to", "from" + 100 * i + 99) AS "to" FROM (SELECT *, unnest(generate_series(0, ("to" - "from") // 100)) AS i FROM ({merged_sql(ALL, 30)}))""",
)
def _(t):
    return intervals.blobs(t.coverage.drop("kind"), KEY, 30, 100, cell_width=CELL)


_RESULTS = """SELECT 'product:investment:' || CAST(o_custkey + 1 AS VARCHAR) AS import_key, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 20 AS "from",
   date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 25 + o_orderkey % 10 AS "to", o_orderkey % 4 <> 0 AS success, 11500 + o_orderkey % 300 AS latest FROM orders"""
_FAILED = f'SELECT import_key, "from", "to" FROM ({_RESULTS}) WHERE NOT success'
_GOOD = f'SELECT import_key, "from", "to" FROM ({_RESULTS}) WHERE success'


def results(t):
    start = F.datediff("o_orderdate", F.lit("1970-01-01")).cast("long")
    return t.raw("orders").select(
        F.concat(F.lit("product:investment:"), (F.col("o_custkey") + 1).cast("string")).alias("import_key"),
        (start + 20).alias("from"),
        (start + 25 + F.pmod("o_orderkey", F.lit(10))).alias("to"),
        (F.pmod("o_orderkey", F.lit(4)) != 0).alias("success"),
        (F.lit(11500) + F.pmod("o_orderkey", F.lit(300))).alias("latest"),
    )


_FOLDED_RETRY = islands_sql(
    f"""SELECT * FROM ((SELECT * FROM ({points_sql(RETRY)}) EXCEPT (SELECT * FROM ({points_sql(_GOOD)}) EXCEPT SELECT * FROM ({points_sql(_FAILED)})))
        UNION SELECT * FROM ({points_sql(_FAILED)}))"""
)


_AFTER_RESULTS = f"""SELECT import_key, 'covered' AS kind, "from", "to" FROM ({merged_sql(COVERED + f' UNION ALL SELECT import_key, "from", "to" FROM ({_RESULTS})')})
        UNION ALL SELECT import_key, 'retry', "from", "to" FROM ({_FOLDED_RETRY})"""


@query("coverage_after_results", "I12 I13", _AFTER_RESULTS)
def _(t):
    return cov.fold_results(t.states, t.coverage, results(t), AS_OF, CELL)[1]


def live_table(t, width):
    """The coverage, and the results as a stream of files, each delivered once more by a second stream."""
    path, landed = scratch_path(t.spark, "coverage"), scratch_path(t.spark, "results")
    live.add(t.spark, path, t.coverage, width)
    rows = results(t).select("import_key", "from", "to", "success")
    rows.repartition(3).write.parquet(landed)
    for _ in range(2):
        stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(landed)
        live.write_results(stream, path, scratch_path(t.spark, "results-checkpoint"), width).awaitTermination()
    return path


@query("live_coverage", "I12 I13 ST1 ST7 ST8 ST10", _AFTER_RESULTS)
def _(t):
    return live.ranges_of(live.parts_of(t.spark, live_table(t, 256), 256))


@query(
    "live_coverage_settled", "I12 I13 ST7",
    f"""SELECT import_key, 'covered' AS kind, "from", "to" FROM ({merged_sql(COVERED + f' UNION ALL {RETRY} UNION ALL SELECT import_key, "from", "to" FROM ({_RESULTS})')})""",
)
def _(t):
    # a second run loads everything that was to be retried: it is covered, and nothing is left in the queue
    path, settled = live_table(t, 512), scratch_path(t.spark, "settled")
    live.settle(t.spark, path, settled, 512)
    queued = live.ranges_of(live.parts_of(t.spark, settled, 512)).filter(F.col("kind") == cov.RETRY)
    done = scratch_path(t.spark, "queued")
    queued.write.parquet(done)
    live.add(t.spark, settled, live.kinds_of(t.spark.read.parquet(done).withColumn("success", F.lit(True))), 512)
    return live.ranges_of(live.parts_of(t.spark, settled, 512))


@query(
    "states_after_results", "I13",
    f"""SELECT s.import_key, greatest(s.chain_latest_block_number, coalesce(r.latest, 0)) AS chain_latest_block_number,
        CASE WHEN r.latest IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE s.last_import_date END AS last_import_date
        FROM states s LEFT JOIN (SELECT import_key, max(latest) AS latest FROM ({_RESULTS}) GROUP BY 1) r USING (import_key)""",
)
def _(t):
    return cov.fold_results(t.states, t.coverage, results(t), AS_OF, CELL)[0].select("import_key", "chain_latest_block_number", "last_import_date")


@query(
    "results_overlapping", "I13 I3",
    f"""SELECT DISTINCT import_key FROM (SELECT *, max("to") OVER (PARTITION BY import_key ORDER BY "from", "to" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM ({_RESULTS})) WHERE "from" <= prev""",
)
def _(t):
    return cov.overlapping_results(results(t), CELL)


_FULL = 'SELECT import_key, contract_created_at_block AS "from", chain_latest_block_number AS "to" FROM states'


@query(
    "import_plan", "I14 L6 ST7",
    f"""SELECT import_key, "from", "to", is_retry, rank FROM (SELECT *, row_number() OVER (PARTITION BY import_key ORDER BY is_retry, r) AS rank FROM (
         SELECT import_key, "from", "to", rank AS r, false AS is_retry FROM ({_ranked(_SLICES_DESC.format(source=excluded_sql(_FULL, ALL)).replace('10', '30').replace('- 9)', '- 29)'), 'DESC', 50)})
         UNION ALL SELECT import_key, "from", "to", rank, true FROM ({_ranked(_SLICES_DESC.format(source=merged_sql(RETRY, 0)).replace('10', '30').replace('- 9)', '- 29)'), 'DESC', 50)}))) WHERE rank <= 50""",
)
def _(t):
    windows = t.states.select("import_key", F.col("contract_created_at_block").alias("from"), F.col("chain_latest_block_number").alias("to"))
    return cov.plan_import(windows, t.coverage, 30, 50, cell_width=CELL).withColumn("rank", F.col("rank").cast("bigint"))


_WHOLE_PLAN = f"""SELECT import_key, "from", "to" FROM ({_ranked(_SLICES_DESC.format(source=excluded_sql(_FULL, ALL)).replace('10', '30').replace('- 9)', '- 29)'), 'DESC', 10**6)})
         UNION ALL SELECT import_key, "from", "to" FROM ({_ranked(_SLICES_DESC.format(source=merged_sql(RETRY, 0)).replace('10', '30').replace('- 9)', '- 29)'), 'DESC', 10**6)})"""


@query("import_rounds", "ST7 I13 I14", f"SELECT (SELECT count(*) FROM ({_WHOLE_PLAN})) AS planned, CAST(0 AS BIGINT) AS planned_again")
def _(t):
    # plan, load what was planned, note the results, plan again: nothing is left
    windows = t.states.select("import_key", F.col("contract_created_at_block").alias("from"), F.col("chain_latest_block_number").alias("to"))
    path, noted = scratch_path(t.spark, "plan"), scratch_path(t.spark, "noted")
    cov.plan_import(windows, t.coverage, 30, 10**6, cell_width=CELL).write.parquet(path)
    planned = t.spark.read.parquet(path)
    loaded = planned.select("import_key", "from", "to", F.lit(True).alias("success"), F.col("to").alias("latest"))
    _, known = cov.fold_results(t.states, t.coverage, loaded, AS_OF, CELL)
    known.write.parquet(noted)  # the new windows and the queue are both planned from it
    again = cov.plan_import(windows, t.spark.read.parquet(noted), 30, 10**6, cell_width=CELL)
    return planned.agg(F.count("*").alias("planned")).select("planned", again.agg(F.count("*")).scalar().alias("planned_again"))


@query(
    "recent_windows", "I15 ST7 ST11",
    """SELECT import_key, greatest(5, chain_latest_block_number - least(1000, 86400000 // 120000)) - 5 AS "from", chain_latest_block_number - 5 AS "to" FROM states""",
)
def _(t):
    windows = cov.window_to_consider(t.states, F.col("chain_latest_block_number"), historical=False, max_blocks_per_query=1000, ms_per_block=120_000)
    return windows.select("import_key", "from", "to")


@query(
    "historical_windows", "I15 ST7",
    """SELECT s.import_key, greatest(contract_created_at_block, 9100) AS "from",
       least(CASE WHEN p.is_eol THEN chain_latest_block_number - 5 ELSE least(chain_latest_block_number - 5, greatest(5, chain_latest_block_number - 720) - 5) END, 11200) AS "to"
       FROM states s JOIN products p USING (product_id)""",
)
def _(t):
    from tidemark.functions.json_fields import is_eol

    states = t.states.join(t.products.select("product_id", (~is_eol(F.col("product_data"))).alias("is_live")), "product_id")
    windows = cov.window_to_consider(
        states, F.col("chain_latest_block_number"), historical=True, max_blocks_per_query=1000, ms_per_block=120_000,
        is_live=F.col("is_live"), skip_recent="live", forced=(9100, 11200),
    )
    return windows.select("import_key", "from", "to")


@query("retries_clamped", "I15 I5", merged_sql(f'SELECT import_key, greatest("from", 9100) AS "from", least("to", 9900) AS "to" FROM ({RETRY}) WHERE "from" <= 9900 AND "to" >= 9100'))
def _(t):
    return cov.clamp_retries(retry(t), 9100, 9900, CELL)


@query(
    "recent_date_windows", "I16",
    """SELECT import_key, greatest(last_import_date, TIMESTAMP '2024-02-01' - INTERVAL 30 DAY) AS "from", TIMESTAMP '2024-02-01' AS "to" FROM states""",
)
def _(t):
    lo, hi = cov.recent_date_window(F.col("last_import_date"), AS_OF, "1month")
    return t.states.select("import_key", lo.alias("from"), hi.alias("to"))


_SAMPLES = """SELECT chain, max(block_number) AS b FROM (SELECT chain, time_bucket(INTERVAL '1 day', datetime) AS d, last(block_number ORDER BY datetime, block_number) AS block_number FROM blocks GROUP BY 1, 2) GROUP BY chain, d"""


@query(
    "ranges_from_block_list", "I17 T11 D14 I18",
    f"""WITH s AS ({_SAMPLES}), m AS (SELECT chain, min(b) AS lo, max(b) AS hi FROM s GROUP BY 1),
        r AS (SELECT chain, b AS "from", lead(b) OVER (PARTITION BY chain ORDER BY b) - 1 AS "to" FROM s QUALIFY "to" IS NOT NULL
              UNION ALL SELECT chain, hi, hi + 300 FROM m UNION ALL SELECT chain, 0, lo - 1 FROM m WHERE lo > 0),
        x AS (SELECT chain, "from" + 50 * i AS "from", least("to", "from" + 50 * i + 49) AS "to" FROM (SELECT *, unnest(generate_series(0, ("to" - "from") // 50)) AS i FROM r WHERE "from" <= "to"))
        SELECT chain, "from", "to", ("from" + "to" + 1) // 2 AS snapshot_block FROM x""",
)
def _(t):
    from tidemark.functions.timegrid import time_bucket
    from tidemark.operators.latest import last_by

    listed = t.blocks.groupBy("chain", time_bucket("1day", F.col("datetime")).alias("d")).agg(
        last_by("block_number", "datetime", "block_number").alias("interpolated_block_number")
    )
    latest = listed.groupBy("chain").agg((F.max("interpolated_block_number") + 300).alias("latest"))
    return valuation.snapshot_ranges(listed.join(latest, "chain"), F.lit(0), F.col("latest"), 50)


@query(
    "scan_split_around_events", "I19",
    f"""WITH r AS (SELECT 'all' AS k, 0 AS "from", 4 + max(event_id) // 3 AS "to" FROM events), p AS (SELECT DISTINCT 'all' AS k, event_id // 3 AS d FROM events WHERE event_type = 'purchase')
        SELECT k, d AS "from", d AS "to", true AS has_events FROM p
        UNION ALL SELECT k, "from", "to", false FROM ({islands_sql('SELECT k, unnest(generate_series("from", "to")) AS d FROM r EXCEPT SELECT * FROM p', 'k')})""",
)
def _(t):
    events = t.raw("events").select(F.lit("all").alias("k"), F.floor(F.col("event_id") / 3).alias("block"), "event_type")
    scanned = events.groupBy("k").agg(F.lit(0).cast("long").alias("from"), (F.max("block") + 4).alias("to"))
    hits = events.filter(F.col("event_type") == "purchase")
    return intervals.split_around_points(scanned, hits, ["k"], "block")


@query(
    "coverage_after_reimport_request", "I20",
    f"""SELECT import_key, 'covered' AS kind, "from", "to" FROM ({merged_sql(COVERED + ' UNION ALL SELECT import_key, greatest(9400, contract_created_at_block + 1), chain_latest_block_number FROM states WHERE greatest(9400, contract_created_at_block + 1) <= chain_latest_block_number')})
        UNION ALL SELECT import_key, 'retry', "from", "to" FROM ({merged_sql(RETRY + ' UNION ALL SELECT import_key, greatest(9400, contract_created_at_block + 1), chain_latest_block_number FROM states WHERE greatest(9400, contract_created_at_block + 1) <= chain_latest_block_number')})""",
)
def _(t):
    return cov.schedule_reimport(t.states, t.coverage, 9400, cell_width=CELL)


@query(
    "points_in_own_ranges", "I21 J13",
    """SELECT p.import_key, p.d, p.id FROM (SELECT 'product:investment:' || CAST(l_partkey + 1 AS VARCHAR) AS import_key, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS d, l_orderkey * 8 + l_linenumber AS id FROM lineitem) p
       WHERE EXISTS (SELECT 1 FROM coverage c WHERE c.import_key = p.import_key AND c.kind = 'covered' AND p.d BETWEEN c."from" AND c."to")""",
)
def _(t):
    points = t.raw("lineitem").select(
        F.concat(F.lit("product:investment:"), (F.col("l_partkey") + 1).cast("string")).alias("import_key"),
        F.datediff("l_shipdate", F.lit("1970-01-01")).cast("bigint").alias("d"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
    )
    return intervals.points_inside(points, covered(t), KEY, "d", cell_width=1)  # days


@query(
    "points_in_indexed_ranges", "I21 J13 I4",
    """SELECT p.import_key, p.d, p.id FROM (SELECT 'product:investment:' || CAST(l_partkey + 1 AS VARCHAR) AS import_key, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS d, l_orderkey * 8 + l_linenumber AS id FROM lineitem) p
       WHERE EXISTS (SELECT 1 FROM coverage c WHERE c.import_key = p.import_key AND p.d BETWEEN c."from" AND c."to")""",
)
def _(t):
    # the same question as an equality join, over covered and queued ranges
    points = t.raw("lineitem").select(
        F.concat(F.lit("product:investment:"), (F.col("l_partkey") + 1).cast("string")).alias("import_key"),
        F.datediff("l_shipdate", F.lit("1970-01-01")).cast("bigint").alias("d"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
    )
    return dyadic.points_inside(points, t.coverage, KEY, "d")


@query(
    "date_ranges_merged", "I2 F4",
    f"""SELECT import_key, make_timestamp("from" * 1000) AS "from", make_timestamp("to" * 1000) AS "to", "to" - "from" + 1 AS size_ms FROM ({merged_sql('SELECT import_key, "from" * 86400000 AS "from", "to" * 86400000 + 86399999 AS "to" FROM coverage')})""",
)
def _(t):
    day = F.lit(86_400_000)
    dated = intervals.to_dates(t.coverage.select("import_key", (F.col("from") * day).alias("from"), (F.col("to") * day + F.lit(86_399_999)).alias("to")))
    merged = intervals.to_dates(intervals.merge(intervals.from_dates(dated), KEY, cell_width=86_400_000 * CELL))
    return merged.withColumn("size_ms", rc.date_range_size_ms(F.col("from"), F.col("to")))


@query(
    "range_array_sizes", "F3 F4 F5",
    """SELECT o_orderkey, (o_orderkey % 40 + 1) + (o_orderkey % 7 + 1) AS int_size, (o_orderkey % 40 + 1) * 86400000 - 86399999 AS date_size_ms, o_orderkey % 40 >= 10 AS has_ten FROM orders""",
)
def _(t):
    long = lambda c: c.cast("string")
    n, m = F.pmod("o_orderkey", F.lit(40)), F.pmod("o_orderkey", F.lit(7))
    text = F.concat(F.lit('[{"from":0,"to":'), long(n), F.lit('},{"from":100,"to":'), long(m + 100), F.lit("}]"))
    parsed = F.from_json(text, rc.RANGES_JSON)
    dates = F.array(F.struct(F.col("o_orderdate").alias("from"), F.timestamp_seconds(F.unix_seconds("o_orderdate") + n * 86400).alias("to")))
    return t.raw("orders").select(
        "o_orderkey",
        rc.ranges_size_sum(parsed).alias("int_size"),
        rc.date_ranges_size_sum_ms(dates).alias("date_size_ms"),
        rc.any_range_includes(parsed, F.lit(0), F.lit(10)).alias("has_ten"),
    )


COVERAGE_METRICS = """WITH m AS (SELECT chain, max(chain_latest_block_number) AS latest FROM states GROUP BY 1),
       r AS (SELECT import_key, coalesce(sum("to" - "from" + 1) FILTER (WHERE kind = 'covered'), 0) AS covered, coalesce(sum("to" - "from" + 1) FILTER (WHERE kind = 'retry'), 0) AS retry FROM coverage GROUP BY 1)
       SELECT p.chain, s.type AS import_type, p.is_eol AS eol, CAST(sum(coalesce(retry, 0)) AS BIGINT) AS errors_count, CAST(sum(coalesce(covered, 0)) - sum(coalesce(retry, 0)) AS BIGINT) AS success_count,
         CAST(sum(m.latest - s.contract_created_at_block + 1) - sum(coalesce(covered, 0)) AS BIGINT) AS not_covered_yet, TIMESTAMP '2024-02-01' AS datetime
       FROM products p JOIN states s USING (product_id) LEFT JOIN m ON m.chain = p.chain LEFT JOIN r ON r.import_key = s.import_key GROUP BY 1, 2, 3"""


@query("coverage_metrics", "A13 J20 ST6", COVERAGE_METRICS)
def _(t):
    return cov.metrics(t.products, t.states, t.coverage, AS_OF)


@query("chain_latest_indexed", "A14 Q7", "SELECT chain, type, max(chain_latest_block_number) AS latest_indexed_block FROM states GROUP BY 1, 2")
def _(t):
    return cov.chain_latest(t.states)


@query(
    "chain_has_retries", "A15 Q7",
    "SELECT chain, type, bool_or(EXISTS (SELECT 1 FROM coverage c WHERE c.import_key = s.import_key AND c.kind = 'retry')) AS has_anything_to_retry FROM states s GROUP BY 1, 2",
)
def _(t):
    return cov.chain_has_retries(t.states, t.coverage)


@query(
    "block_coverage_status", "Q21 A15 P18",
    """SELECT s.import_key, epoch_us(TIMESTAMP '2024-02-01' - last_import_date) / 1e6 AS last_import_age_sec,
       EXISTS (SELECT 1 FROM coverage c WHERE c.import_key = s.import_key AND c.kind = 'retry' AND 10000 BETWEEN c."from" AND c."to") AS is_in_retry_queue,
       EXISTS (SELECT 1 FROM coverage c WHERE c.import_key = s.import_key AND c.kind = 'covered' AND 10000 BETWEEN c."from" AND c."to") AS is_covered FROM states s""",
    "last_import_age_sec",
)
def _(t):
    return cov.block_status(t.states, t.coverage, 10000, AS_OF)


@query(
    "import_results_over_time", "J13 W4",
    """WITH s AS (SELECT s.import_key, s.product_id, p.chain, s.contract_created_at_block FROM states s JOIN products p USING (product_id)),
       b AS (SELECT chain, unnest(generate_series(9100, 11500, 100)) AS block_number, TIMESTAMP '2024-01-01' + to_hours(CAST((unnest(generate_series(9100, 11500, 100)) - 9100) // 100 AS INT)) AS datetime FROM (SELECT DISTINCT chain FROM blocks)),
       r AS (SELECT s.import_key, 0 AS status, s.contract_created_at_block AS "from", 11600 AS "to" FROM s UNION ALL SELECT import_key, CASE kind WHEN 'retry' THEN 2 ELSE 1 END, "from", "to" FROM coverage)
       SELECT s.product_id, b.datetime, max(r.status) AS range_result FROM s JOIN b USING (chain) JOIN r ON r.import_key = s.import_key AND b.block_number BETWEEN r."from" AND r."to" GROUP BY 1, 2""",
)
def _(t):
    chains = t.blocks.select("chain").distinct()
    steps = chains.withColumn("block_number", F.explode(F.sequence(F.lit(9100), F.lit(11500), F.lit(100)))).withColumn(
        "datetime", F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + (F.col("block_number") - 9100) * 36)
    )
    return cov.import_results_over_time(steps, t.products, t.states, t.coverage, chains.withColumn("max_block", F.lit(11600)))


@query(
    "creation_info_by_product", "Q9 J20",
    "SELECT p.product_id, p.chain, s.contract_created_at_block, s.contract_creation_date FROM products p JOIN states s USING (product_id)",
)
def _(t):
    return cov.creation_info(t.products, t.states)


@query(
    "creation_info_by_feed", "Q9 D12",
    """SELECT price_feed_1_id AS price_feed_id, first(product_id ORDER BY contract_creation_date, contract_created_at_block, product_id) AS product_id,
       first(chain ORDER BY contract_creation_date, contract_created_at_block, product_id) AS chain, first(contract_created_at_block ORDER BY contract_creation_date, contract_created_at_block, product_id) AS contract_created_at_block,
       min(contract_creation_date) AS contract_creation_date FROM (SELECT p.price_feed_1_id, p.product_id, p.chain, s.contract_created_at_block, s.contract_creation_date FROM products p JOIN states s USING (product_id) WHERE price_feed_1_id IS NOT NULL) GROUP BY 1""",
)
def _(t):
    return cov.creation_info(t.products, t.states, "price_feed_1_id")


@query(
    "import_work_order", "L5",
    "SELECT s.import_key, last_import_date + CASE WHEN p.is_eol THEN INTERVAL 100 DAY ELSE INTERVAL 0 DAY END AS due FROM states s JOIN products p USING (product_id) ORDER BY 2",
)
def _(t):
    from tidemark.functions.json_fields import is_eol

    states = t.states.join(t.products.select("product_id", is_eol(F.col("product_data")).alias("is_eol")), "product_id")
    return cov.work_order(states, ~F.col("is_eol")).select("import_key", "due")


@query(
    "coverage_reset", "S16",
    """SELECT import_key, kind, "from", "to" FROM coverage WHERE import_key NOT IN (SELECT 'product:investment:' || CAST(product_id AS VARCHAR) FROM products WHERE is_eol)""",
)
def _(t):
    from tidemark.functions.json_fields import is_eol
    from tidemark.plans.monitoring import investment_key

    retired = t.products.filter(is_eol(F.col("product_data"))).select(investment_key(F.col("product_id")).alias("import_key"))
    return cov.reset_ranges(t.coverage, retired)


@query("trusted_blocks", "ST11", "SELECT b.* FROM blocks b JOIN (SELECT chain, max(block_number) AS m FROM blocks GROUP BY 1) USING (chain) WHERE block_number <= m - 5")
def _(t):
    latest = t.blocks.groupBy("chain").agg(F.max("block_number").alias("max_block"))
    return cov.trusted_blocks(t.blocks, latest).select("datetime", "chain", "block_number")


@query(
    "parent_results", "ST10",
    """SELECT o_orderkey, coalesce((SELECT bool_and(l_returnflag <> 'R') FROM lineitem WHERE l_orderkey = o_orderkey), true) AS success FROM orders""",
)
def _(t):
    children = t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") != "R").alias("success"))
    return cov.parent_results(t.raw("orders").select("o_orderkey"), children, ["o_orderkey"])
