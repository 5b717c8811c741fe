"""Snapshot and revision queries, in batch form and as a stream that runs to its end.

Both forms must give the same rows, so they share their SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedupe import union_by_name
from ..operators.enrich import lookup
from ..operators.sketches import DISTINCT_ERROR, RANK_ERROR, DailyQuality
from ..sources.staging import shared_folder, staged
from ..streaming.counters import changes_schema, run_counter_changes
from ..streaming.log import BatchLog, landed
from ..streaming.refresh import Derived, RefreshedPanel
from ..streaming.revisions import merge_revisions, merge_stream
from ..streaming.snapshots import accumulate, accumulate_stream, snapshot_changes
from .book import query, rounded
from .tables import COUNTER_SQL, EVENTS, EVENTS_SQL, NATIONS, NATIONS_SQL, change_sql, events_panel, lag_sql, load, nations_counter, nations_panel, ramp_sql, running

E = "event_type"
TOTALS = {"total": "new_reported"}


# snapshots ------------------------------------------------------------------------
def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """What each daily run would have reported: everything up to its day."""
    return events_panel(spark, sf).select(E, "d", running(EVENTS, "n").alias("total"))


SNAPSHOT_SQL = f"""
WITH s AS (SELECT event_type, d, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY d) AS BIGINT) AS total FROM ({EVENTS_SQL})),
     h AS (SELECT DISTINCT * FROM (SELECT * FROM s UNION ALL SELECT * FROM s WHERE d >= DATE '2024-01-25'))
SELECT event_type, d, total, total - lag(total) OVER (PARTITION BY event_type ORDER BY d) AS new_reported FROM h"""


def repeated(all_runs: DataFrame) -> DataFrame:
    """Runs that were started a second time."""
    return all_runs.where(F.col("d") >= F.lit("2024-01-25").cast("date"))


@query("snapshot_accumulate", SNAPSHOT_SQL)
def snapshot_accumulate(spark: SparkSession, sf: str) -> DataFrame:
    runs = snapshots(spark, sf)
    return snapshot_changes(accumulate(runs, repeated(runs)), (E,), "d", TOTALS)


def work_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/streams/{name}-{uuid.uuid4().hex}"


@query("snapshot_accumulate_stream", SNAPSHOT_SQL)
def snapshot_accumulate_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "snapshots")
    runs = snapshots(spark, sf)
    runs.write.parquet(f"{folder}/landing")
    repeated(runs).write.mode("append").parquet(f"{folder}/landing")
    log = BatchLog(spark, f"{folder}/log", runs.schema, day="d")
    history = accumulate_stream(landed(spark, f"{folder}/landing", runs.schema, 1), log, f"{folder}/progress")
    return snapshot_changes(history, (E,), "d", TOTALS)


@query("snapshot_log_compacted", SNAPSHOT_SQL)
def snapshot_log_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Ten batches of three days each; the log merges its parts on the way."""
    folder = work_folder(spark, "snapshots")
    runs = staged(snapshots(spark, sf), "runs")
    log = BatchLog(spark, f"{folder}/log", runs.schema, day="d", tier=4)
    every = runs.unionByName(repeated(runs))
    for batch in range(10):
        log.append(every.where((F.dayofmonth("d") - 1) % 30 % 10 == batch).distinct(), "run", batch)
    return snapshot_changes(log.read().drop("run", "batch").distinct(), (E,), "d", TOTALS)


@query("counter_delta_stream", f"SELECT n_name, d, cum, cum - {lag_sql('cum', 1, 'n_name')} AS change FROM ({COUNTER_SQL})")
def counter_delta_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The orders counter of each nation in four files; some rows of the last days of a file come with the next."""
    folder = work_folder(spark, "counters")
    counter = staged(nations_counter(spark, sf), "counter")
    months = (F.year("d") - 1995) * 12 + F.month("d") - 1
    delayed = (months % 20 == 19) & (F.dayofmonth("d") > 20) & (F.dayofmonth("d") % 3 == 0)
    batch = F.floor(months / 20) + delayed.cast("int")
    schema = changes_schema(counter, ["n_name"], "d", "cum", "change")
    log = BatchLog(spark, f"{folder}/log", schema, day="d")
    for k in range(5):
        counter.where(batch == k).coalesce(1).write.mode("append").parquet(f"{folder}/source")
    source = landed(spark, f"{folder}/source", counter.schema, 1)
    return run_counter_changes(source, log, f"{folder}/progress", ["n_name"], "d", "cum", "change", keep_days=30).drop("late")


# revisions --------------------------------------------------------------------------
REVISION_SQL = f"""
WITH s AS (SELECT 0 AS source_rank, 0 AS version, * FROM ({EVENTS_SQL}) WHERE d < DATE '2024-01-25'
     UNION ALL SELECT 1, 1, event_type, d, n + 1, v FROM ({EVENTS_SQL}) WHERE d >= DATE '2024-01-20'
     UNION ALL SELECT 1, 2, event_type, d, n + 2, v FROM ({EVENTS_SQL}) WHERE d >= DATE '2024-01-27')
SELECT event_type, d, n, v, source_rank, version FROM s
QUALIFY row_number() OVER (PARTITION BY event_type, d ORDER BY source_rank, version DESC) = 1"""


def revision_files(spark: SparkSession, sf: str) -> list[DataFrame]:
    """A long history, an archive that overlaps it, and a newer archive for the last days."""
    panel = events_panel(spark, sf)

    def since(day: str) -> Column:
        return F.col("d") >= F.lit(day).cast("date")

    history = panel.where(~since("2024-01-25")).withColumns({"source_rank": F.lit(0), "version": F.lit(0)})
    first = panel.where(since("2024-01-20")).withColumns({"n": F.col("n") + 1, "source_rank": F.lit(1), "version": F.lit(1)})
    second = panel.where(since("2024-01-27")).withColumns({"n": F.col("n") + 2, "source_rank": F.lit(1), "version": F.lit(2)})
    return [history, first, second]


def revision_order() -> list[Column]:
    return [F.col("source_rank").asc(), F.col("version").desc()]


@query("late_revision_merge", REVISION_SQL)
def late_revision_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merge_revisions(union_by_name(revision_files(spark, sf)), [E, "d"], revision_order())


@query("late_revision_merge_stream", REVISION_SQL)
def late_revision_merge_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "revisions")
    files = revision_files(spark, sf)
    for part in files:
        part.write.mode("append").parquet(f"{folder}/landing")
    source = landed(spark, f"{folder}/landing", files[0].schema, 1)
    return merge_stream(spark, source, files[0].schema, f"{folder}/published", f"{folder}/progress", "d", [E, "d"], revision_order())


# revisions and the windows over them -------------------------------------------------
MISSED = "n_name = 'NATION_3' AND d BETWEEN DATE '1997-05-01' AND DATE '1997-05-20'"
REVISED = "d BETWEEN DATE '1998-03-10' AND DATE '1998-03-12'"
FRESH = "d >= DATE '2001-01-01'"
REFRESH_BATCHES = [
    f"SELECT n_name, d, n, 0 AS version FROM panel WHERE NOT ({MISSED}) AND NOT ({FRESH})",
    f"SELECT n_name, d, n + 5 AS n, 2 AS version FROM panel WHERE {REVISED} UNION ALL SELECT n_name, d, n, 0 AS version FROM panel WHERE {MISSED}",
    f"SELECT n_name, d, n, 0 AS version FROM panel WHERE {FRESH} UNION ALL SELECT n_name, d, n + 9 AS n, 3 AS version FROM panel WHERE d = DATE '1998-03-11'"
    f" UNION ALL SELECT n_name, d, n + 1 AS n, 1 AS version FROM panel WHERE {REVISED}",
]
REFRESH_SQL = f"""
WITH panel AS ({NATIONS_SQL}), every AS ({' UNION ALL '.join(REFRESH_BATCHES)}),
     p AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY n_name, d ORDER BY version DESC) = 1),
     m AS (SELECT *, {ramp_sql('n', 'n_name')} AS a FROM p), k AS (SELECT n_name, max(n) AS peak FROM p GROUP BY n_name)
SELECT n_name, d, n, version, round(a, 6) AS n_7d_avg, n - {lag_sql('n', 1, 'n_name')} AS n_change,
       round({lag_sql('a', 7, 'n_name')}, 6) AS lstwk_n_7d_avg, round({change_sql('a', 'n_name')}, 6) AS n_incr_week, peak
FROM m JOIN k USING (n_name)"""


def refreshed_nations(spark: SparkSession, folder: str) -> RefreshedPanel:
    derived = {
        "n_7d_avg": Derived(lambda p: p.rolling_mean("n"), 6),
        "n_change": Derived(lambda p: p.delta("n"), 1),
        "lstwk_n_7d_avg": Derived(lambda p: p.lag("n_7d_avg", 7), 7, of=("n_7d_avg",)),
        "n_incr_week": Derived(lambda p: p.change("n_7d_avg"), 7, of=("n_7d_avg",)),
    }
    base = StructType.fromDDL("n_name string, d date, n bigint, version int")
    return RefreshedPanel(spark, folder, NATIONS, base, lambda: [F.col("version").desc()], derived, {"peak": ("max", lambda: F.col("n"))})


@query("revision_window_refresh", REFRESH_SQL)
def revision_window_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches: a history with a hole, revisions and the missed days, newer days and revisions of revisions."""
    panel = staged(nations_panel(spark, sf).select("n_name", "d", "n"), "nations")
    published = refreshed_nations(spark, work_folder(spark, "refresh"))
    for sql in REFRESH_BATCHES:
        published.apply(spark.sql(sql.replace("FROM panel", "FROM {panel}"), panel=panel))
    return rounded(published.read())


# quality of spans ------------------------------------------------------------------------
SPANS_SQL = """
SELECT CAST(f AS DATE) AS "first", CAST(f + to_days(CAST(n - 1 AS INTEGER)) AS DATE) AS "last" FROM (SELECT DATE '2024-01-01' + to_days(CAST(x AS INTEGER)) AS f FROM range(30) t(x)), (VALUES (1), (3), (10), (30)) l(n)"""


@query(
    "span_quality",
    f"""
SELECT "first", "last", count(*) AS n_rows, count(nullif(value, 1.63)) AS n_values, TRUE AS keys_within, TRUE AS median_within
FROM ({SPANS_SQL}) JOIN events ON CAST(ts AS DATE) BETWEEN "first" AND "last" GROUP BY 1, 2""",
)
def span_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of every span of 1, 3, 10 and 30 days from daily sketches, and whether they are within their error of the exact ones.

    The events arrive in two parts, of which the second replaces some days of the first.
    """
    events = load(spark, sf, "events").select(F.to_date("ts").alias("d"), "user_id", F.nullif(F.col("value"), F.lit(1.63)).alias("value"))
    quality = DailyQuality(spark, work_folder(spark, "quality"), "d", "user_id", "value")
    early = F.col("d") < F.lit("2024-01-20").cast("date")
    quality.publish(events.where(early).withColumn("value", F.when(F.dayofmonth("d") != 15, F.col("value"))))
    quality.publish(events.where(~early | (F.dayofmonth("d") == 15)))
    starts = spark.range(30).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("first"))
    spans = starts.withColumn("n", F.explode(F.array(*map(F.lit, (1, 3, 10, 30))))).select("first", F.date_add("first", F.col("n") - 1).alias("last"))
    found = staged(quality.spans(spans), "spans")
    days = found.select("first", "last", "q50", F.explode(F.sequence("first", "last")).alias("d"))
    exact = days.join(events, "d").groupBy("first", "last").agg(
        F.count_distinct("user_id").alias("users"), F.avg((F.col("value") < F.col("q50")).cast("int")).alias("below"), F.avg((F.col("value") <= F.col("q50")).cast("int")).alias("upto")
    )
    both = lookup(found, exact, ["first", "last"], unique=True)
    keys_within = F.abs(F.col("n_keys") - F.col("users")) <= DISTINCT_ERROR * F.col("users") + 1
    median_within = (F.col("below") <= 0.5 + RANK_ERROR) & (F.col("upto") >= 0.5 - RANK_ERROR)
    return both.select("first", "last", "n_rows", "n_values", keys_within.alias("keys_within"), median_within.alias("median_within"))
