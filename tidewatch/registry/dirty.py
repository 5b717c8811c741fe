"""Queries over input as feeds deliver it: mixed headers, odd dates and numbers, JSON, lost progress, open steps.

Whole tables are written in the dirty form and read back, so the SQL is over the tables themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ANY_FORMATS, parse_date
from ..functions.missing import number
from ..operators.enrich import left_join_feeds, lookup, step_join
from ..operators.dedupe import first_per_key
from ..operators.panel import densify
from ..operators.quality import unparsed
from ..operators.reshape import widen
from ..plans import run, testing, trend
from ..sources.delimited import read_mixed
from ..sources.documents import read_nested_records, read_records
from ..sources.landing import Landing
from ..streaming.log import BatchLog, landed
from ..streaming.snapshots import accumulate_stream, snapshot_changes
from .book import BOOK, query, rounded
from .files import fresh
from .incremental import SNAPSHOT_SQL, TOTALS, repeated, snapshots, work_folder
from .tables import EVENTS_SQL, events_panel, lag_sql, load, nations_panel

E = "event_type"
ROWS_PER_FILE = 5_000


# files --------------------------------------------------------------------------------
@query(
    "csv_mixed_headers",
    """
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS o_orderstatus FROM orders""",
)
def csv_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one feed whose columns come in another order, and with one more column in a part of them."""
    path = fresh(spark, "mixed")
    orders = load(spark, sf, "orders")
    more = F.col("o_orderkey") % 3 == 0
    orders.where(more).select("o_totalprice", "o_orderstatus", "o_orderkey", "o_custkey").write.options(header=True).csv(f"{path}/a")
    orders.where(~more).select("o_orderkey", "o_custkey", "o_totalprice").write.options(header=True).csv(f"{path}/b")
    types = {"o_orderkey": "long", "o_custkey": "long", "o_totalprice": "double", "o_orderstatus": "string"}
    return read_mixed(spark, [f"{path}/a", f"{path}/b"], types)


def in_documents(df: DataFrame) -> DataFrame:
    """(records): arrays of about ROWS_PER_FILE rows, dealt by a hash of the row."""
    files = df.agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).alias("n")).select(F.greatest("n", F.lit(1))).scalar()
    dealt = df.withColumn("file", F.pmod(F.xxhash64(*df.columns), files))
    return dealt.groupBy("file").agg(F.collect_list(F.struct(*df.columns)).alias("records"))


CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer"
CUSTOMER = {"c_custkey": "long", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double"}


@query("json_nested_records", CUSTOMER_SQL)
def json_nested_records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold their records in one field, a document per file."""
    path = fresh(spark, "nested")
    documents = in_documents(load(spark, sf, "customer").select(*CUSTOMER)).select(F.col("file").alias("runid"), "records")
    documents.write.option("maxRecordsPerFile", 1).json(path)
    return read_nested_records(spark, path, "records", CUSTOMER)


@query("json_flat_records", CUSTOMER_SQL)
def json_flat_records(spark: SparkSession, sf: str) -> DataFrame:
    """Files that are one array of records."""
    path = fresh(spark, "flat")
    in_documents(load(spark, sf, "customer").select(*CUSTOMER)).select(F.to_json("records").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return read_records(spark, path, CUSTOMER)


@query("landing_flow", BOOK["flow_trend_and_peak"].sql)
def landing_flow(spark: SparkSession, sf: str) -> DataFrame:
    """A flow from a landing folder: its feed is a JSON file set there and is found by name."""
    folder = fresh(spark, "landing")
    panel = nations_panel(spark, sf).select(
        F.date_format("d", "yyyyMMdd").cast("long").alias("date"),
        F.col("n_name").alias("state"),
        F.col("n_f").cast("double").alias("positiveIncrease"),
        F.col("n").cast("double").alias("totalTestResultsIncrease"),
        F.col("n_urgent").cast("double").alias("deathIncrease"),
        F.col("n_o").cast("double").alias("hospitalizedCurrently"),
    )
    in_documents(panel).select(F.to_json("records").alias("value")).write.option("maxRecordsPerFile", 1).text(f"{folder}/state_tracking.json")
    feeds = Landing(spark, folder).load("state_tracking")
    made = trend.state_trend(feeds["state_tracking"])
    counted = ("positiveIncrease", "totalTestResultsIncrease", "deathIncrease", "hospitalizedCurrently", "totaltests_7d", "totalpos_7d", "lstwk_hosp", "change_hosp")
    declared = BOOK["flow_trend_and_peak"].run(spark, sf).columns
    made = made.withColumns({c: F.col(c).cast("long") for c in counted})
    return rounded(made.select(*declared))


@query(
    "history_import",
    f"""
WITH p AS (SELECT event_type AS state, d AS date, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY d) AS DOUBLE) AS total_tests,
      CAST(n AS DOUBLE) AS total_pos_tests FROM ({EVENTS_SQL}))
SELECT *, total_tests - {lag_sql('total_tests', 1, 'state', 'date')} AS new_reported_tests,
  total_pos_tests - {lag_sql('total_pos_tests', 1, 'state', 'date')} AS new_reported_pos_tests FROM p""",
)
def history_import(spark: SparkSession, sf: str) -> DataFrame:
    """A history kept as text by an earlier system, taken in once and stored; a later run finds it there."""
    folder = fresh(spark, "history")
    kept = snapshots(spark, sf).join(events_panel(spark, sf).select(E, "d", "n"), [E, "d"])
    text = kept.select(F.col(E).alias("State"), F.col("total").cast("string").alias("Total Tests"), F.concat("n", F.lit(".0")).alias("Total Pos Tests"), F.concat("d", F.lit("T00:00:00Z")).alias("Date"))
    text.write.options(header=True).csv(f"{folder}/test_history.csv")
    run.keep_snapshots(run.imported_history(Landing(spark, folder)["test_history"]), f"{folder}/snapshots")
    return testing.history_changes(testing.accumulate(run.stored_snapshots(spark, f"{folder}/snapshots"), run.stored_snapshots(spark, f"{folder}/snapshots")))


# values --------------------------------------------------------------------------------
@query("dates_with_time", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders")
def dates_with_time(spark: SparkSession, sf: str) -> DataFrame:
    """Every form a date comes in, with and without a time after it."""
    d = F.col("o_orderdate")
    forms = [
        F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.date_format(d, "MM/dd/yyyy hh:mm:ss a"), F.date_format(d, "yyyy/MM/dd HH:mm:ss'+00'"),
        F.date_format(d, "yyyyMMdd"), F.date_format(d, "d-MMM-yyyy"), F.concat(F.lit(" "), F.date_format(d, "yyyy-MM-dd HH:mm"), F.lit(" ")),
    ]
    form: Column = forms[0]
    for k, f in enumerate(forms):
        form = F.when(F.col("o_orderkey") % len(forms) == k, f).otherwise(form)
    return load(spark, sf, "orders").select("o_orderkey", parse_date(form, ANY_FORMATS).alias("d"))


@query(
    "whole_numbers_with_point",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN o_custkey END AS cust FROM orders",
)
def whole_numbers_with_point(spark: SparkSession, sf: str) -> DataFrame:
    """Codes written as 1001, 1001.0 and 1001.000, and numbers that are no codes."""
    text, kind = F.col("o_custkey").cast("string"), F.col("o_orderkey") % 4
    written = F.when(kind == 0, text).when(kind == 1, F.concat(text, F.lit(".0"))).when(kind == 2, F.concat(text, F.lit(".000"))).otherwise(F.concat(text, F.lit(".25")))
    return load(spark, sf, "orders").select("o_orderkey", number(written, "long").alias("cust"))


@query(
    "unparsed_values",
    """
SELECT 'code' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE o_orderstatus <> 'P') AS n_text,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS n_unparsed FROM orders
UNION ALL SELECT 'day', count(*), count(*), count(*) FILTER (WHERE o_orderpriority = '5-LOW') FROM orders""",
)
def unparsed_values(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that are no number or no date are counted, so that a feed in a new form does not vanish in silence."""
    status, low = F.col("o_orderstatus"), F.col("o_orderpriority") == "5-LOW"
    raw = load(spark, sf, "orders").select(
        F.when(status == "O", F.concat(F.lit("no. "), "o_custkey")).when(status == "P", F.lit(" ")).otherwise(F.col("o_custkey").cast("string")).alias("code"),
        F.when(low, F.date_format("o_orderdate", "EEEE")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("day"),
    )
    return unparsed(raw, {"code": number("code", "long"), "day": parse_date("day", ANY_FORMATS)})


@query(
    "pivot_all_names",
    """
SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN n END) AS f, sum(CASE WHEN o_orderstatus = 'O' THEN n END) AS o,
  sum(CASE WHEN o_orderstatus = 'P' THEN n END) AS p
FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def pivot_all_names(spark: SparkSession, sf: str) -> DataFrame:
    """Every name that occurs becomes a column; none is declared."""
    counts = load(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return widen(counts, ["o_custkey"], "o_orderstatus", ["n"])


# joins ---------------------------------------------------------------------------------
@query(
    "step_table_join",
    f"""
WITH s AS (SELECT DISTINCT CAST(ts AS DATE) AS lo FROM events),
 steps AS (SELECT lo, lead(lo, 3) OVER (ORDER BY lo) AS hi, CAST(day(lo) AS INTEGER) AS rank FROM s QUALIFY row_number() OVER (ORDER BY lo) % 3 = 1)
SELECT event_type, d, n, rank FROM ({EVENTS_SQL}) LEFT JOIN steps ON d >= lo AND (d < hi OR hi IS NULL)""",
)
def step_table_join(spark: SparkSession, sf: str) -> DataFrame:
    """Steps of three days of data, the last one open: a table made from the events themselves."""
    panel = events_panel(spark, sf)
    days = panel.agg(F.array_sort(F.collect_set("d")).alias("days"))  # the calendar days of the data
    place = days.select(F.posexplode("days").alias("k", "lo"), "days").where(F.col("k") % 3 == 0)
    steps = place.select("lo", F.get("days", F.col("k") + 3).alias("hi"), F.dayofmonth("lo").alias("rank"))
    return step_join(panel.select(E, "d", "n"), "d", steps)


@query(
    "null_safe_lookup",
    """
WITH d AS (SELECT CASE WHEN n_regionkey > 0 THEN n_regionkey END AS region, min(n_name) AS first_nation FROM nation GROUP BY 1),
 f AS (SELECT n_nationkey, n_name, CASE WHEN n_regionkey > 0 THEN n_regionkey END AS region FROM nation)
SELECT n_nationkey, n_name, f.region, first_nation FROM f LEFT JOIN d ON f.region IS NOT DISTINCT FROM d.region""",
)
def null_safe_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A missing key that finds the dimension row without a key."""
    region = F.when(F.col("n_regionkey") > 0, F.col("n_regionkey")).alias("region")
    nation = load(spark, sf, "nation")
    first = nation.groupBy(region).agg(F.min("n_name").alias("first_nation"))
    return lookup(nation.select("n_nationkey", "n_name", region), first, "region", null_safe=True)


@query(
    "repeated_feed_rows",
    f"""
WITH p AS (SELECT event_type, d, n, v FROM ({EVENTS_SQL})),
 twice AS (SELECT event_type, d, v AS share FROM p UNION ALL SELECT event_type, d, v - 1 FROM p)
SELECT event_type, d, n, max(share) AS share FROM p JOIN twice USING (event_type, d) GROUP BY ALL""",
)
def repeated_feed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that repeats its (entity, day) is reduced by a stated order before it is joined: the panel keeps its rows."""
    panel = events_panel(spark, sf)
    feed = panel.select(E, "d", F.col("v").alias("share"))
    twice = feed.unionByName(feed.withColumn("share", F.col("share") - 1))
    return left_join_feeds(panel.select(E, "d", "n"), first_per_key(twice, [E, "d"], [F.col("share").desc_nulls_last()]), [E, "d"])


@query(
    "densify_days",
    """
WITH c AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1, 2),
 e AS (SELECT o_custkey, min(d) AS a, max(d) AS b FROM c GROUP BY 1),
 g AS (SELECT o_custkey, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM e)
SELECT o_custkey, d, coalesce(n, 0) AS n FROM g LEFT JOIN c USING (o_custkey, d)""",
)
def densify_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every calendar day between a customer's first order and last; days without orders count 0."""
    counts = load(spark, sf, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return densify(counts, ["o_custkey"], "d", n=0)


# streams -------------------------------------------------------------------------------
@query("snapshot_lost_progress", SNAPSHOT_SQL)
def snapshot_lost_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the runs are taken in, then the progress is lost and the other half lands: the history has both."""
    folder = work_folder(spark, "lost")
    runs = snapshots(spark, sf)
    late = F.col("d") >= F.lit("2024-01-15").cast("date")
    log = BatchLog(spark, f"{folder}/log", runs.schema, day="d")
    runs.where(~late).write.parquet(f"{folder}/landing1")
    accumulate_stream(landed(spark, f"{folder}/landing1", runs.schema), log, f"{folder}/progress1")
    runs.where(late).write.parquet(f"{folder}/landing2")
    repeated(runs).write.mode("append").parquet(f"{folder}/landing2")
    history = accumulate_stream(landed(spark, f"{folder}/landing2", runs.schema), log, f"{folder}/progress2")
    return snapshot_changes(history, (E,), "d", TOTALS)
