"""Join, dedupe and union queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import is_in, split_by_share
from ..operators.dedupe import first_per_key, merge_by_priority, union_by_name
from ..operators.enrich import between_days, full_join_feeds, left_join_feeds, lookup, overridden, repaired, step_value
from ..operators.panel import build_panel, carry_previous
from ..sources.manifest import newest
from ..operators.spelling import repair_names
from .book import query, rounded
from .tables import (
    EVENTS, EVENTS_SQL, NATIONS_SQL, SHIPMENTS_SQL, events_panel, lag_sql, load, money, nations, nations_panel, rows, shipments_panel,
)

N = "n_name"
E = "event_type"


def creditors(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Customers without debt: orders of the others find no dimension row."""
    return load(spark, sf, "customer").where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("o_custkey"), *columns)


@query(
    "right_join_enrich",
    """
SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment, c_nationkey, n_name
FROM customer RIGHT JOIN orders ON c_custkey = o_custkey AND c_acctbal >= 0 LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def right_join_enrich(spark: SparkSession, sf: str) -> DataFrame:
    fact = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    wide = lookup(fact, creditors(spark, sf, "c_mktsegment", "c_nationkey"), "o_custkey")
    return lookup(wide, nations(spark, sf, "c_nationkey"), "c_nationkey")


@query(
    "left_join_enrich_multi",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand AS part_brand, p_type AS part_type, s_name AS supplier_name,
       s_nationkey AS supplier_nationkey, n_name AS supplier_nation
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
     LEFT JOIN nation ON n_nationkey = s_nationkey""",
)
def left_join_enrich_multi(spark: SparkSession, sf: str) -> DataFrame:
    fact = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("part_brand"), F.col("p_type").alias("part_type"))
    supplier = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("supplier_name"), F.col("s_nationkey").alias("supplier_nationkey")
    )
    wide = lookup(lookup(fact, part, "l_partkey"), supplier, "l_suppkey")
    return lookup(wide, nations(spark, sf, "supplier_nationkey", "supplier_nation"), "supplier_nationkey")


@query(
    "left_join_two_facts",
    f"""
SELECT a.n_name, a.d, a.n, a.amt, b.shipped, b.qty FROM ({NATIONS_SQL}) a LEFT JOIN ({SHIPMENTS_SQL}) b ON a.n_name = b.n_name AND a.d = b.d""",
)
def left_join_two_facts(spark: SparkSession, sf: str) -> DataFrame:
    return left_join_feeds(nations_panel(spark, sf).select(N, "d", "n", "amt"), shipments_panel(spark, sf).drop("returned"), [N, "d"])


@query(
    "full_join_three_feeds",
    f"""
WITH a AS (SELECT n_name, d, n FROM ({NATIONS_SQL})), b AS (SELECT n_name, d, shipped FROM ({SHIPMENTS_SQL})),
     c AS (SELECT n_name, d, returned FROM ({SHIPMENTS_SQL}) WHERE returned > 0)
SELECT n_name, d, n, shipped, returned FROM a FULL JOIN b USING (n_name, d) FULL JOIN c USING (n_name, d)""",
)
def full_join_three_feeds(spark: SparkSession, sf: str) -> DataFrame:
    ships = shipments_panel(spark, sf)
    returns = ships.where(F.col("returned") > 0).select(N, "d", "returned")
    return full_join_feeds([nations_panel(spark, sf).select(N, "d", "n"), ships.select(N, "d", "shipped"), returns], [N, "d"])


# Fixed values of the test: named exceptions on top of the joined segment
SEGMENT_OF = {"Customer#000000007": "MACHINERY", "Customer#000000011": "BUILDING"}


@query(
    "unmatched_repair",
    f"""
WITH f AS (SELECT o_orderkey, o_custkey, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS own_name FROM orders),
     j AS (SELECT o_orderkey, o_custkey, coalesce(c_name, own_name) AS name, c_mktsegment FROM f
           LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0)
SELECT o_orderkey, o_custkey, name, coalesce(CASE {' '.join(f"WHEN name = '{k}' THEN '{v}'" for k, v in SEGMENT_OF.items())} END,
       c_mktsegment) AS segment FROM j""",
)
def unmatched_repair(spark: SparkSession, sf: str) -> DataFrame:
    fact = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    wide = lookup(fact, creditors(spark, sf, "c_name", "c_mktsegment"), "o_custkey")
    own = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    wide = wide.withColumn("name", repaired("c_name", own))
    return wide.select("o_orderkey", "o_custkey", "name", overridden("c_mktsegment", "name", SEGMENT_OF).alias("segment"))


# Fixed values of the test: share in force over January 2024
STEPS = [("2024-01-03", 0.0), ("2024-01-06", 0.006), ("2024-01-10", 0.08), ("2024-01-15", 0.379), ("2024-01-19", 0.77), ("2024-01-24", 0.889)]


@query(
    "step_lookup",
    f"""
WITH s(lo, pct) AS (VALUES {', '.join(f"(DATE '{d}', {p}::DOUBLE)" for d, p in STEPS)}),
     r AS (SELECT lo, coalesce(lead(lo) OVER (ORDER BY lo), DATE '9999-01-01') AS hi, pct FROM s)
SELECT event_type, d, n, pct, round(n * pct, 6) AS n_new, round(n * (1 - pct), 6) AS n_old
FROM ({EVENTS_SQL}) p LEFT JOIN r ON p.d >= r.lo AND p.d < r.hi""",
)
def step_lookup(spark: SparkSession, sf: str) -> DataFrame:
    panel = events_panel(spark, sf).drop("v").withColumn("pct", step_value("d", STEPS))
    new, old = split_by_share("n", "pct")
    return rounded(panel.withColumns({"n_new": new, "n_old": old}))


@query(
    "point_corrections",
    f"""
SELECT event_type, d, v, CASE WHEN (event_type = 'click' AND d = DATE '2024-01-05') OR (event_type = 'view' AND d = DATE '2024-01-12')
       OR (event_type = 'error' AND d = DATE '2024-01-01') THEN {lag_sql('v', 1, E)} ELSE v END AS v_fixed FROM ({EVENTS_SQL})""",
)
def point_corrections(spark: SparkSession, sf: str) -> DataFrame:
    listed = spark.createDataFrame(
        [("click", "2024-01-05", True), ("view", "2024-01-12", True), ("error", "2024-01-01", True)], "event_type string, d string, listed boolean"
    ).withColumn("d", F.to_date("d"))
    panel = lookup(events_panel(spark, sf).drop("n"), listed, [E, "d"])
    return panel.withColumn("v_fixed", carry_previous(EVENTS, "v", F.col("listed"))).drop("listed")


@query(
    "range_corrections",
    f"""
SELECT event_type, d, n, CASE WHEN event_type = 'signup' AND d > DATE '2024-01-08' AND d < DATE '2024-01-17' THEN 386 ELSE n END AS n_fixed
FROM ({EVENTS_SQL})""",
)
def range_corrections(spark: SparkSession, sf: str) -> DataFrame:
    hit = (F.col(E) == "signup") & between_days("d", "2024-01-08", "2024-01-17")
    return events_panel(spark, sf).select(E, "d", "n", F.when(hit, F.lit(386)).otherwise(F.col("n")).alias("n_fixed"))


LISTED = ["NATION_1", "NATION_4", "NATION_9", "NATION_12", "NATION_20"]


@query(
    "membership_flag",
    f"""
SELECT n_name, d, n, CASE WHEN n_name = 'NATION_4' THEN 'NA' WHEN n_name IN ({', '.join(f"'{x}'" for x in LISTED)}) THEN 'A' ELSE 'B' END AS party
FROM ({NATIONS_SQL})""",
)
def membership_flag(spark: SparkSession, sf: str) -> DataFrame:
    party = F.when(is_in(N, ["NATION_4"]), F.lit("NA")).when(is_in(N, LISTED), F.lit("A")).otherwise(F.lit("B"))
    return nations_panel(spark, sf).select(N, "d", "n", party.alias("party"))


# dedupe and unions ------------------------------------------------------------------
@query(
    "distinct_rows",
    """
SELECT DISTINCT * FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE), o_orderpriority FROM orders
WHERE o_orderpriority = '1-URGENT')""",
)
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return union_by_name([orders, orders.where(F.col("o_orderpriority") == "1-URGENT")]).distinct()


@query(
    "first_per_key",
    """
SELECT user_id, event_type, event_id, CAST(ts AS DATE) AS d, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def first_event(spark: SparkSession, sf: str) -> DataFrame:
    one = first_per_key(load(spark, sf, "events"), ["user_id", E], [F.col("ts").asc(), F.col("event_id").asc()])
    return one.select("user_id", E, "event_id", F.to_date("ts").alias("d"), "value")


def _user_days(spark: SparkSession, sf: str, condition) -> DataFrame:
    """One source of revisions: days of the users whose events are all in it."""
    return build_panel(load(spark, sf, "events").where(condition), ["user_id"], F.col("ts"), "d", n=rows(), v=money("value"))


USER_DAYS = "SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v FROM events"


@query(
    "source_priority_merge",
    f"""
WITH s AS (SELECT 0 AS source_rank, * FROM ({USER_DAYS} WHERE ts < DATE '2024-01-20' AND event_type <> 'view' GROUP BY 2, 1)
     UNION ALL SELECT 1, * FROM ({USER_DAYS} WHERE ts >= DATE '2024-01-10' AND event_type <> 'error' GROUP BY 2, 1)
     UNION ALL SELECT 2, * FROM ({USER_DAYS} GROUP BY 2, 1))
SELECT user_id, d, n, v, source_rank FROM s QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY source_rank) = 1""",
)
def source_priority_merge(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("ts").cast("date")
    history = _user_days(spark, sf, (day < F.lit("2024-01-20").cast("date")) & (F.col(E) != "view"))
    archive = _user_days(spark, sf, (day >= F.lit("2024-01-10").cast("date")) & (F.col(E) != "error"))
    current = _user_days(spark, sf, F.lit(True))
    return merge_by_priority([history, archive, current], ["user_id", "d"])


@query(
    "union_by_name",
    f"""
SELECT n_name, d, n, amt, NULL::BIGINT AS shipped, NULL::DOUBLE AS qty, 'Yes' AS provisional FROM ({NATIONS_SQL})
UNION ALL SELECT n_name, d, NULL, NULL, shipped, qty, 'Yes' FROM ({SHIPMENTS_SQL})""",
)
def union_of_feeds(spark: SparkSession, sf: str) -> DataFrame:
    orders = nations_panel(spark, sf).select(N, "d", "n", "amt")
    return union_by_name([orders, shipments_panel(spark, sf).drop("returned")]).withColumn("provisional", F.lit("Yes"))


@query(
    "newest_n",
    """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders ORDER BY orders.o_orderdate DESC, o_orderkey DESC LIMIT 14""",
)
def newest_n(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")
    return newest(orders, 14, F.col("o_orderdate").desc(), F.col("o_orderkey").desc())


WRITTEN_SQL = """
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN substr(p_name, 1, 3) || substr(p_name, 5) WHEN 1 THEN p_name || 's' WHEN 2 THEN upper(p_name)
  WHEN 3 THEN 'x' || substr(p_name, 2, 4) || 'yz' || substr(p_name, 6) WHEN 4 THEN substr(p_name, 2) || '!' ELSE p_name END AS written FROM part"""


@query(
    "fuzzy_repair",
    f"""
WITH w AS ({WRITTEN_SQL}), k AS (SELECT DISTINCT p_name AS repaired FROM part),
     pair AS (SELECT n.written, repaired, levenshtein(lower(n.written), repaired) AS distance FROM (SELECT DISTINCT written FROM w) n, k),
     near AS (SELECT * FROM pair WHERE distance <= 2 QUALIFY rank() OVER (PARTITION BY written ORDER BY distance) = 1),
     one AS (SELECT written, any_value(repaired) AS repaired, CAST(any_value(distance) AS INTEGER) AS distance FROM near GROUP BY written HAVING count(*) = 1)
SELECT p_partkey, w.written, repaired, distance FROM w LEFT JOIN one USING (written)""",
)
def fuzzy_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Part names written with edits, brought back to the known ones where one is closest."""
    parts = load(spark, sf, "part").select("p_partkey", "p_name")
    name, kind = F.col("p_name"), F.col("p_partkey") % 6
    written = (
        F.when(kind == 0, F.concat(F.substring(name, 1, 3), F.substring(name, 5, 100)))
        .when(kind == 1, F.concat(name, F.lit("s")))
        .when(kind == 2, F.upper(name))
        .when(kind == 3, F.concat(F.lit("x"), F.substring(name, 2, 4), F.lit("yz"), F.substring(name, 6, 100)))
        .when(kind == 4, F.concat(F.substring(name, 2, 100), F.lit("!")))
        .otherwise(name)
    )
    return repair_names(parts.select("p_partkey", written.alias("written")), "written", parts.select("p_name").distinct(), "p_name")
