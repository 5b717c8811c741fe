"""Aggregate, reshape and report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import margin_bucket, two_way_label
from ..functions.missing import add_all, ratio, sum_or_zero
from ..functions.names import drop_ending, starting
from ..operators.dedupe import union_by_name
from ..operators.filters import latest_of
from ..operators.quality import freshness, frequency, key_uniqueness
from ..operators.reshape import lengthen, widen
from .book import query, rounded
from .tables import EVENTS_SQL, events_panel, load

TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "group_sums",
    """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
       coalesce(count(nullif(l_linenumber, 7)), 0) AS n_lines, CAST(coalesce(sum(nullif(l_linenumber, 1)), 0) AS BIGINT) AS sum_line,
       CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'X' THEN l_linenumber END), 0) AS BIGINT) AS sum_none,
       max(CAST(l_shipdate AS DATE)) AS last_date
FROM lineitem GROUP BY 1, 2""",
)
def group_sums(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem").withColumn("line", F.nullif("l_linenumber", F.lit(1)))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        sum_or_zero(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("sum_qty"),
        F.count(F.nullif("l_linenumber", F.lit(7))).alias("n_lines"),
        sum_or_zero("line").alias("sum_line"),
        sum_or_zero(F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "X"), F.col("l_linenumber"))).alias("sum_none"),
        F.max(F.to_date("l_shipdate")).alias("last_date"),
    )


@query("global_asof", "SELECT event_id, CAST(ts AS DATE) AS d, (SELECT max(CAST(ts AS DATE)) FROM events) AS as_of FROM events")
def global_asof(spark: SparkSession, sf: str) -> DataFrame:
    days = load(spark, sf, "events").select("event_id", F.to_date("ts").alias("d"))
    return days.withColumn("as_of", latest_of(days, "d"))


def _wide_sql(measure: str, label: str) -> str:
    return ", ".join(f"max(CASE WHEN event_type = '{t}' THEN {measure} END) AS {label.format(t)}" for t in TYPES)


@query("pivot_one_measure", f"SELECT d, {_wide_sql('n', '{}')} FROM ({EVENTS_SQL}) GROUP BY 1")
def pivot_one_measure(spark: SparkSession, sf: str) -> DataFrame:
    return widen(events_panel(spark, sf), ["d"], "event_type", ["n"], TYPES)


@query(
    "pivot_two_measures",
    f"""
WITH w AS (SELECT d, {_wide_sql('n', 'n_{}')}, {_wide_sql('v', 'v_{}')} FROM ({EVENTS_SQL}) GROUP BY 1)
SELECT *, n_click + n_error + n_purchase + n_view AS n_four FROM w""",
)
def pivot_two_measures(spark: SparkSession, sf: str) -> DataFrame:
    wide = widen(events_panel(spark, sf), ["d"], "event_type", ["n", "v"], TYPES)
    return wide.withColumn("n_four", add_all("n_click", "n_error", "n_purchase", "n_view"))


@query(
    "unpivot_by_prefix",
    f"""
WITH w AS (SELECT d, {_wide_sql('n', 'n_{}')} FROM ({EVENTS_SQL}) GROUP BY 1)
SELECT d, name, value FROM w UNPIVOT INCLUDE NULLS (value FOR name IN (n_click, n_error, n_purchase, n_view))""",
)
def unpivot_by_prefix(spark: SparkSession, sf: str) -> DataFrame:
    wide = drop_ending(widen(events_panel(spark, sf), ["d"], "event_type", ["n", "v"], TYPES), "signup")
    return lengthen(wide, ["d"], starting(wide, "n_"))


@query(
    "two_party_share",
    """
WITH w AS (SELECT o_custkey,
       CAST(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN floor(o_totalprice) END) AS BIGINT) AS dem,
       CAST(sum(CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN floor(o_totalprice) END) AS BIGINT) AS gop
     FROM orders GROUP BY 1),
     s AS (SELECT *, dem + gop AS total, dem / nullif(dem + gop, 0) AS share FROM w)
SELECT o_custkey, dem, gop, total, round(share, 6) AS share, CASE WHEN dem > gop THEN 'Blue' WHEN NOT dem > gop THEN 'Red' END AS winner,
       CASE WHEN share <= 0.45 THEN 'gop' WHEN share < 0.55 THEN 'close' WHEN share >= 0.55 THEN 'dem' END AS bucket FROM s""",
)
def two_party_share(spark: SparkSession, sf: str) -> DataFrame:
    party = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("dem")).when(
        F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"), F.lit("gop")
    )
    votes = load(spark, sf, "orders").select("o_custkey", party.alias("party"), F.floor("o_totalprice").alias("votes"))
    wide = widen(votes, ["o_custkey"], "party", ["votes"], ["dem", "gop"], agg=F.sum)
    shares = wide.withColumn("total", add_all("dem", "gop")).withColumn("share", ratio("dem", "total"))
    return rounded(
        shares.withColumns(
            {"winner": two_way_label("dem", "gop", "Blue", "Red"), "bucket": margin_bucket("share", 0.45, 0.55, ("gop", "close", "dem"))}
        )
    )


@query("key_frequency", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def key_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return frequency(load(spark, sf, "customer"), "c_nationkey")


@query(
    "row_quality_report",
    """
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
     twice AS (SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'),
     r AS (SELECT 'customer_day' AS "check", (SELECT count(*) FROM o) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM o)) AS n_distinct
     UNION ALL SELECT 'whole_row', (SELECT count(*) FROM twice), (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)))
SELECT *, round(n_distinct / n_rows, 6) AS uniqueness FROM r""",
)
def row_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    days = orders.select("o_custkey", F.to_date("o_orderdate").alias("d"))
    pair = orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    twice = union_by_name([pair, pair.where(F.col("o_orderpriority") == "1-URGENT")]).drop("o_orderpriority")
    return rounded(union_by_name([key_uniqueness(days, ["o_custkey", "d"], "customer_day"), key_uniqueness(twice, None, "whole_row")]))


@query(
    "feed_freshness",
    """
SELECT 'events' AS feed, max(CASE WHEN event_type <> 'view' THEN CAST(ts AS DATE) END) AS last_date, count(nullif(event_type, 'view')) AS n_values FROM events
UNION ALL SELECT 'orders', max(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END), count(nullif(o_orderstatus, 'P')) FROM orders
UNION ALL SELECT 'shipments', max(CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END), count(nullif(l_returnflag, 'N')) FROM lineitem""",
)
def feed_freshness(spark: SparkSession, sf: str) -> DataFrame:
    def feed(table: str, ts: str, c: str, hole: str) -> tuple[DataFrame, str, str]:
        return load(spark, sf, table).select(F.to_date(ts).alias("d"), F.nullif(F.col(c), F.lit(hole)).alias("m")), "d", "m"

    return freshness(
        {
            "events": feed("events", "ts", "event_type", "view"),
            "orders": feed("orders", "o_orderdate", "o_orderstatus", "P"),
            "shipments": feed("lineitem", "l_shipdate", "l_returnflag", "N"),
        }
    )
