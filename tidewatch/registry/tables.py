"""Panels and feeds made from the test tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import rename
from ..operators.enrich import lookup
from ..operators.panel import Panel, build_panel

EVENTS = Panel(("event_type",), "d")
NATIONS = Panel(("n_name",), "d")


# Declared, so that no job runs to find them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def money(c: str) -> Column:
    """Sum of amounts in cents-exact decimals: the order of rows cannot change it."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def rows(condition: Column | None = None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count(F.when(condition, 1))


# events by type and day ---------------------------------------------------------
def events_panel(spark: SparkSession, sf: str) -> DataFrame:
    return build_panel(load(spark, sf, "events"), ["event_type"], F.col("ts"), "d", n=rows(), v=money("value"))


EVENTS_SQL = """
SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v
FROM events GROUP BY 1, 2"""


# orders by nation of the customer and day ---------------------------------------
def orders_of_nations(spark: SparkSession, sf: str) -> DataFrame:
    customers = rename(load(spark, sf, "customer").select("c_custkey", "c_nationkey"), {"o_custkey": "c_custkey"})
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return lookup(orders, customers, "o_custkey")


def nations(spark: SparkSession, sf: str, key: str, name: str = "n_name") -> DataFrame:
    return load(spark, sf, "nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))


def nations_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Aggregated by nation number first; the 25 names are added to the small result."""
    panel = build_panel(
        orders_of_nations(spark, sf),
        ["c_nationkey"],
        F.col("o_orderdate"),
        "d",
        n=rows(),
        amt=money("o_totalprice"),
        n_f=rows(F.col("o_orderstatus") == "F"),
        n_o=rows(F.col("o_orderstatus") == "O"),
        n_urgent=rows(F.col("o_orderpriority") == "1-URGENT"),
    )
    return lookup(panel, nations(spark, sf, "c_nationkey"), "c_nationkey").drop("c_nationkey")


NATIONS_SQL = """
SELECT n_name, CAST(o_orderdate AS DATE) AS d, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amt,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o,
       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
GROUP BY 1, 2"""


# line items by nation of the supplier and ship day --------------------------------
def shipments(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    suppliers = rename(load(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), {"l_suppkey": "s_suppkey"})
    lines = load(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", *more)
    return lookup(lines, suppliers, "l_suppkey")


def shipments_panel(spark: SparkSession, sf: str) -> DataFrame:
    panel = build_panel(
        shipments(spark, sf, "l_quantity", "l_returnflag"),
        ["s_nationkey"],
        F.col("l_shipdate"),
        "d",
        shipped=rows(),
        qty=money("l_quantity"),
        returned=rows(F.col("l_returnflag") == "R"),
    )
    return lookup(panel, nations(spark, sf, "s_nationkey"), "s_nationkey").drop("s_nationkey")


SHIPMENTS_SQL = """
SELECT n_name, CAST(l_shipdate AS DATE) AS d, count(*) AS shipped,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
       count(*) FILTER (WHERE l_returnflag = 'R') AS returned
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
GROUP BY 1, 2"""


def running(panel: Panel, c: str) -> Column:
    """Counter: everything so far."""
    return F.sum(c).over(panel.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def nations_counter(spark: SparkSession, sf: str) -> DataFrame:
    return nations_panel(spark, sf).select("n_name", "d", running(NATIONS, "n").alias("cum"))


COUNTER_SQL = f"""
SELECT n_name, d, CAST(sum(n) OVER (PARTITION BY n_name ORDER BY d) AS BIGINT) AS cum FROM ({NATIONS_SQL})"""


# SQL spelled once ------------------------------------------------------------------
def over(keys: str, day: str = "d", frame: int | None = None) -> str:
    rows_ = f" ROWS BETWEEN {frame - 1} PRECEDING AND CURRENT ROW" if frame else ""
    return f"OVER (PARTITION BY {keys} ORDER BY {day}{rows_})"


def ramp_sql(c: str, keys: str, day: str = "d") -> str:
    w = over(keys, day, 7)
    return f"CASE WHEN count({c}) {w} = count(*) {w} THEN avg({c}) {w} END"


def strict_sql(c: str, keys: str, day: str = "d", fn: str = "avg") -> str:
    w = over(keys, day, 7)
    return f"CASE WHEN count({c}) {w} >= 7 THEN {fn}({c}) {w} END"


def lag_sql(c: str, n: int, keys: str, day: str = "d") -> str:
    return f"lag({c}, {n}) {over(keys, day)}"


def change_sql(c: str, keys: str, day: str = "d", n: int = 7) -> str:
    before = lag_sql(c, n, keys, day)
    return f"(({c}) - {before}) / nullif({before}, 0)"
