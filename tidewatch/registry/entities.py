"""Queries over entities of which one holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import asof_join
from ..operators.intervals import interval_join
from ..operators.panel import Panel
from ..operators.segments import Columns, with_windows
from .book import query, rounded
from .tables import load

#: rows of an entity that go into one task; small, so that the test tables have entities beyond it
SIZE = 1000
USERS = Panel(("u",), "ts", ties=("event_id",))
USERS_SQL = """
SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS u, CAST(round(value * 100) AS BIGINT) AS cents FROM events"""


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Events by user in cents; every third event is given to user 0."""
    events = load(spark, sf, "events")
    owner = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    return events.select("event_id", "ts", owner.alias("u"), F.round(F.col("value") * 100).cast("long").alias("cents"))


def known(c: str) -> Column:
    return F.when(F.col(c) % 7 != 0, F.col(c))


W = "OVER (PARTITION BY u ORDER BY ts, event_id"


@query(
    "hot_entity_windows",
    f"""
WITH e AS ({USERS_SQL}), k AS (SELECT *, CASE WHEN cents % 7 <> 0 THEN cents END AS m FROM e),
     a AS (SELECT *, avg(cents) {W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean FROM k)
SELECT event_id, u, cents, lag(cents) {W}) AS before, cents - lag(cents) {W}) AS change, round(mean, 6) AS mean_7, round(lag(mean, 7) {W}), 6) AS mean_7_before,
       CAST(sum(cents) {W}) AS BIGINT) AS total, count(m) {W}) AS n_known, max(cents) {W}) AS high, last_value(m IGNORE NULLS) {W}) AS last_known,
       max(cents) OVER (PARTITION BY u) AS peak, count(*) OVER (PARTITION BY u) AS n,
       last_value(m IGNORE NULLS) {W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS newest_known
FROM a""",
)
def hot_entity_windows(spark: SparkSession, sf: str) -> DataFrame:
    columns = Columns(
        fixed={
            "before": lambda p: p.lag("cents"),
            "change": lambda p: p.delta("cents"),
            "mean_7": lambda p: p.rolling_mean("cents"),
            "mean_7_before": lambda p: p.lag("mean_7", 7),
        },
        running={"total": ("sum", "cents"), "n_known": ("count", known("cents")), "high": ("max", "cents"), "last_known": ("last", known("cents"))},
        whole={"peak": ("max", "cents"), "n": ("count", F.lit(1)), "newest_known": ("last", known("cents"))},
        reach=13,
    )
    return rounded(with_windows(users(spark, sf), USERS, columns, SIZE).drop("ts"))


ORDERS_SQL = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS u, o_orderkey, o_totalprice,
       TIMESTAMP '2024-01-01' + to_minutes(CAST(18 * date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER)) AS ordered_at FROM orders"""


def orders_of_users(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by user, at times within the month of the events."""
    days = F.date_diff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(mins=days * 18)
    owner = F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey"))
    return load(spark, sf, "orders").select(owner.alias("u"), "o_orderkey", "o_totalprice", at.alias("ordered_at"))


@query(
    "asof_events_orders",
    f"""
WITH e AS ({USERS_SQL}), o AS (SELECT * FROM ({ORDERS_SQL}) QUALIFY row_number() OVER (PARTITION BY u, ordered_at ORDER BY o_orderkey DESC) = 1)
SELECT event_id, e.u, o_orderkey, o_totalprice, ordered_at FROM e ASOF LEFT JOIN o ON e.u = o.u AND e.ts >= o.ordered_at""",
)
def asof_events_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Every event with its user's newest order; the one with the highest number, of orders at one time."""
    orders = orders_of_users(spark, sf)
    found = asof_join(users(spark, sf), orders, ["u"], "ts", ["o_orderkey", "o_totalprice", "ordered_at"], right_time="ordered_at", ties=["o_orderkey"], size=SIZE)
    return found.select("event_id", "u", "o_orderkey", "o_totalprice", "ordered_at")


@query(
    "interval_corrections",
    """
WITH i AS (
  SELECT event_type, CASE WHEN event_id % 400 <> 0 THEN ts END AS lo, CASE WHEN event_id % 60 <> 0 THEN ts + to_hours(CAST(event_id % 37 AS INTEGER)) END AS hi,
    event_id % 11 AS rank, event_id AS corrected_by, value AS corrected FROM events WHERE event_id % 20 = 0
  UNION ALL SELECT DISTINCT event_type, NULL, NULL, -1, -1, 0 FROM events),
found AS (
  SELECT e.event_id, e.event_type, corrected_by, corrected, row_number() OVER (PARTITION BY e.event_id ORDER BY rank DESC, corrected_by DESC) AS nr
  FROM events e LEFT JOIN i ON i.event_type = e.event_type AND (i.lo IS NULL OR i.lo <= e.ts) AND (i.hi IS NULL OR e.ts < i.hi))
SELECT event_id, event_type, corrected_by, corrected FROM found WHERE nr = 1""",
)
def interval_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Every event with the correction in force at its time; some are open at an end, and one of each type covers everything."""
    events = load(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    hours = F.make_dt_interval(hours=F.col("event_id") % 37)
    some = events.where("event_id % 20 = 0").select(
        "event_type",
        F.when(F.col("event_id") % 400 != 0, F.col("ts")).alias("lo"),
        F.when(F.col("event_id") % 60 != 0, F.col("ts") + hours).alias("hi"),
        (F.col("event_id") % 11).alias("rank"),
        F.col("event_id").alias("corrected_by"),
        F.col("value").alias("corrected"),
    )
    every = events.select("event_type").distinct().selectExpr("event_type", "cast(null as timestamp_ntz) lo", "cast(null as timestamp_ntz) hi", "-1L rank", "-1L corrected_by", "0D corrected")
    found = interval_join(events, some.unionByName(every), ["event_type"], "ts", ["corrected_by", "corrected"], priority=["rank", "corrected_by"], size=SIZE)
    return found.select("event_id", "event_type", "corrected_by", "corrected")
