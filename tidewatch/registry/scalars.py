"""Scalar-function queries: dates, codes, labels, rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import buckets, join_code, pad_code
from ..functions.dates import ANY_FORMATS, COMPACT, ISO, as_of_columns, calendar_parts, date_head, in_last_week, parse_date, weekday
from ..functions.missing import clip, number, rate_per
from ..operators.enrich import lookup
from ..operators.filters import latest_of
from ..operators.quality import frequency
from ..operators.reshape import lengthen
from ..plans.hospital import ADULT, CHILD, band_label, band_status
from .book import query, rounded
from .tables import EVENTS_SQL, NATIONS, NATIONS_SQL, events_panel, load, nations, nations_panel, rows

N = "n_name"


@query(
    "date_parts",
    """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, d, dayname(d) AS weekday, CAST(year(d) AS INTEGER) AS year, strftime(d, '%b') AS month, CAST(month(d) AS INTEGER) AS month_num,
       CAST(day(d) AS INTEGER) AS day, year(d) || '-' || strftime(d, '%b') || '-' || day(d) AS display_date FROM o""",
)
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    days = load(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return days.withColumns({"weekday": weekday("d"), **calendar_parts("d")})


@query(
    "date_parse_multi",
    """
WITH o AS (SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN d END AS any_date,
       CASE WHEN o_orderpriority = '2-HIGH' THEN d END AS us_date, CASE WHEN o_orderpriority = '3-MEDIUM' THEN d END AS compact_date,
       CASE WHEN o_orderpriority = '1-URGENT' THEN d END AS iso_date, d AS head_date,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS key_number FROM o""",
)
def date_parse_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Every priority writes its dates in another way; low ones write no date at all."""
    day, kind = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(kind == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(kind == "2-HIGH", F.date_format(day, "M/d/yyyy"))
        .when(kind == "3-MEDIUM", F.date_format(day, "yyyyMMdd"))
        .when(kind == "4-NOT SPECIFIED", F.date_format(day, "d-MMM-yyyy"))
        .otherwise(F.lit("not reported"))
    )
    dirty = load(spark, sf, "orders").select(
        "o_orderkey",
        text.alias("t"),
        F.concat(F.date_format(day, "MM/dd/yyyy"), F.lit(" 04:00:00 PM")).alias("stamp"),
        F.when(kind == "5-LOW", F.lit("n/a")).otherwise(F.col("o_orderkey").cast("string")).alias("k"),
    )
    return dirty.select(
        "o_orderkey",
        parse_date("t", ANY_FORMATS).alias("any_date"),
        parse_date("t", "M/d/yyyy").alias("us_date"),
        parse_date("t", COMPACT).alias("compact_date"),
        parse_date("t", ISO).alias("iso_date"),
        date_head("stamp").alias("head_date"),
        number("k", "long").alias("key_number"),
    )


@query(
    "date_flags",
    f"""
WITH p AS (SELECT event_type, d, n FROM ({EVENTS_SQL})), m AS (SELECT *, (SELECT max(d) FROM p) AS max_date FROM p)
SELECT event_type, d, n, max_date, max_date - 7 AS one_week_date, max_date - 14 AS two_week_date,
       CASE WHEN d = max_date THEN 'Yes' ELSE 'No' END AS max_date_ind, dayname(d) AS weekday, dayname(max_date) AS max_weekday,
       CASE WHEN dayname(d) = dayname(max_date) THEN 'Yes' ELSE 'No' END AS weekday_match,
       CASE WHEN d + 7 > max_date THEN 'Y' ELSE 'N' END AS lst_wk_flag FROM m""",
)
def date_flags(spark: SparkSession, sf: str) -> DataFrame:
    newest = latest_of(load(spark, sf, "events").select(F.to_date("ts").alias("d")), "d")
    panel = events_panel(spark, sf).drop("v").withColumn("max_date", newest).withColumns(as_of_columns("d"))
    return panel.withColumn("lst_wk_flag", in_last_week("d", "max_date"))


@query(
    "pad_code",
    """
WITH c AS (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) || CAST(c_custkey AS VARCHAR) AS code FROM customer
     WHERE c_acctbal >= 0 UNION ALL SELECT c_custkey, NULL FROM customer WHERE NOT c_acctbal >= 0)
SELECT c_custkey, code, CASE WHEN length(code) < 5 THEN lpad(code, 5, '0') ELSE code END AS padded FROM c""",
)
def pad_codes(spark: SparkSession, sf: str) -> DataFrame:
    part = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))
    codes = load(spark, sf, "customer").select("c_custkey", join_code(part, "c_custkey").alias("code"))
    return codes.withColumn("padded", pad_code("code"))


BANDS = ["18_19", "20_29", "60_69", "80", "unknown"]
BAND_NAMES = [f"{ADULT}_covid_{s}_{b}" for s in ("confirmed", "suspected") for b in BANDS] + [f"{CHILD}_covid_{s}" for s in ("confirmed", "suspected")]


def _band_sql(name: str) -> str:
    status = "R" if "confirmed" in name else "A"
    line = 7 if name.startswith(CHILD) else BANDS.index(name.split("ed_", 1)[1]) + 1
    return f"count(*) FILTER (WHERE l_returnflag = '{status}' AND l_linenumber = {line}) AS {name}"


BAND_LABELS = {"18_19": "18 to 19", "20_29": "20 to 29", "60_69": "60 to 69", "80": "80", "unknown": "unknown"}


@query(
    "age_band_relabel",
    f"""
WITH w AS (SELECT CAST(l_shipdate AS DATE) AS d, {', '.join(_band_sql(n) for n in BAND_NAMES)} FROM lineitem GROUP BY 1),
     u AS (SELECT d, name, value FROM w UNPIVOT (value FOR name IN ({', '.join(BAND_NAMES)})))
SELECT d, CASE {' '.join(f"WHEN ends_with(name, '{b}') THEN '{label}'" for b, label in BAND_LABELS.items())} ELSE 'pediatric' END AS age_group,
       CASE WHEN contains(name, 'confirmed') THEN 'confirmed' ELSE 'suspected' END AS status, value FROM u""",
)
def age_band_relabel(spark: SparkSession, sf: str) -> DataFrame:
    def band(name: str):
        line = 7 if name.startswith(CHILD) else BANDS.index(name.split("ed_", 1)[1]) + 1
        return rows((F.col("l_returnflag") == ("R" if "confirmed" in name else "A")) & (F.col("l_linenumber") == line)).alias(name)

    wide = load(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(*[band(n) for n in BAND_NAMES])
    long = lengthen(wide, ["d"], BAND_NAMES)
    return long.select("d", band_label(F.col("name")).alias("age_group"), band_status(F.col("name")).alias("status"), "value")


@query(
    "bucket_thresholds",
    """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal >= -500 THEN floor(c_acctbal / 100) END AS pct FROM customer)
SELECT c_custkey, pct, CASE WHEN pct >= 70 THEN '70-100' WHEN pct >= 60 THEN '60-70' WHEN pct >= 50 THEN '50-60' WHEN pct IS NOT NULL THEN '0-50' END AS bin FROM c""",
)
def bucket_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    pct = F.when(F.col("c_acctbal") >= -500, F.floor(F.col("c_acctbal") / 100).cast("double"))
    customers = load(spark, sf, "customer").select("c_custkey", pct.alias("pct"))
    return customers.withColumn("bin", buckets("pct", [(None, "0-50"), (50, "50-60"), (60, "60-70"), (70, "70-100")]))


@query(
    "clip_change",
    f"""
WITH c AS (SELECT n_name, d, floor(amt / 1000) AS k, floor(amt / 1000) - lag(floor(amt / 1000)) OVER (PARTITION BY n_name ORDER BY d) AS change FROM ({NATIONS_SQL}))
SELECT n_name, d, k, change, CASE WHEN change > 500 THEN 500 WHEN change < -500 THEN -500 ELSE change END AS clipped FROM c""",
)
def clip_change(spark: SparkSession, sf: str) -> DataFrame:
    panel = nations_panel(spark, sf).select(N, "d", F.floor(F.col("amt") / 1000).cast("double").alias("k"))
    changed = panel.withColumn("change", NATIONS.delta("k"))
    return changed.withColumn("clipped", clip("change", -500.0, 500.0))


@query(
    "rate_per_1000",
    f"""
WITH c AS (SELECT n_name, count(*) AS people FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1)
SELECT n_name, d, n, people, round(n / nullif(people, 0) * 1000, 6) AS per1k FROM ({NATIONS_SQL}) LEFT JOIN c USING (n_name)""",
)
def rate_per_1000(spark: SparkSession, sf: str) -> DataFrame:
    people = lookup(frequency(load(spark, sf, "customer"), "c_nationkey").withColumnRenamed("n", "people"), nations(spark, sf, "c_nationkey"), "c_nationkey")
    panel = lookup(nations_panel(spark, sf).select(N, "d", "n"), people.drop("c_nationkey"), N)
    return rounded(panel.withColumn("per1k", rate_per("n", "people")))
