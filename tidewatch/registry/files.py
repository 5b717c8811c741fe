"""File queries: whole tables written in the forms the feeds come in, and read back.

The files go to the shared folder; every row makes the trip.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.delimited import read_banner, read_feed, read_positional
from ..sources.inference import read_inferred
from ..sources.extracts import write_extract, write_table
from ..sources.json_chunks import read_large_records
from ..sources.manifest import read_manifest
from ..sources.staging import shared_folder
from ..sources.versions import VersionedTable, Versions, part_name
from .book import query
from .tables import load

LATIN = "ISO-8859-1"
ORDERS_PER_DOCUMENT = 2_000_000


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/files/{name}-{uuid.uuid4().hex}"


@query(
    "csv_typed_by_position",
    "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders",
)
def csv_typed_by_position(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh(spark, "typed")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority")
    write_extract(orders, path)
    types = {"o_orderkey": "long", "o_custkey": "long", "o_totalprice": "double", "o_orderdate": "date", "o_orderpriority": "string"}
    return read_positional(spark, path, types)


@query(
    "csv_text_then_cast",
    """
SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total_price,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS cust_key, o_orderpriority || ', "as written"' AS note, NULL::DOUBLE AS deaths FROM orders""",
)
def csv_text_then_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers with text among them, quoted commas, and a declared column the file does not have."""
    path = fresh(spark, "dirty")
    dirty = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order Key"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).otherwise(F.lit("not reported")).alias("totalPrice"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").cast("string")).otherwise(F.lit("n/a")).alias("Cust-Key"),
        F.concat("o_orderpriority", F.lit(', "as written"')).alias("Note"),
    )
    dirty.write.options(header=True, quote='"', escape='"').csv(path)
    return read_feed(spark, path, {"order_key": "long", "total_price": "double", "cust_key": "long", "note": "string", "deaths": "double"})


@query("csv_banner_latin", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' Doña Ana' AS name, c_acctbal AS balance FROM customer")
def csv_banner_latin(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh(spark, "banner")
    rows = load(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.concat("c_name", F.lit(" Doña Ana")).alias("name"), F.col("c_acctbal").cast("string").alias("balance")
    )
    heading = spark.createDataFrame([("GEO.id", "GEO.name", "HD01"), ("Id", "Geography", "Balance")], rows.schema)
    heading.unionByName(rows).write.options(header=False, encoding=LATIN).csv(path)
    return read_banner(spark, path, {"id": "string", "name": "string", "balance": "double"}, {"id": ["GEO.id", "Id"]}, LATIN)


@query(
    "manifest_scan",
    """
WITH days AS (SELECT d, CAST(row_number() OVER (ORDER BY d DESC) - 1 AS INTEGER) AS source_rank FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events))
SELECT event_id, user_id, event_type, value, source_rank FROM events JOIN days ON d = CAST(ts AS DATE) WHERE source_rank < 14""",
)
def manifest_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One archive folder per day; the manifest lists them all and the newest 14 are read."""
    path = fresh(spark, "archives")
    events = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))
    events.hint("rebalance", "day").write.partitionBy("day").options(header=True).csv(path)
    manifest = events.select("day").distinct().select(
        F.concat(F.date_format("day", "MM/dd/yyyy"), F.lit(" 10:00:00 AM")).alias("update_date"),
        F.concat(F.lit("day="), F.col("day").cast("string")).alias("archive_link"),
    )
    return read_manifest(spark, manifest, {"event_id": "long", "user_id": "long", "event_type": "string", "value": "double"}, base=path)


@query(
    "table_by_year",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year_part FROM orders
WHERE o_orderdate >= TIMESTAMP '1999-01-01'""",
)
def table_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """The published form: later years alone are read back."""
    path = fresh(spark, "table")
    write_table(load(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), "o_totalprice"), path, "d")
    return spark.read.schema("o_orderkey long, d date, o_totalprice double, year_part int").parquet(path).where(F.col("year_part") >= 1999)


@query(
    "publish_changed_years",
    """
WITH o AS (SELECT o_orderkey, o_orderdate, o_totalprice FROM orders), k AS (SELECT year(o_orderdate) AS y FROM o WHERE o_orderkey = (SELECT min(o_orderkey) FROM o))
SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n, year(o_orderdate) = (SELECT any_value(y) FROM k) AS written_again FROM o GROUP BY 1, 3""",
)
def publish_changed_years(spark: SparkSession, sf: str) -> DataFrame:
    """All orders published by year, then again with another price for the first one: which years are written again."""
    orders = load(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), "o_totalprice")
    table = VersionedTable(Versions(spark, fresh(spark, "orders")), "orders", orders.schema, "y")
    first = table.publish(orders).of("orders")
    changed = F.col("o_orderkey") == orders.agg(F.min("o_orderkey")).scalar()
    second = table.publish(orders.withColumn("o_totalprice", F.when(changed, F.lit(-1.0)).otherwise(F.col("o_totalprice"))), whole=True).of("orders")
    again = part_name(F.col("y")).isin([n for n in second if second[n] != first[n]])
    return table.read().groupBy("y").agg(F.count("*").alias("n")).withColumn("written_again", again)


@query(
    "csv_inferred_types",
    """
SELECT o_orderkey AS order_key,
  CASE o_orderkey % 3 WHEN 0 THEN o_totalprice WHEN 1 THEN round(o_totalprice) WHEN 2 THEN CASE WHEN o_custkey % 4 <> 0 THEN o_totalprice END END AS total,
  CAST(o_orderdate AS DATE) AS ordered, CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus ELSE CAST(o_custkey % 5 AS VARCHAR) END AS status,
  lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS code, CASE WHEN o_orderkey % 3 = 1 THEN o_custkey END AS extra,
  'order_key bigint, total double, ordered date, status string, code string, extra bigint' AS types FROM orders""",
)
def csv_inferred_types(spark: SparkSession, sf: str) -> DataFrame:
    """Three folders that disagree in columns, their order and what their values look like; no type is declared."""
    orders = load(spark, sf, "orders")
    third, key, status = F.col("o_orderkey") % 3, F.col("o_orderkey").alias("Order Key"), (F.col("o_custkey") % 5).alias("Status")
    day, code = F.to_date("o_orderdate"), F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("Code")
    total = F.when(F.col("o_custkey") % 4 != 0, F.col("o_totalprice").cast("string")).otherwise("N/A")
    parts = [
        orders.where(third == 0).select(key, F.col("o_totalprice").alias("Total"), day.alias("Ordered"), status, code),
        orders.where(third == 1).select(F.date_format(day, "M/d/yyyy").alias("Ordered"), key, F.round("o_totalprice").cast("long").alias("Total"), F.col("o_orderstatus").alias("Status"), code, F.col("o_custkey").alias("Extra")),
        orders.where(third == 2).select(key, total.alias("Total"), day.alias("Ordered"), status, code),
    ]
    paths = [fresh(spark, f"disagree-{k}") for k in range(3)]
    for part, path in zip(parts, paths):
        part.write.option("header", True).csv(path)
    out = read_inferred(spark, paths).select("order_key", "total", "ordered", "status", "code", "extra")
    return out.withColumn("types", F.lit(", ".join(f"{c} {t}" for c, t in out.dtypes)))


@query(
    "json_large_document",
    """SELECT o_orderkey, o_totalprice, '}] "' || o_orderpriority || '\\ {' AS note, o_custkey FROM orders""",
)
def json_large_document(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as one document of one file, with braces and quotes in its texts; read by as many tasks as it has blocks.

    A file has one writer, so beyond ORDERS_PER_DOCUMENT orders there are more documents, each of them of many blocks.
    """
    path = fresh(spark, "document")
    note = F.concat(F.lit('}] "'), "o_orderpriority", F.lit("\\ {")).alias("note")
    record = F.to_json(F.struct("o_orderkey", "o_totalprice", note, F.struct("o_custkey").alias("of")))
    orders = load(spark, sf, "orders")
    documents = max(1, -(-orders.count() // ORDERS_PER_DOCUMENT))
    lines = orders.select((F.monotonically_increasing_id() % documents).alias("document"), F.lit(1).alias("place"), F.concat(record, F.lit(",")).alias("value"))
    frame = F.array(*[
        F.struct(F.lit(place).alias("place"), F.lit(text).alias("value"))
        for place, text in ((0, '{"made": {"orders": [{"o_orderkey": -2}]}, "orders": ['), (2, '{"o_orderkey": -1}], "others": [{"o_orderkey": -3}]}'))
    ])
    frames = spark.range(documents).select(F.col("id").alias("document"), F.inline(frame))
    placed = frames.union(lines).repartition("document").sortWithinPartitions("document", "place")
    placed.select("document", "value").write.partitionBy("document").text(path)
    columns = {"o_orderkey": "long", "o_totalprice": "double", "note": "string", "of": "struct<o_custkey: long>"}
    records = read_large_records(spark, path, columns, "orders")
    return records.where("o_orderkey <> -1").select("o_orderkey", "o_totalprice", "note", "of.o_custkey")
