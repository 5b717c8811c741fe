"""One large JSON document read by many tasks.

Spark's text reader cuts the file into blocks and these into fragments at every closing brace. Whether a brace is
structure or lies in a string, and how deep it closes, depends on all that comes before; so

* a block is summed up as what it does to the state at its entry: it turns quotes over or not, and goes so
  many levels up or down;
* the sums of the blocks are composed in file order, which gives each block its entry state;
* inside a block the state runs along with the fragments.

A record ends with the brace that brings the depth back to that of the array. Its fragments are put together, across
the border of blocks too, and parsed by from_json. One record has to fit into a task, a block
and a document need not. Documents are UTF-8, uncompressed, and their records are objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import ddl
from .staging import staged

BLOCK = ["file", "block"]
UPTO = (Window.unboundedPreceding, Window.currentRow)
BEFORE = (Window.unboundedPreceding, -1)


def read_large_records(spark: SparkSession, path: str | list[str], columns: dict[str, str], field: str | None = None) -> DataFrame:
    """The records of an array: the document itself, or the array in `field` of the document. Values that do not fit are missing."""
    rows = _fragments(spark, path)
    rows = staged(_with_depth(rows, field), "json-fragments")
    texts = _records(rows, 1 if field is None else 2, field)
    parsed = texts.select(F.from_json("text", ddl(columns), {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.select("r.*")


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Texts between closing braces, with the place of each: file, start of its block, order in the block."""
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("text"),
    )


def _count(c: Column, of: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(of)))


def _unescaped(text: Column) -> Column:
    """The text without escaped characters. A fragment ends with a brace, which nothing escapes, so no pair is cut."""
    return F.when(text.contains("\\"), F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)


def _outside(text: Column, inside: Column) -> Column:
    """What is left of a text without its strings; `inside` says whether it begins in one."""
    quoted = F.concat(F.when(inside, F.lit('"')).otherwise(F.lit("")), _unescaped(text))
    return F.regexp_replace(quoted, r'"[^"]*+("|$)', "")


def _levels(outside: Column) -> Column:
    """Levels gained by a text without strings."""
    return _count(outside, "{") + _count(outside, "[") - _count(outside, "]") - _count(outside, "}")


def _entry(rows: DataFrame, amount: str) -> DataFrame:
    """Per block the sum of `amount` over the blocks before it in the file; a few rows a file."""
    sums = rows.groupBy(*BLOCK).agg(F.sum(amount).alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("file").orderBy("block").rowsBetween(*BEFORE))
    return sums.select(*BLOCK, F.coalesce(before, F.lit(0)).alias("_entry"))


def _running(rows: DataFrame, amount: str, name: str, frame: tuple) -> DataFrame:
    """rows with the sum of `amount` from the file's start: what comes with the block, and what has come in it."""
    within = F.coalesce(F.sum(amount).over(Window.partitionBy(*BLOCK).orderBy("place").rowsBetween(*frame)), F.lit(0))
    return rows.join(F.broadcast(_entry(rows, amount)), BLOCK).withColumn(name, F.col("_entry") + within).drop("_entry")


def _with_depth(fragments: DataFrame, field: str | None) -> DataFrame:
    """Fragments with the depth before and behind them, and whether they end a level."""
    quotes = staged(fragments.withColumn("quotes", _count(_unescaped(F.col("text")), '"').cast("long")), "json-quotes")
    rows = _running(quotes, "quotes", "seen", BEFORE)
    begins_inside = F.col("seen") % 2 == 1
    rows = rows.withColumn("inside", begins_inside)
    closes = (F.col("seen") + F.col("quotes")) % 2 == 0
    gained = _levels(_outside(F.col("text"), F.col("inside"))) - F.when(closes, 1).otherwise(0)
    rows = rows.withColumns({"closes": closes, "gained": gained.cast("long")}).select(*BLOCK, "place", "text", "inside", "closes", "gained")
    rows = staged(rows, "json-levels")
    return _running(rows, "gained", "depth", UPTO)


def _key(field: str) -> str:
    name = "".join("\\" + c if not c.isalnum() and c.isascii() else c for c in field)
    return r'(?<!\\)"' + name + r'"\s*:\s*\['


def _array_begin(field: str) -> Column:
    """Characters from the start of a fragment to behind the opening of the field's array at the document's own level; missing where it is not there."""
    text, pieces = F.col("text"), F.split(F.col("text"), _key(field))
    before = F.col("depth") - F.col("gained")

    def level(n: Column) -> Column:
        # depth where the n-th occurrence stands: of the text up to it, whose strings are whole
        head = F.array_join(F.slice(pieces, 1, n), f'"{field}":[')
        return before + _levels(_outside(head, F.col("inside")))

    found = F.get(F.filter(F.sequence(F.lit(1), F.size(pieces) - 1), lambda n: level(n) == 1), 0)
    keys = F.regexp_extract_all(text, F.lit(_key(field)), F.lit(0))
    upto = F.transform(F.sequence(F.lit(1), found), lambda n: F.concat(F.get(pieces, n - 1), F.get(keys, n - 1)))
    return F.when((F.size(pieces) > 1) & found.isNotNull(), F.length(F.array_join(upto, "")))


def _records(rows: DataFrame, depth: int, field: str | None) -> DataFrame:
    """The text of each record."""
    if field is not None:
        rows = _of_array(rows, field)
    ends = F.when(F.col("closes") & (F.col("depth") == depth), 1).otherwise(0)
    numbered = _running(rows.withColumn("ends", ends.cast("long")), "ends", "record", BEFORE)
    parts = numbered.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "place", F.concat("text", F.lit("}")).alias("text")))).alias("parts"), F.max("ends").alias("ended")
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    return parts.where("ended = 1").select(F.regexp_replace(text, r"^[\x{FEFF}\s,\[]+", "").alias("text"))


def _of_array(rows: DataFrame, field: str) -> DataFrame:
    """The fragments of the field's array, the first one without what comes before the array.

    What is known of a file is one row, sent to all tasks: fragments stay where they are, however many one file has.
    """
    rows = rows.withColumn("_begin", _array_begin(field)).withColumn("_spot", F.struct("block", "place"))
    firsts = rows.where("_begin is not null").groupBy("file").agg(F.min("_spot").alias("_first"))
    inside = rows.join(F.broadcast(firsts), "file").where(F.col("_spot") >= F.col("_first"))
    first = F.col("_spot") == F.col("_first")
    inside = inside.withColumn("text", F.when(first, F.substr("text", F.col("_begin") + 1)).otherwise(F.col("text")))
    # between its records, the first bracket that is not another record's ends the array
    between = first | (F.col("depth") - F.col("gained") == 2)
    mark = F.regexp_extract(_outside(F.col("text"), F.col("inside") & ~first), r"[\[\]{]", 0)
    over = inside.where(between & (mark == "]")).groupBy("file").agg(F.min("_spot").alias("_last"))
    held = inside.join(F.broadcast(over), "file", "left").where(F.col("_last").isNull() | (F.col("_spot") < F.col("_last")))
    return held.drop("_begin", "_spot", "_first", "_last")
