"""Types of text columns, found from all of their values.

A value is missing, a whole number, a number, a truth value, a date, a time or text. How often each kind
occurs in a column is counted in one map-side combined aggregate over all rows; no sample is taken. Counts of
files read apart add up, so what is known of older files is kept and merged. The type of a column is the narrowest one
that holds every kind it has: whole numbers and numbers make numbers, dates and times make times, anything else text.

Digits with zeros in front are codes, so they are text; so are whole numbers of more than 18 digits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ISO, US, parse_date
from ..operators.dedupe import union_by_name
from .delimited import headers, read_text

KINDS = ("missing", "whole", "number", "truth", "date", "time", "text")
MISSING = ("", "NA", "N/A", "null")
DATES = (ISO, US)
WHOLE = r"^[+-]?(0|[1-9][0-9]{0,17})$"
NUMBER = r"^[+-]?(((0|[1-9][0-9]*)\.[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(0|[1-9][0-9]*)[eE][+-]?[0-9]+)$"
DATE = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"
#: kinds a column may have, and its type then; the first that fits
LATTICE = (
    ({"whole"}, "bigint"),
    ({"whole", "number"}, "double"),
    ({"truth"}, "boolean"),
    ({"date"}, "date"),
    ({"date", "time"}, "timestamp_ntz"),
)


@dataclass(frozen=True)
class Kinds:
    """How often each kind occurs in one column."""

    counts: Mapping[str, int]

    def merged(self, other: Kinds) -> Kinds:
        return Kinds({k: self.counts.get(k, 0) + other.counts.get(k, 0) for k in KINDS})

    def type(self, tolerance: float = 0.0) -> str:
        """The column's type. Text is overlooked while it is at most `tolerance` of the values there are; it is then missing."""
        there = {k: n for k, n in self.counts.items() if n and k != "missing"}
        if there.get("text", 0) <= tolerance * sum(there.values()):
            there.pop("text", None)
        return next((t for kinds, t in LATTICE if there and set(there) <= kinds), "string")


def is_missing(c: Column, missing: Sequence[str] = MISSING) -> Column:
    return c.isNull() | F.trim(c).isin(*missing)


def kind(c: Column, missing: Sequence[str] = MISSING) -> Column:
    """Place of the value's kind in KINDS. What looks like a date or a time and is none is text."""
    text = F.trim(c)
    found = (
        F.when(is_missing(c, missing), "missing")
        .when(text.rlike(WHOLE), "whole")
        .when(text.rlike(NUMBER), "number")
        .when(F.lower(text).isin("true", "false"), "truth")
        .when(text.rlike(DATE), F.when(parse_date(text, DATES).isNotNull(), "date").otherwise("text"))
        .when(text.rlike(TIME), F.when(text.try_cast("timestamp_ntz").isNotNull(), "time").otherwise("text"))
        .otherwise("text")
    )
    return found


def infer(df: DataFrame, missing: Sequence[str] = MISSING) -> dict[str, Kinds]:
    """The kinds of every text column of df, in one pass over its rows."""
    named = [f"c{k}" for k in range(len(df.columns))]
    kinds = df.select(*[kind(F.col(f"`{c}`"), missing).alias(n) for c, n in zip(df.columns, named)])
    counts = [F.count_if(F.col(n) == k).alias(f"{n}_{k}") for n in named for k in KINDS]
    row = kinds.agg(*counts).first() if counts else {}
    return {c: Kinds({k: row[f"{n}_{k}"] for k in KINDS}) for c, n in zip(df.columns, named)}


def typed_as(c: Column, to: str, missing: Sequence[str] = MISSING) -> Column:
    """Text to an inferred type; what does not fit is missing."""
    text = F.trim(c)
    value = {
        "string": c,
        "date": parse_date(text, DATES),
        "timestamp_ntz": F.coalesce(F.when(text.rlike(TIME), text.try_cast("timestamp_ntz")), parse_date(text, DATES).cast("timestamp_ntz")),
    }
    return F.when(~is_missing(c, missing), value[to] if to in value else text.try_cast(to))


def with_types(df: DataFrame, found: Mapping[str, Kinds], tolerance: float = 0.0, missing: Sequence[str] = MISSING) -> DataFrame:
    """Text columns cast to their inferred types."""
    return df.select(*[typed_as(F.col(f"`{c}`"), found[c].type(tolerance), missing).alias(c) for c in df.columns])


def read_texts(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> DataFrame:
    """Files of any headers as text columns, put together by cleaned name: one scan per header."""
    parts = [read_text(spark, files, encoding) for files in headers(spark, paths, encoding).values()]
    if not parts:
        raise ValueError(f"no file holds a header: {paths}")
    return union_by_name(parts)


def read_inferred(spark: SparkSession, paths: list[str], tolerance: float = 0.0, missing: Sequence[str] = MISSING, encoding: str = "UTF-8", known: Mapping[str, Kinds] | None = None) -> DataFrame:
    """Files of any headers with the types that hold all their values, and those counted in `known`."""
    texts = read_texts(spark, paths, encoding)
    found = infer(texts, missing)
    merged = {c: k.merged(known[c]) if known and c in known else k for c, k in found.items()}
    return with_types(texts, merged, tolerance, missing)
