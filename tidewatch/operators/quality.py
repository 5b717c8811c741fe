"""Data-quality and freshness reports: one small row per table or feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import ratio
from .dedupe import union_by_name


def key_uniqueness(df: DataFrame, keys: Sequence[str] | None = None, name: str | None = None) -> DataFrame:
    """Rows, distinct keys (or distinct whole rows) and their ratio.

    Counted by a map-side combined aggregate per key first, so copies collapse
    before the shuffle.
    """
    per_key = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    out = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
    ).withColumn("uniqueness", ratio("n_distinct", "n_rows"))
    return out if name is None else out.select(F.lit(name).alias("check"), "*")


def frequency(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def freshness(feeds: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Latest day with a non-missing measure, per feed given as (table, day, measure)."""
    rows = [
        df.agg(
            F.lit(name).alias("feed"),
            F.max(F.when(F.col(measure).isNotNull(), F.col(day))).alias("last_date"),
            F.count(measure).alias("n_values"),
        )
        for name, (df, day, measure) in feeds.items()
    ]
    return union_by_name(rows)


def unparsed(df: DataFrame, parsed: dict[str, Column]) -> DataFrame:
    """(column, n_rows, n_text, n_unparsed) of text columns: how many hold text, and how many of these `parsed` makes missing.

    One aggregate over the table, however many columns are looked at.
    """
    sums = []
    for c, value in parsed.items():
        text = F.length(F.trim(c)) > 0
        sums += [F.count(F.when(text, 1)), F.count(F.when(text & value.isNull(), 1))]
    counts = df.agg(F.array(*sums).alias("n"), F.count(F.lit(1)).alias("n_rows"))
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.get("n", F.lit(2 * k)).alias("n_text"), F.get("n", F.lit(2 * k + 1)).alias("n_unparsed")) for k, c in enumerate(parsed)])
    return counts.select(F.explode(each).alias("e"), "n_rows").select("e.column", "n_rows", "e.n_text", "e.n_unparsed")
