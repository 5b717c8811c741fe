"""Distinct rows, first row per key, union and merge by source priority."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in an explicit order.

    Spark keeps one row per key and map task before the shuffle (window group
    limit), so a key with any number of copies sends few of them.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") == 1).drop("_nth")


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts; a column a part does not have is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ranked_union(parts: Sequence[DataFrame], rank: str = "source_rank") -> DataFrame:
    """Union in which the place of a part in the list is its rank; 0 is the most trusted."""
    return union_by_name([p.withColumn(rank, F.lit(i)) for i, p in enumerate(parts)])


def merge_by_priority(parts: Sequence[DataFrame], keys: Sequence[str], ties: Sequence[Column] = (), rank: str = "source_rank") -> DataFrame:
    """One row per key, from the most trusted part that has it."""
    return first_per_key(ranked_union(parts, rank), keys, [F.col(rank).asc(), *ties])
