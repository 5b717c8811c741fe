"""Joins.

`lookup` adds dimension columns to a fact without ever changing its row count or the
order of its columns. It runs no job: a dimension that repeats a key fails the job that
reads the joined rows, and adaptive execution decides from real sizes whether the
dimension is broadcast and which hot keys of the fact are split.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import folded
from ..functions.missing import col


def one_per_key(df: DataFrame, on: Sequence[str], what: str = "dimension") -> DataFrame:
    """df, failing when it is read if a key occurs twice. Columns keep their order.

    One aggregate by the key, whose partitioning a join by that key uses again.
    """
    rest = [c for c in df.columns if c not in on]
    counted = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(True).alias("_"), *rest)).alias("_row"))
    said = F.concat(F.lit(f"{what} repeats a key of {list(on)} "), F.col("_n").cast("string"), F.lit(" times"))
    checked = counted.withColumn("_row", F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(said)))
    return checked.select(*[F.col(c) if c in on else F.col(f"_row.{c}").alias(c) for c in df.columns])


def lookup(fact: DataFrame, dim: DataFrame, on: str | list[str], *, unique: bool = False, null_safe: bool = False) -> DataFrame:
    """Left join that keeps every fact row exactly once: the fact's columns, then the dimension's.

    Missing keys match nothing unless `null_safe`. A dimension that brings a column name the
    fact already has is an error here, one that repeats a key is an error when rows are read.
    `unique` is for a dimension that was grouped or reduced to one row per key just before.

    A key that owns a large share of the fact is split by adaptive execution (skewed left side),
    as long as nothing after the join needs the fact's rows together by the same key.
    """
    on = [on] if isinstance(on, str) else list(on)
    payload = [c for c in dim.columns if c not in on]
    clash = sorted(set(payload) & set(fact.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}; rename them before the join")
    keyed = dim if null_safe else dim.dropna(subset=on)
    joined = _left(fact, keyed if unique else one_per_key(keyed, on), on, null_safe)
    return joined.select(*fact.columns, *payload)


def _left(fact: DataFrame, dim: DataFrame, on: list[str], null_safe: bool) -> DataFrame:
    if not null_safe:
        return fact.join(dim, on, "left")
    held = {c: f"_dim_{c}" for c in on}
    right = dim.withColumnsRenamed(held)
    same = reduce(lambda a, b: a & b, [fact[c].eqNullSafe(right[held[c]]) for c in on])
    return fact.join(right, same, "left").drop(*held.values())


def left_join_feeds(left: DataFrame, right: DataFrame, on: list[str], *, unique: bool = False) -> DataFrame:
    """Fact to fact on (entity, day). A repeated key on the right would multiply rows and is an error.

    `unique` is for a feed that was reduced to one row per key just before.
    """
    _no_clash([left, right], on)
    return left.join(right if unique else one_per_key(right, on, "feed"), on, "left")


def full_join_feeds(feeds: list[DataFrame], on: list[str], *, unique: bool = False) -> DataFrame:
    """Full outer join of panels on (entity, day), each of which must hold a key once; the shuffle by `on` is done once per feed.

    `unique` is for feeds that were all reduced to one row per key just before.
    """
    _no_clash(feeds, on)
    return reduce(lambda a, b: a.join(b, on, "full"), feeds if unique else [one_per_key(f, on, "feed") for f in feeds])


def _no_clash(feeds: list[DataFrame], on: list[str]) -> None:
    seen: set[str] = set()
    for feed in feeds:
        mine = set(feed.columns) - set(on)
        if seen & mine:
            raise ValueError(f"columns on more than one side: {sorted(seen & mine)}")
        seen |= mine


def repaired(found: Column | str, own: Column | str) -> Column:
    """Dimension value, or the fact's own where the lookup found nothing."""
    return F.coalesce(col(found), col(own))


def overridden(target: Column | str, by: Column | str, table: dict) -> Column:
    """Named exceptions on top of the joined value."""
    return F.coalesce(folded(by, table), col(target))


def step_value(day: Column | str, steps: list[tuple[str, float]]) -> Column:
    """Value in force on a day, from a list of (first day, value) going up; missing before the first step. No join."""
    if not steps:
        raise ValueError("no steps")
    table = F.array(*[F.struct(F.lit(first).cast("date").alias("lo"), F.lit(value).alias("value")) for first, value in steps])
    begun = F.filter(table, lambda s: s["lo"] <= col(day))
    return F.get(begun, F.size(begun) - 1)["value"]


def step_join(df: DataFrame, day: str, steps: DataFrame) -> DataFrame:
    """Value in force on a day, from a table (lo, hi, ...) of half-open ranges; a missing hi is open.

    The ranges are laid out as days, so the lookup is an equi-join on the day and not a
    range join. Only days between the first and the last of `df` are laid out, whatever the ranges say.
    """
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count(day).alias("n"))
    first, last = ends.select("first").scalar(), ends.select("last").scalar()
    lo, hi = F.greatest("lo", first), F.least(F.coalesce(F.date_sub("hi", 1), last), last)
    laid = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<date>"))
    return lookup(df, steps.withColumn(day, F.explode(laid)).drop("lo", "hi"), day)


def between_days(day: Column | str, after: str, before: str) -> Column:
    """Strictly between two dates."""
    return (col(day) > F.lit(after).cast("date")) & (col(day) < F.lit(before).cast("date"))
