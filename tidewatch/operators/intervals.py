"""Join of times with overlapping intervals: for each time the interval of highest priority that holds it.

Per key, the ends of all intervals are ranked; between two neighbouring ends the intervals in force do not change.
An interval is a run of ranks, and is split into the few blocks of 1, 2, 4, 8 ... ranks that make it up: long
intervals into large blocks. A block keeps its best interval only. The interval in force at a rank is then the
best of the blocks above it, one of each size. So n intervals cost n log n rows however much they overlap, all by equality
of (key, size, block), and pairs of intervals or of times and intervals are never formed.

What is in force from each end on is a table of steps, and the times look it up by an as-of join: at the precision of
their columns, whatever the number of rows of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .asof import asof_join
from .panel import Panel
from .segments import SIZE, positioned


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    *,
    lo: str = "lo",
    hi: str = "hi",
    priority: Sequence[str],
    size: int = SIZE,
) -> DataFrame:
    """All rows and columns of points, with the `values` of the interval [lo, hi) in force at `time`.

    Of several the one with the highest `priority` counts, columns compared in turn, missing lowest; of equal ones the one
    with the greatest values. A missing lo or hi is open. An interval that ends before or where it
    begins holds nothing; a missing key or time is in no interval. Without keys all intervals hold for all points.
    """
    clash = sorted(set(values) & set(points.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}; rename them before the join")
    steps = staged(in_force(intervals, keys, values, lo=lo, hi=hi, priority=priority, first=points.agg(F.min(time)).scalar()), "interval-steps")
    names = [f"_k{k}" for k in range(len(keys))] or ["_k0"]
    keyed = points.withColumns({n: points[c] for n, c in zip(names, keys)} if keys else {"_k0": F.lit(0)})
    return asof_join(keyed, steps, names, time, values, right_time="_time", size=size).drop(*names)


def in_force(intervals: DataFrame, keys: Sequence[str], values: Sequence[str], *, lo: str, hi: str, priority: Sequence[str], first: Column) -> DataFrame:
    """Steps (_k0, _k1 ..., _time, values): what is in force from a time on, up to the next step of the key; missing where nothing is.

    `first` is a time from which open beginnings count.
    """
    names = [f"_k{k}" for k in range(len(keys))] or ["_k0"]
    own = [F.col(c).alias(n) for c, n in zip(keys, names)] or [F.lit(0).alias("_k0")]
    best = F.struct(F.struct(*priority).alias("priority"), F.struct(*values).alias("values")).alias("_best")
    earliest = F.least(first, intervals.agg(F.least(F.min(lo), F.min(hi))).scalar())
    spans = intervals.select(*own, F.coalesce(F.col(lo), earliest).alias("_lo"), F.col(hi).alias("_hi"), best)
    spans = spans.where("_lo is not null and (_hi is null or _lo < _hi)").dropna(subset=names)
    # the best of equal spans is enough, whatever their number
    spans = staged(spans.groupBy(*names, "_lo", "_hi").agg(F.max("_best").alias("_best")), "interval-spans")
    bounds = spans.select(*names, F.col("_lo").alias("_time")).union(spans.where("_hi is not null").select(*names, "_hi")).distinct()
    ranks = staged(positioned(bounds, Panel(tuple(names), "_time")), "interval-ranks")
    most = ranks.agg(F.max("_at")).first()[0]
    sizes = (most or 0).bit_length() + 1
    begin = ranks.withColumnsRenamed({"_time": "_lo", "_at": "_from"})
    end = ranks.withColumnsRenamed({"_time": "_hi", "_at": "_to"})
    ranked = spans.join(begin, [*names, "_lo"]).join(end, [*names, "_hi"], "left").withColumn("_to", F.coalesce("_to", F.lit(1 << (sizes - 1)).cast("long")))
    blocks = ranked.select(*names, F.explode(_blocks(sizes)).alias("_block"), "_best").groupBy(*names, "_block").agg(F.max("_best").alias("_best"))
    above = F.transform(F.sequence(F.lit(0), F.lit(sizes - 1)), lambda s: F.struct(s.alias("size"), _shifted("_at", s).alias("place")))
    held = ranks.select(*names, "_time", F.explode(above).alias("_block")).join(blocks, [*names, "_block"], "left")
    found = held.groupBy(*names, "_time").agg(F.max("_best").alias("_best"))
    return found.select(*names, "_time", *[F.col(f"_best.values.{v}").alias(v) for v in values])


def _shifted(c: str, by: Column) -> Column:
    return F.floor(F.col(c) / F.pow(F.lit(2), by)).cast("long")


def _blocks(sizes: int) -> Column:
    """Blocks (size, place) of 2^size ranks that make up the ranks from _from to before _to, at most two of each size."""

    def of(s: Column) -> Column:
        left = F.ceil(F.col("_from") / F.pow(F.lit(2), s)).cast("long")
        right = _shifted("_to", s)
        # a block stands alone where its neighbour of the same pair is not inside too
        alone = F.array(F.when((left < right) & (left % 2 == 1), left), F.when((left < right) & (right % 2 == 1), right - 1))
        return F.transform(alone, lambda p: F.struct(s.alias("size"), p.alias("place")))

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(sizes - 1)), of))
    return F.filter(every, lambda b: b["place"].isNotNull())
