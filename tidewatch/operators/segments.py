"""Windows over entities that are larger than one task.

A plain window brings all rows of an entity into one task. Here only entities of at most `size` rows go that
way. A larger one is cut into segments of `size` rows:

* its rows are laid out by ranges of (entity, order), and each row gets its position in the entity from the
  row counts of the ranges before its own;
* lags, changes and rolling values look `reach` rows back, so each segment is given the last `reach` rows of the
  one before (its halo), and the window is computed per segment;
* running values are computed per segment and added to what the summaries of the segments before hold:
  a two-level scan, with one row per segment on the upper level;
* values of the whole entity are merged from the segments' summaries.

Results are the same as those of plain windows. Order columns must order the rows of an entity totally; rows that tie in
all of them are in no defined order there either.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import col
from ..sources.staging import staged
from .panel import Panel

SIZE = 1 << 20  # rows of an entity that one task may hold

#: fold of a running value, and how the value of the segments before (a) and inside the segment (b) become one
FOLDS: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)),
    "count": (F.count, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda a, b: F.coalesce(b, a)),
}
#: fold of the summaries of several segments
UPPER = FOLDS | {"count": (F.sum, FOLDS["count"][1])}


@dataclass(frozen=True)
class Columns:
    """What to add. Values may use the entity's own columns; those of `fixed` may use the ones named before them.

    fixed: window columns of a Panel that look at most `reach` rows back, those they are made of included, and
        at no other rows.
    running: (fold, column) from the entity's first row to the row itself; `last` leaves out missing values.
    whole: (fold, column) over all rows of the entity.
    """

    fixed: Mapping[str, Callable[[Panel], Column]] = field(default_factory=dict)
    running: Mapping[str, tuple[str, Column | str]] = field(default_factory=dict)
    whole: Mapping[str, tuple[str, Column | str]] = field(default_factory=dict)
    reach: int = 0


def with_windows(df: DataFrame, panel: Panel, columns: Columns, size: int = SIZE) -> DataFrame:
    """df with the columns, whatever the size of an entity. One aggregate finds the entities of more than `size` rows."""
    if columns.reach > size:
        raise ValueError(f"segments of {size} rows cannot hold a reach of {columns.reach}")
    names = [*columns.fixed, *columns.running, *columns.whole]
    clash = sorted(set(names) & set(df.columns))
    if clash or len(set(names)) < len(names):
        raise ValueError(f"column names repeat: {clash or names}")
    keys = list(panel.keys)
    large = df.groupBy(*keys).count().where(F.col("count") > size).select(*[F.col(k).alias(f"_large_{k}") for k in keys])
    large = staged(large, "large-entities")
    if large.isEmpty():
        return _plain(df, panel, columns)
    same = _same(keys, "_large_")
    small = _plain(df.join(large, same, "left_anti"), panel, columns)
    cut = _cut(df.join(large, same, "left_semi"), panel, columns, size)
    types = dict(cut.dtypes)
    # sums of sums of decimals are wider than sums
    same_type = [F.col(c) if types[c] == t else F.col(c).cast(t).alias(c) for c, t in small.dtypes]
    return small.unionByName(cut.select(*same_type))


def _same(keys: list[str], prefix: str) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return condition


def _plain(df: DataFrame, panel: Panel, columns: Columns) -> DataFrame:
    """One window for each entity; all columns share one Exchange and one Sort."""
    upto = panel.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumns({n: FOLDS[fold][0](col(c)).over(upto) for n, (fold, c) in columns.running.items()} | {n: FOLDS[fold][0](col(c)).over(panel.whole) for n, (fold, c) in columns.whole.items()})
    return _fixed(out, panel, columns).select(*df.columns, *columns.fixed, *columns.running, *columns.whole)


def _fixed(df: DataFrame, panel: Panel, columns: Columns) -> DataFrame:
    for name, column in columns.fixed.items():
        df = df.withColumn(name, column(panel))
    return df


def positioned(df: DataFrame, panel: Panel) -> DataFrame:
    """df with _at, the place of each row in its entity from 0 on. Written: the places are the same for every later step.

    Rows are spread over ranges of (entity, order). A range knows the rows of an entity in the ranges before it from one count
    per entity and range.
    """
    keys = list(panel.keys)
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col(c).asc_nulls_last() for c in (panel.day, *panel.ties)]
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = staged(ranges.withColumn("_place", F.monotonically_increasing_id()), "segments").withColumn("_range", F.shiftright("_place", 33))
    counts = laid.groupBy(*keys, "_range").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_range").alias("_of_range"), "_first", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    found = laid.join(counts, _same(keys, "_of_") & (F.col("_range") == F.col("_of_range")))
    return found.withColumn("_at", F.col("_ahead") + F.col("_place") - F.col("_first")).select(*df.columns, "_at")


def _cut(df: DataFrame, panel: Panel, columns: Columns, size: int) -> DataFrame:
    """The same for entities that are cut into segments."""
    keys = list(panel.keys)
    placed = positioned(df, panel).withColumn("_segment", F.floor(F.col("_at") / size))
    segment = Panel((*panel.keys, "_segment"), "_at")
    rows = placed.withColumn("_halo", F.lit(False))
    if columns.fixed and columns.reach:
        tail = F.col("_at") % size >= size - columns.reach
        rows = rows.unionByName(rows.where(tail).withColumns({"_segment": F.col("_segment") + 1, "_halo": F.lit(True)}))
    # one Exchange and one Sort by (entity, segment) for all of what follows
    upto = segment.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({n: FOLDS[fold][0](F.when(~F.col("_halo"), col(c))).over(upto) for n, (fold, c) in columns.running.items()})
    rows = _fixed(rows, segment, columns).where("not _halo")
    if not columns.running and not columns.whole:
        return rows
    before = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    entity = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upper = _summaries(placed, panel, columns).select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        F.col("_segment").alias("_of_segment"),
        *[UPPER[fold][0](f"_run_{n}").over(before).alias(f"_run_{n}") for n, (fold, _) in columns.running.items()],
        *[UPPER[fold][0](f"_all_{n}").over(entity).alias(n) for n, (fold, _) in columns.whole.items()],
    )
    both = rows.join(staged(upper, "segment-summaries"), _same(keys, "_of_") & (F.col("_segment") == F.col("_of_segment")))
    return both.withColumns({n: FOLDS[fold][1](F.col(f"_run_{n}"), F.col(n)) for n, (fold, _) in columns.running.items()})


def _summaries(placed: DataFrame, panel: Panel, columns: Columns) -> DataFrame:
    """One row per entity and segment, combined on the map side."""

    def folded(fold: str, c: Column | str) -> Column:
        return F.max_by(col(c), F.when(col(c).isNotNull(), F.col("_at"))) if fold == "last" else FOLDS[fold][0](col(c))

    values = [folded(fold, c).alias(f"_run_{n}") for n, (fold, c) in columns.running.items()]
    values += [folded(fold, c).alias(f"_all_{n}") for n, (fold, c) in columns.whole.items()]
    return placed.groupBy(*panel.keys, "_segment").agg(*values)
