"""Windows over a panel.

A panel has at most one row per (entity, day). `build_panel` makes one out of
raw rows with a map-side combined aggregate, so an entity that owns a third of
all raw rows still has no more panel rows than the calendar has days. That is
the size bound of every window partition below.

All columns made by one Panel use the same partitioning and order, so they
share one Exchange and one Sort however many are added.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.missing import col, ratio, relative_change


def build_panel(df: DataFrame, keys: dict[str, Column] | list[str], day: Column, day_name: str, **measures: Column) -> DataFrame:
    """Raw rows to one row per (entity, day)."""
    named = keys if isinstance(keys, dict) else {k: F.col(k) for k in keys}
    groups = [c.alias(name) for name, c in named.items()] + [day.cast("date").alias(day_name)]
    return df.groupBy(*groups).agg(*[c.alias(name) for name, c in measures.items()])


def densify(df: DataFrame, keys: list[str], day: str, **fill) -> DataFrame:
    """One row per entity and calendar day, from its first day to its last; new rows hold `fill` and are else missing.

    A repeated (entity, day) keeps its rows; rows without a day stay as they are. An entity's days are
    one row, gathered by a map-side combined aggregate and as long as its calendar at most. The new days are laid out
    from that row, behind the shuffle: no day that is filled in travels.
    """
    on = F.col(day).alias("_on")
    known = df.where(F.col(day).isNotNull()).select(*[F.col(k).alias(f"_key_{k}") for k in keys], on).distinct()
    days = known.groupBy(*[f"_key_{k}" for k in keys]).agg(F.collect_list("_on").alias("_days"))
    span = F.sequence(F.array_min("_days"), F.array_max("_days"))
    missing = days.select(*[f"_key_{k}" for k in keys], F.explode(F.array_except(span, F.col("_days"))).alias("_day"))
    values = {**{k: F.col(f"_key_{k}") for k in keys}, day: F.col("_day"), **{c: F.lit(v) for c, v in fill.items()}}
    new = missing.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(new)


@dataclass(frozen=True)
class Panel:
    """Entity key columns, the day column, and tie-breakers for feeds that repeat a day."""

    keys: tuple[str, ...]
    day: str
    ties: tuple[str, ...] = ()

    @property
    def ordered(self) -> WindowSpec:
        order = [F.col(c).asc_nulls_last() for c in (self.day, *self.ties)]
        return Window.partitionBy(*self.keys).orderBy(*order)

    @property
    def whole(self) -> WindowSpec:
        """All rows of the entity. Ordered like the rest so that it shares their sort."""
        return self.ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def trailing(self, rows: int) -> WindowSpec:
        return self.ordered.rowsBetween(-(rows - 1), Window.currentRow)

    # lags and changes ---------------------------------------------------
    def lag(self, c: Column | str, rows: int = 1) -> Column:
        return F.lag(col(c), rows).over(self.ordered)

    def delta(self, c: Column | str, keep_first: bool = False) -> Column:
        """Counter to daily change. The first row is missing, or the counter itself."""
        change = col(c) - self.lag(c)
        return F.coalesce(change, col(c)) if keep_first else change

    def change(self, c: Column | str, rows: int = 7) -> Column:
        """Relative change against `rows` rows before."""
        return relative_change(c, self.lag(c, rows))

    # rolling ------------------------------------------------------------
    def _full(self, c: Column | str, rows: int) -> Column:
        return F.count(col(c)).over(self.trailing(rows)) >= rows

    def rolling_mean(self, c: Column | str, rows: int = 7, mode: str = "ramp") -> Column:
        """Mean of the last `rows` rows.

        ramp: the first rows average what there is; a missing value in the
        frame makes the mean missing. strict: missing until `rows` values are there.
        """
        mean = F.avg(col(c)).over(self.trailing(rows))
        if mode == "strict":
            return F.when(self._full(c, rows), mean)
        if mode == "ramp":
            w = self.trailing(rows)
            return F.when(F.count(col(c)).over(w) == F.count(F.lit(1)).over(w), mean)
        raise ValueError(f"mode must be ramp or strict, not {mode!r}")

    def rolling_total(self, c: Column | str, rows: int = 7) -> Column:
        return F.when(self._full(c, rows), F.sum(col(c)).over(self.trailing(rows)))

    def rolling_ratio(self, a: Column | str, b: Column | str, rows: int = 7) -> Column:
        return ratio(self.rolling_total(a, rows), self.rolling_total(b, rows))

    # whole-entity values on every row --------------------------------------
    def size(self) -> Column:
        return F.count(F.lit(1)).over(self.whole)

    def max(self, c: Column | str) -> Column:
        return F.max(col(c)).over(self.whole)

    def max_where(self, c: Column | str, condition: Column) -> Column:
        # `condition` must not hold a window itself: windows do not nest, so stage it as a column first
        return F.max(F.when(condition, col(c))).over(self.whole)

    def last_known(self, c: Column | str) -> Column:
        """Fill a gap with the entity's last known value by date."""
        return F.coalesce(col(c), F.last(col(c), ignorenulls=True).over(self.whole))

    # positions --------------------------------------------------------------
    def position(self) -> Column:
        return F.row_number().over(self.ordered)

    def mask_first(self, c: Column | str) -> Column:
        return F.when(self.position() > 1, col(c))


def with_latest(df: DataFrame, panel: Panel, **outputs: str) -> DataFrame:
    """Attach to every row the value each column has on the entity's latest day."""
    dated = df.withColumn("_latest_day", panel.max(panel.day))
    is_newest = F.col(panel.day) == F.col("_latest_day")
    return dated.withColumns({name: panel.max_where(c, is_newest) for name, c in outputs.items()}).drop("_latest_day")


def with_peak(df: DataFrame, panel: Panel, measure: str, peak: str, peak_day: str, decline: str, days_since: str) -> DataFrame:
    """Peak value, last day of the peak, decline from it and days since it.

    An entity without any value has no peak: all four are missing.
    """
    at_peak = F.col(measure) == F.col(peak)
    return (
        df.withColumn(peak, panel.max(measure))
        .withColumn(peak_day, panel.max_where(panel.day, at_peak))
        .withColumn(decline, relative_change(measure, peak))
        .withColumn(days_since, F.date_diff(F.col(panel.day), F.col(peak_day)))
    )


def zero_fill(c: Column | str, day: Column | str, until: Column) -> Column:
    """Missing counts as 0 up to `until`, and stays missing after it."""
    return F.when(col(c).isNull() & (col(day) <= until), F.lit(0)).otherwise(col(c))


def carry_previous(panel: Panel, c: str, listed: Column) -> Column:
    """On listed rows take the previous row's value."""
    return F.when(F.coalesce(listed, F.lit(False)), panel.lag(c)).otherwise(F.col(c))
