"""A published panel whose derived columns follow late revisions.

Every derived column says how many rows back it looks (`rows`) and which derived columns it is made
of; its reach is the sum along that chain. A revised or new row then changes the columns of itself and of
the next `reach` rows of its entity, and of no others. A batch of revisions

1. is merged with the published rows of its periods, and what differs from them is dirty;
2. takes from the summary (rows per entity and period) which periods hold `reach` rows before and behind;
3. reads these periods, for the dirty entities only, and computes the dirty ranges again;
4. writes the periods that changed, rows and summary in one version.

Values of whole entities, such as a peak, are merged from the summary's one row per entity and period when
the panel is read, so a revision of one day does not make an entity's history be read or written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedupe import first_per_key
from ..operators.enrich import lookup
from ..operators.panel import Panel
from ..sources.staging import staged
from ..sources.versions import Manifest, VersionedTable, Versions, name_of
from .log import run_available

MERGED = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.sum}
MADE = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


@dataclass(frozen=True)
class Derived:
    """A window column: its expression over the panel, how many rows back it looks, the derived columns in it."""

    column: Callable[[Panel], Column]
    rows: int
    of: tuple[str, ...] = ()


def reaches(derived: Mapping[str, Derived]) -> dict[str, int]:
    """Rows back that each column depends on, through the columns it is made of. Columns come after their parts."""
    out: dict[str, int] = {}
    for name, d in derived.items():
        out[name] = d.rows + max((out[p] for p in d.of), default=0)
    return out


def held_by(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is in `others`, null equal to null."""
    named = others.select(*[F.col(k).alias(f"_other_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys])
    return rows.join(named, same, "left_semi")


def month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


@dataclass(frozen=True)
class Refreshed:
    """What a batch did: the manifest, and the names of the periods read and written."""

    manifest: Manifest
    read: frozenset[str] = frozenset()
    written: frozenset[str] = frozenset()


@dataclass(frozen=True)
class RefreshedPanel:
    """One row per entity and day: base columns, and derived columns that are kept up to date.

    `order` is a total order of the versions of a (entity, day), best first; it may use all base columns.
    `whole` maps a name to (max, min, sum or count; column): values of whole entities.
    """

    spark: SparkSession
    root: str
    panel: Panel
    base: StructType
    order: Callable[[], Sequence[Column]]
    derived: Mapping[str, Derived]
    whole: Mapping[str, tuple[str, Callable[[], Column]]] = field(default_factory=dict)
    period: Callable[[Column], Column] = month

    @property
    def reach(self) -> int:
        return max(reaches(self.derived).values(), default=0)

    @property
    def keys(self) -> list[str]:
        return list(self.panel.keys)

    @property
    def row_key(self) -> list[str]:
        return [*self.panel.keys, self.panel.day]

    @property
    def versions(self) -> Versions:
        return Versions(self.spark, self.root)

    @cached_property
    def _tables(self) -> tuple[VersionedTable, VersionedTable]:
        empty = self._computed(self.spark.createDataFrame([], self.base).withColumn("_period", self._period()))
        rows = empty.select(*self.base.names, *self.derived, "_period")
        return VersionedTable(self.versions, "rows", rows.schema, "_period"), VersionedTable(self.versions, "summary", self._summed(rows).schema, "_period")

    def _period(self) -> Column:
        return self.period(F.col(self.panel.day)).cast("string")

    def _computed(self, rows: DataFrame) -> DataFrame:
        for name, d in self.derived.items():
            rows = rows.withColumn(name, d.column(self.panel))
        return rows

    def _summed(self, rows: DataFrame) -> DataFrame:
        values = [MADE[fn](column()).alias(name) for name, (fn, column) in self.whole.items()]
        return rows.groupBy(*self.keys, "_period").agg(F.count(F.lit(1)).alias("_rows"), *values)

    # reading --------------------------------------------------------------
    def read(self, manifest: Manifest | None = None) -> DataFrame:
        """Base, derived and whole-entity columns of the current version, or of another."""
        manifest = manifest or self.versions.current()
        rows, summary = self._tables
        found = rows.read(manifest).select(*self.base.names, *self.derived)
        if not self.whole:
            return found
        values = [MERGED[fn](name).alias(name) for name, (fn, _) in self.whole.items()]
        return lookup(found, summary.read(manifest).groupBy(*self.keys).agg(*values), self.keys, unique=True, null_safe=True)

    # refreshing -------------------------------------------------------------
    def apply(self, batch: DataFrame) -> Refreshed:
        """Merges a batch of rows (base columns) and computes again what they reach. Applied twice, a batch changes nothing."""
        manifest = self.versions.current()
        rows, summary = self._tables
        batch = staged(batch.select(*self.base.names).withColumn("_period", self._period()), "refresh-batch")
        touched = {name_of(r[0]) for r in batch.select("_period").distinct().collect()}  # calendar periods
        old = rows.read(manifest, touched)
        versions = batch.unionByName(old.select(*self.base.names, "_period"))
        best = staged(first_per_key(versions, self.row_key, self.order()), "refresh-best")
        # rows that are new, or differ in any base column
        before = old.select(*self.row_key, F.struct(*self.base.names).alias("_before"))
        met = lookup(best, before, self.row_key, unique=True, null_safe=True)
        dirty = staged(met.where(~F.struct(*self.base.names).eqNullSafe(F.col("_before"))).select(*self.row_key, "_period"), "refresh-dirty")
        if dirty.isEmpty():
            return Refreshed(manifest, frozenset(touched))
        near = staged(self._near(dirty, summary.read(manifest)), "refresh-near")
        reached = {name_of(r[0]) for r in near.select("_period").distinct().collect()}
        context = rows.read(manifest, reached - touched).select(*best.columns)
        context = held_by(context.unionByName(best), near, [*self.keys, "_period"])
        fresh = staged(self._recomputed(context, dirty), "refresh-rows")
        changed = touched | {name_of(r[0]) for r in fresh.select("_period").distinct().collect()}
        new = staged(self._replaced(rows, manifest, best, touched, changed, fresh), "refresh-new")
        changes = rows.write(new, manifest) | summary.write(self._summed(new), manifest)
        written = frozenset(name for table, name in changes if table == "rows")
        return Refreshed(self.versions.commit(manifest, changes), frozenset(touched | reached | changed), written)

    def _near(self, dirty: DataFrame, summary: DataFrame) -> DataFrame:
        """(entity, period) pairs that hold the dirty rows, `reach` rows before them or `reach` rows behind them."""
        at = dirty.select(*self.keys, "_period").distinct()
        counts = summary.select(*self.keys, "_period", "_rows").unionByName(at.withColumn("_rows", F.lit(0).cast("long")))
        counts = counts.groupBy(*self.keys, "_period").agg(F.sum("_rows").alias("_rows"))
        counts = counts.withColumn("_upto", F.sum("_rows").over(Window.partitionBy(*self.keys).orderBy("_period")))
        spots = held_by(counts, at, [*self.keys, "_period"])
        named = {c: f"_at_{c}" for c in (*self.keys, "_period", "_rows", "_upto")}
        spots = spots.withColumnsRenamed(named)
        same = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in self.keys]
        between_before = F.col("_at__upto") - F.col("_at__rows") - F.col("_upto")
        between_behind = F.col("_upto") - F.col("_rows") - F.col("_at__upto")
        is_near = F.when(F.col("_period") < F.col("_at__period"), between_before < self.reach).when(F.col("_period") > F.col("_at__period"), between_behind < self.reach).otherwise(True)
        return counts.join(spots, [*same, is_near]).select(*self.keys, "_period").distinct()

    def _recomputed(self, context: DataFrame, dirty: DataFrame) -> DataFrame:
        """Rows of the dirty ranges with all derived columns."""
        marked = lookup(context, dirty.select(*self.row_key).withColumn("_dirty", F.lit(1)), self.row_key, unique=True, null_safe=True)
        marked = marked.withColumn("_reached", F.max("_dirty").over(self.panel.trailing(self.reach + 1)))
        return self._computed(marked).where("_reached = 1").select(*self.row_key, "_period", *self.derived)

    def _replaced(self, rows: VersionedTable, manifest: Manifest, best: DataFrame, touched: set[str], changed: set[str], fresh: DataFrame) -> DataFrame:
        """All rows of the changed periods, with the fresh values where there are any and the old ones elsewhere."""
        others = rows.read(manifest, changed - touched).select(*best.columns, *self.derived)
        old = rows.read(manifest, touched).select(*self.row_key, *self.derived)
        kept = lookup(best, old, self.row_key, unique=True, null_safe=True).select(*others.columns).unionByName(others)
        values = fresh.select(*self.row_key, F.struct(*self.derived).alias("_fresh")) if self.derived else fresh.select(*self.row_key, F.struct(F.lit(1)).alias("_fresh"))
        both = lookup(kept, values, self.row_key, unique=True, null_safe=True)
        return both.select(*self.base.names, *[F.when(F.col("_fresh").isNotNull(), F.col(f"_fresh.{c}")).otherwise(F.col(c)).alias(c) for c in self.derived], "_period")

    def stream(self, source: DataFrame, checkpoint: str) -> DataFrame:
        """Everything that has landed, batch by batch; returns the panel. A batch that runs again changes nothing."""
        run_available(source, lambda rows, _: self.apply(rows), checkpoint)
        return self.read()
