"""Late revisions: the most trusted version of every (entity, day), published day by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.dedupe import first_per_key
from ..sources.staging import staged
from ..sources.versions import Manifest, VersionedTable, Versions, name_of
from .log import run_available


def merge_revisions(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Batch form: one row per key, by source rank and whatever order follows it."""
    return first_per_key(rows, keys, order)


def revision_table(spark: SparkSession, folder: str, schema: StructType, day: str) -> VersionedTable:
    """The published versions, one partition a day."""
    return VersionedTable(Versions(spark, folder), "revisions", schema, day)


def publish_touched(rows: DataFrame, table: VersionedTable, keys: Sequence[str], order: Sequence[Column]) -> Manifest:
    """Merge rows with the published rows of their days, and publish the days that change as one version.

    `order` must be a total order of the versions of a key: the best of the best so far and the
    new rows is then the best of all. Other days are neither read nor rewritten, and a reader sees all
    days as they were or all as they are.
    """
    base = table.versions.current()
    days = {name_of(r[0]) for r in rows.select(table.part).distinct().collect()}  # bounded by calendar days
    best = staged(merge_revisions(rows.unionByName(table.read(base, days)), keys, order), "revisions")
    return table.publish(best, base)


def merge_stream(
    spark: SparkSession, source: DataFrame, schema: StructType, published: str, checkpoint: str, day: str, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Stream form. A batch that is run again, or all of them after lost progress, merges into the same table."""
    table = revision_table(spark, published, schema, day)
    # the batch is read twice: for its days and for its rows
    run_available(source, lambda rows, _: publish_touched(staged(rows, "batch"), table, keys, order), checkpoint)
    return table.read()
