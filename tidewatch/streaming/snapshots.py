"""Snapshot history: every run's totals are kept, exact repeats count once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.panel import Panel
from .log import BatchLog, run_available, run_id


def accumulate(history: DataFrame, today: DataFrame) -> DataFrame:
    """Batch form: history and today's snapshot, without exact repeats."""
    return history.unionByName(today).distinct()


def snapshot_changes(history: DataFrame, keys: tuple[str, ...], day: str, totals: dict[str, str]) -> DataFrame:
    """New since the snapshot before; `totals` maps each total to the name of its change."""
    panel = Panel(keys, day, ties=tuple(totals))
    return history.withColumns({new: panel.delta(total) for total, new in totals.items()})


def accumulate_stream(source: DataFrame, log: BatchLog, checkpoint: str) -> DataFrame:
    """Stream form: each micro-batch adds its snapshots to the log. Returns the history."""
    run_available(source, lambda rows, batch: log.append(rows.distinct(), run_id(log.spark, checkpoint), batch), checkpoint)
    return log.read().drop("run", "batch").distinct()


def last_snapshot(history: DataFrame, keys: tuple[str, ...], day: str) -> DataFrame:
    """Newest snapshot per entity, as one map-side combined aggregate."""
    rest = [c for c in history.columns if c not in keys]
    newest = F.max(F.struct(day, *[c for c in rest if c != day])).alias("_s")
    return history.groupBy(*keys).agg(newest).select(*keys, "_s.*")
