"""Filters that need more than the row itself."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .panel import Panel


def latest_of(df: DataFrame, day: str) -> Column:
    """Latest day of a table as one value.

    A scalar subquery: a one-column scan with partial maxima, run once, whose
    value can then be pushed into the scans that compare with it. No join and
    no single-partition window.
    """
    return df.agg(F.max(day)).scalar()


def drop_latest(df: DataFrame, day: str, latest: Column | None = None) -> DataFrame:
    return df.where(F.col(day) != (latest_of(df, day) if latest is None else latest))


def since_latest(df: DataFrame, day: str, days: int, latest: Column | None = None) -> DataFrame:
    """Rows from `days` days before the latest day on."""
    return df.where(F.col(day) >= F.date_sub(latest_of(df, day) if latest is None else latest, days))


def min_history(df: DataFrame, panel: Panel, rows: int = 8, name: str = "n_dates") -> DataFrame:
    """Keep entities with at least `rows` rows; their size stays in `name`."""
    return df.withColumn(name, panel.size()).where(F.col(name) >= rows)


def covered_days(df: DataFrame, day: str, entities: int = 5, name: str = "n_states") -> DataFrame:
    """Days on which at least `entities` rows report, and how many do."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) >= entities)


def min_coverage(df: DataFrame, day: str, entities: int = 5, name: str = "n_states", days: DataFrame | None = None) -> DataFrame:
    """Keep days on which at least `entities` rows report; their number stays in `name`.

    The counts are a map-side combined aggregate with one row per calendar day,
    which bounds what is broadcast. A window per day would instead move every
    entity of a day into one task.
    """
    return df.join(F.broadcast(covered_days(df, day, entities, name) if days is None else days), day, "inner")


def only_entities(df: DataFrame, key: str, entities: Iterable[str] | None) -> DataFrame:
    """Keep the named entities; None keeps all. Pushed below windows on the same key and into the scan."""
    return df if entities is None else df.where(F.col(key).isin(*entities))


def not_zero(df: DataFrame, c: str) -> DataFrame:
    """Drop zeros, and with them missing values."""
    return df.where(F.col(c) != 0)
