"""Checks printed beside the panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import sum_or_zero
from ..operators.dedupe import union_by_name
from ..operators.filters import latest_of, since_latest
from ..operators.quality import freshness, key_uniqueness


def last_week(df: DataFrame, day: str, measure: str, latest: Column | None = None, change: str = "change") -> DataFrame:
    """Total per day over the last week and its change from day to day.

    The window runs over one row per day of eight days at most.
    """
    latest = latest_of(df, day) if latest is None else latest
    recent = since_latest(df, day, 7, latest).withColumn("_as_of", latest)
    daily = recent.groupBy("_as_of", day).agg(sum_or_zero(measure).alias(measure))
    w = Window.partitionBy("_as_of").orderBy(day)
    return daily.withColumn(change, F.col(measure) - F.lag(measure).over(w)).drop("_as_of")


def uniqueness(checks: dict[str, tuple[DataFrame, list[str] | None]]) -> DataFrame:
    return union_by_name([key_uniqueness(df, keys, name) for name, (df, keys) in checks.items()])


def federal_freshness(panel: DataFrame, hospital: DataFrame) -> DataFrame:
    return freshness(
        {
            "hospital": (hospital, "date", "currently_hospitalized"),
            "cases": (panel, "date", "new_case"),
            "tests": (panel, "date", "new_tests"),
        }
    )
