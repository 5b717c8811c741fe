"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


BOOK: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        BOOK[name] = Query(run, sql)
        return run

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so that both engines print the same."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, places) for c in doubles}) if doubles else df
