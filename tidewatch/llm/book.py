"""Queries of this subpackage, kept apart from the library's own list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..registry.book import Query, Run

BOOK: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run: Run) -> Run:
        BOOK[name] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
