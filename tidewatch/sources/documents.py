"""JSON readers that take each file whole: one file is one task. For large documents see json_chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ddl


def read_records(spark: SparkSession, path: str | list[str], columns: dict[str, str]) -> DataFrame:
    """Flat array of records."""
    return spark.read.schema(ddl(columns)).json(path, multiLine=True)


def read_nested_records(spark: SparkSession, path: str | list[str], field: str, columns: dict[str, str]) -> DataFrame:
    """The array of records held in one field of each document."""
    inner = ", ".join(f"`{c}`: {t}" for c, t in columns.items())
    return spark.read.schema(f"`{field}` array<struct<{inner}>>").json(path, multiLine=True).selectExpr(f"inline(`{field}`)")
