"""Writers. Rows are written by all tasks; nothing is gathered into one file."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import Conflict, Part, Versions

EXTRACT = ("extract", "rows")


def write_extract(df: DataFrame, path: str, null_text: str = "") -> None:
    """Flat CSV extract with a header in every part file. Missing text is `null_text`, empty text is quoted."""
    df.write.mode("overwrite").options(header=True, nullValue=null_text, emptyValue='""', dateFormat="yyyy-MM-dd").csv(path)


def write_table(df: DataFrame, path: str, day: str) -> None:
    """Parquet partitioned by year, so later runs read only the years they need.

    The rebalance hint brings a year's rows together for few files, and splits a
    year that is larger than one task should write.
    """
    years = df.withColumn("year_part", F.year(day))
    years.hint("rebalance", "year_part").write.mode("overwrite").partitionBy("year_part").parquet(path)


def publish_version(df: DataFrame, root: str, write) -> str:
    """Write a new version beside the old ones and only then name it the current one.

    `write(df, folder)` writes the rows. A run that fails half way leaves the version before it in place;
    of two runs the one that ends later is current, by number and not by clock. Returns the new folder.
    """
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    write(df, folder)
    versions = Versions(df.sparkSession, root)
    while True:
        try:
            versions.commit(versions.current(), {EXTRACT: Part(f"versions/{version}", 0, version)})
            return folder
        except Conflict:  # another run ended meanwhile; this one ends after it
            continue


def current_version(spark: SparkSession, root: str) -> str:
    """Folder of the version that was completed last."""
    return f"{root}/{Versions(spark, root).current().parts[EXTRACT].folder}"
