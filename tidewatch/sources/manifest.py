"""Manifest scan: a table of links, newest first, read and put together by name."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import US, date_head
from .delimited import read_mixed

NEWEST_ARCHIVES = 14


def newest(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows in a given order (a distributed top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def newest_links(manifest: DataFrame, n: int = NEWEST_ARCHIVES) -> list[str]:
    """Links of the n newest entries; n bounds what reaches the driver."""
    dated = manifest.withColumn("date", date_head("update_date", US))
    rows = newest(dated, n, F.col("date").desc_nulls_last(), F.col("archive_link").desc()).select("archive_link").collect()
    return [r["archive_link"] for r in rows]


def placed(link: str, base: str | None) -> str:
    """A link as it is when it names its own place, else below `base`."""
    return link if base is None or re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://|/", link) else f"{base.rstrip('/')}/{link}"


def read_manifest(
    spark: SparkSession, manifest: DataFrame, columns: dict[str, str], prefixes: tuple[str, ...] = (), base: str | None = None, n: int = NEWEST_ARCHIVES
) -> DataFrame:
    """The n newest archives, files or folders of files, as one table.

    Archives with the same header share one scan. `source_rank`, by the file's path, is 0 for the newest. A
    column that only some archives have is missing in the others.
    """
    links = newest_links(manifest, n)
    if not links:
        raise ValueError("the manifest lists no archive")
    paths = [placed(link, base) for link in links]
    rows = read_mixed(spark, paths, columns, prefixes, file="_file")
    # a path in the files' own spelling ends with the archive's; the longest such archive is meant
    rank = F.lit(None).cast("int")
    for k, path in sorted(enumerate(paths), key=lambda x: len(x[1])):
        own = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/", path).rstrip("/")
        inside = F.concat(F.regexp_replace(F.url_decode("_file"), "^[a-zA-Z][a-zA-Z0-9+.-]*:/*", "/"), F.lit("/")).contains(own + "/")
        rank = F.when(inside, F.lit(k)).otherwise(rank)
    return rows.withColumn("source_rank", rank).drop("_file")
