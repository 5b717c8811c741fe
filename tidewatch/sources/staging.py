"""Written intermediate tables, for results that several later steps read."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Only a local session may do without: it gets a scratch folder. On a cluster
    a machine-local folder would be lost with its machine, so that is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):  # an unknown master counts as a cluster
        raise RuntimeError("set spark.checkpoint.dir to a folder all machines share")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    """One folder for all local sessions of this process."""
    return tempfile.mkdtemp(prefix="tidewatch-")


_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later steps start from files: each reads only its own columns, the raw
    tables are scanned once, and a lost executor costs no recomputation. The files stay, unless the
    work is done inside staging().
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"
    mine = _written.get()
    if mine is not None:
        mine.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end, also when the work fails. Results have to be written by then."""
    mine: list[str] = []
    token = _written.set(mine)
    try:
        yield
    finally:
        _written.reset(token)
        for path in mine:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
