"""An append-only table of micro-batches that stays small.

A run is one checkpoint: Spark keeps its id there. A micro-batch that is run again after a failure replaces
its own rows; a run whose progress was lost starts as another run, beside the old one, so nothing
that was logged is ever overwritten.

Each batch is a part of a versioned folder. Whenever `tier` parts of one level have come together they are
written as one part of the next level and replaced by it in a new version: every row is copied once a
level, and after n batches a read opens less than `tier` parts for each of log(n) levels. Readers that were planned
before go on with the parts they know; vacuum() removes these later.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..sources.versions import Key, Manifest, Part, Versions

LOG = "log"
MARKS = StructType([StructField("run", StringType()), StructField("batch", LongType())])


@dataclass(frozen=True)
class BatchLog:
    spark: SparkSession
    folder: str
    schema: StructType
    day: str
    tier: int = 8

    @property
    def versions(self) -> Versions:
        return Versions(self.spark, self.folder)

    def append(self, rows: DataFrame, run: str, batch: int) -> None:
        base = self.versions.current()
        if batch <= int(base.notes.get(run, -1)):
            return  # run again after its part was merged: the same rows are there
        marked = rows.withColumns({"run": F.lit(run), "batch": F.lit(batch).cast("long")})
        self.versions.commit(base, {_part_of(0, f"{run}/{batch}"): self._written(marked)})
        self.compact()

    def compact(self) -> None:
        """Merges the parts of each level that has `tier` of them."""
        base, level = self.versions.current(), 0
        while True:
            held = _levels(base).get(level, {})
            if not held:
                return
            if len(held) >= self.tier:
                merged = self._written(self._read([p.folder for p in held.values()]))
                last: dict[str, int] = {}
                for run, _, batch in (key[1].split(":", 1)[1].rpartition("/") for key in held if level == 0):
                    last[run] = max(int(batch), last.get(run, -1))
                changes = {key: None for key in held} | {_part_of(level + 1, uuid.uuid4().hex): merged}
                base = self.versions.commit(base, changes, {run: str(n) for run, n in last.items()})
            level += 1

    def read(self) -> DataFrame:
        return self._read([p.folder for p in self.versions.current().of(LOG).values()])

    def _written(self, marked: DataFrame) -> Part:
        folder = f"data/{uuid.uuid4().hex}/rows"
        # by day within a file, so that the files' statistics let a read of some days skip blocks
        marked.hint("rebalance").sortWithinPartitions(self.day).write.parquet(f"{self.folder}/{folder}")
        return Part(folder, 0, "")

    def _read(self, folders: list[str]) -> DataFrame:
        stored = StructType([*self.schema.fields, *MARKS.fields])
        if not folders:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(*[f"{self.folder}/{f}" for f in sorted(folders)])


def _part_of(level: int, name: str) -> Key:
    return LOG, f"{level}:{name}"


def _levels(manifest: Manifest) -> dict[int, dict[Key, Part]]:
    out: dict[int, dict[Key, Part]] = {}
    for name, part in manifest.of(LOG).items():
        out.setdefault(int(name.split(":", 1)[0]), {})[LOG, name] = part
    return out


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave to the query that owns a checkpoint; a new checkpoint has a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def run_available(source: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Everything that has landed, then stop. Progress is kept in `checkpoint`."""
    query = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def landed(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 8) -> DataFrame:
    """Parquet files of a folder as a stream, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
