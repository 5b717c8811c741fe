"""Counter to daily change as a stream with state: rows may come in any order and any number of batches.

The state of an entity are its rows of the last `keep_days` days before its newest, and the newest row
older than these. A row that arrives takes its place among them, and its change and that of the row behind it
are given out (again). What is older than the row that was kept last has gone from the state: a row that comes
later than that is given out as late and without a change, so that none is lost and whoever reads the
stream can have its entity computed anew.

The last change given out for an (entity, day) is the one that counts. For rows within `keep_days` these are the
changes that one batch of all rows would have, however they were divided.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, DateType, LongType, StructField, StructType

from ..operators.dedupe import first_per_key
from .log import BatchLog, run_id

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def changes_schema(source: DataFrame, keys: Sequence[str], day: str, total: str, change: str) -> StructType:
    held = [source.schema[k] for k in keys]
    return StructType([*held, StructField(day, DateType()), StructField(total, LongType()), StructField(change, LongType()), StructField("late", BooleanType())])


def counter_changes(source: DataFrame, keys: Sequence[str], day: str, total: str, change: str, keep_days: int = 60, keep_first: bool = False) -> DataFrame:
    """Stream of (keys, day, total, change, late), given out whenever a change is new or another.

    Of rows of one day the greatest total counts. An entity's first row has no change, or its total with
    `keep_first`. A row without a day has no place and is late.
    """
    schema = changes_schema(source, keys, day, total, change)
    rows = source.select(*keys, F.col(day).cast("date").alias(day), F.col(total).cast("long").alias(total))
    return rows.groupBy(*keys).transformWithState(_processor(list(keys), day, total, schema.names, keep_days, keep_first), schema, "Update", "None")


def _processor(keys: list[str], day: str, total: str, names: list[str], keep_days: int, keep_first: bool) -> StatefulProcessor:
    # defined here, so that workers get the class itself and need not find this module
    from datetime import timedelta

    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor as Base

    class Changes(Base):
        def init(self, handle) -> None:
            # days in order with their totals; whether older ones have gone
            self.state = handle.getValueState("days", "days array<struct<d: date, x: bigint>>, closed boolean")

        def handleInputRows(self, key, rows, timerValues):
            held, closed = self.state.get() if self.state.exists() else ([], False)
            known = {d: x for d, x in held}
            oldest = held[0][0] if closed else None
            late, changed = [], set()
            for r in rows:
                d, x = r[day], r[total]
                if d is None or (oldest is not None and (d < oldest or (d == oldest and x != known[d]))):
                    late.append((d, x))
                elif d not in known or (x is not None and (known[d] is None or x > known[d])):
                    known[d] = x
                    changed.add(d)
            days = sorted(known)
            made = dict(zip(names, [*key, None, None, None, False]))
            before = None
            for k, d in enumerate(days):
                if d in changed or (k and days[k - 1] in changed):
                    x = known[d]
                    first = k == 0 or before is None
                    change = (x if keep_first else None) if first or x is None else x - before
                    yield Row(**(made | {day: d, total: x, names[-2]: change}))
                before = known[d]
            for d, x in late:
                yield Row(**(made | {day: d, total: x, "late": True}))
            edge = days[-1] - timedelta(days=keep_days) if days else None
            gone = sum(d < edge for d in days) - 1  # the newest of the old ones stays
            if gone > 0:
                days, closed = days[gone:], True
            self.state.update(([(d, known[d]) for d in days], closed))

        def close(self) -> None:
            pass

    return Changes()


@contextmanager
def _keyed_state(spark: SparkSession):
    """State by key needs the RocksDB store; the session's own choice comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def run_counter_changes(source: DataFrame, log: BatchLog, checkpoint: str, keys: Sequence[str], day: str, total: str, change: str, **options) -> DataFrame:
    """Takes in everything that has landed and returns the last change of every (entity, day), and late rows each.

    What is given out is logged by run and batch. A run whose progress was lost begins anew from its source, so
    only the rows of the run that owns the checkpoint count.
    """
    spark = log.spark
    stream = counter_changes(source, keys, day, total, change, **options)
    with _keyed_state(spark):
        query = (
            stream.writeStream.outputMode("update")
            .foreachBatch(lambda rows, batch: log.append(rows, run_id(spark, checkpoint), batch))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    mine = log.read().where(F.col("run") == run_id(spark, checkpoint))
    placed = first_per_key(mine.where("not late"), [*keys, day], [F.col("batch").desc()])
    return placed.unionByName(mine.where("late")).drop("run", "batch")
