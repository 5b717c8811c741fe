"""Counter changes as a stream: any division into batches gives the changes of one batch."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.panel import Panel
from tidewatch.streaming.counters import changes_schema, run_counter_changes
from tidewatch.streaming.log import BatchLog, landed

SCHEMA = "k string, g int, d date, total long"
START = dt.date(2021, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


@pytest.fixture
def stream(spark, tmp_path):
    def run(batches, **options):
        for k, rows in enumerate(batches):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        empty = spark.createDataFrame([], SCHEMA)
        source = landed(spark, str(tmp_path / "in"), empty.schema, 1)
        log = BatchLog(spark, str(tmp_path / "log"), changes_schema(empty, ["k", "g"], "d", "total", "change"), day="d", tier=3)
        return run_counter_changes(source, log, str(tmp_path / options.pop("progress", "progress")), ["k", "g"], "d", "total", "change", **options)

    return run


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def batch_form(spark, rows, keep_first=False):
    best = spark.createDataFrame(rows, SCHEMA).groupBy("k", "g", "d").agg(F.max("total").alias("total"))
    return best.withColumn("change", Panel(("k", "g"), "d").delta("total", keep_first)).withColumn("late", F.lit(False))


@pytest.mark.parametrize("seed,keep_first", [(1, False), (2, True)])
def test_any_batches_equal_the_batch_form(spark, stream, seed, keep_first):
    rng = random.Random(seed)
    rows = [(k, g, day(n), rng.choice([None, 10 * n, 10 * n + rng.randrange(5)])) for k in ("a", "b", None) for g in (1, None) for n in range(30) if rng.random() < 0.6]
    rows += rng.sample(rows, 10)
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(len(rows)), 3))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    assert rows_of(stream(batches, keep_days=40, keep_first=keep_first)) == rows_of(batch_form(spark, rows, keep_first))


def test_a_long_series_within_a_short_state(spark, stream):
    rows = [("a", 1, day(n), n * n) for n in range(100)]
    held_back = {39, 38, 71}
    batches = [[r for n, r in enumerate(rows) if lo <= n < lo + 40 and n not in held_back or (lo and lo - 40 <= n < lo and n in held_back)] for lo in (0, 40, 80)]
    assert sorted(map(len, batches)) == [21, 38, 41]
    assert rows_of(stream(batches, keep_days=10)) == rows_of(batch_form(spark, rows))


def test_rows_behind_the_state_are_given_out_as_late(spark, stream):
    first = [("a", 1, day(n), n) for n in range(40)]
    late = [("a", 1, day(3), 99), ("a", 1, None, 5), ("a", 1, day(28), 28), ("b", 1, day(3), 1)]
    out = stream([first, late], keep_days=10)
    assert sorted((r["k"], str(r["d"]), r["total"]) for r in out.where("late").collect()) == [("a", "2021-01-04", 99), ("a", "None", 5)]
    want = rows_of(batch_form(spark, [*first, ("b", 1, day(3), 1)]))
    assert rows_of(out.where("not late")) == want


def test_a_run_goes_on_from_its_checkpoint_and_lost_progress_begins_anew(spark, stream):
    a, b = [("a", 1, day(n), n) for n in range(0, 10, 2)], [("a", 1, day(n), n) for n in range(1, 10, 2)]
    assert rows_of(stream([a])) == rows_of(batch_form(spark, a))
    assert rows_of(stream([])) == rows_of(batch_form(spark, a))
    assert rows_of(stream([b])) == rows_of(batch_form(spark, a + b))
    assert rows_of(stream([], progress="another")) == rows_of(batch_form(spark, a + b))
