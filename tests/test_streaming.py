"""Streams end in the batch result, also when a batch is run twice."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewatch.sources.versions import name_of
from tidewatch.streaming.log import BatchLog, landed
from tidewatch.streaming.revisions import merge_revisions, merge_stream, revision_table
from tidewatch.streaming.snapshots import accumulate, accumulate_stream, last_snapshot, snapshot_changes

KEYS = ["k", "d"]


def order():
    return [F.col("source_rank").asc(), F.col("version").desc()]


@pytest.fixture
def revisions(frame):
    rows = [("a", f"2021-01-{d:02d}", rank, v, float(100 * rank + 10 * v + d)) for d in range(1, 6) for rank, v in ((0, 0), (1, 1), (1, 2)) if (d + rank + v) % 3]
    return frame(rows, "k string, d date, source_rank int, version int, x double")


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_revisions_stream_equals_batch_and_reruns_change_nothing(spark, tmp_path, revisions):
    for i, part in enumerate(revisions.randomSplit([1.0, 1.0, 1.0], seed=3)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = lambda: landed(spark, str(tmp_path / "in"), revisions.schema, 1)
    args = (str(tmp_path / "out"), str(tmp_path / "progress"), "d", KEYS, order())
    want = rows_of(merge_revisions(revisions, KEYS, order()))
    assert rows_of(merge_stream(spark, source(), revisions.schema, *args)) == want
    # nothing new has landed
    assert rows_of(merge_stream(spark, source(), revisions.schema, *args)) == want
    # all progress is lost and everything is run again, in other batches
    lost = (str(tmp_path / "out"), str(tmp_path / "progress2"), "d", KEYS, order())
    again = merge_stream(spark, landed(spark, str(tmp_path / "in"), revisions.schema, 2), revisions.schema, *lost)
    assert rows_of(again) == want


def test_a_late_revision_rewrites_only_its_days(spark, tmp_path, frame):
    schema = "k string, d date, source_rank int, version int, x double"
    first = frame([("a", "2021-01-01", 1, 0, 1.0), ("a", "2021-01-02", 1, 0, 2.0)], schema)
    late = frame([("a", "2021-01-02", 0, 0, 9.0)], schema)
    args = (str(tmp_path / "out"), str(tmp_path / "progress"), "d", KEYS, order())
    source = lambda: landed(spark, str(tmp_path / "in"), first.schema)
    first.write.parquet(str(tmp_path / "in"))
    merge_stream(spark, source(), first.schema, *args)
    table = revision_table(spark, str(tmp_path / "out"), first.schema, "d")
    kept = table.versions.current()
    reader = table.read()
    late.write.mode("append").parquet(str(tmp_path / "in"))
    got = merge_stream(spark, source(), first.schema, *args)
    assert {(str(r["d"]), r["x"]) for r in got.collect()} == {("2021-01-01", 1.0), ("2021-01-02", 9.0)}
    now = table.versions.current()
    assert {n for n, p in now.of("revisions").items() if p != kept.of("revisions")[n]} == {name_of("2021-01-02")}
    assert sorted(r["x"] for r in reader.collect()) == [1.0, 2.0]  # planned before: all days as they were


def test_snapshots_pile_up_beyond_one_run(spark, tmp_path, frame):
    schema = "k string, d date, total long"
    runs = [frame([("a", f"2021-01-0{i}", 10 * i), ("b", f"2021-01-0{i}", i)], schema) for i in (1, 2, 3)]
    log = BatchLog(spark, str(tmp_path / "log"), runs[0].schema, day="d")
    for run in [*runs, runs[2]]:
        run.write.mode("append").parquet(str(tmp_path / "in"))
        history = accumulate_stream(landed(spark, str(tmp_path / "in"), run.schema), log, str(tmp_path / "progress"))
    batch = accumulate(runs[0].unionByName(runs[1]), runs[2].unionByName(runs[2]))
    assert rows_of(history) == rows_of(batch)
    changes = snapshot_changes(history, ("k",), "d", {"total": "new"}).where("k = 'a'").orderBy("d").collect()
    assert [r["new"] for r in changes] == [None, 10, 10]
    assert {(r["k"], r["total"]) for r in last_snapshot(history, ("k",), "d").collect()} == {("a", 30), ("b", 3)}


def test_lost_progress_and_new_files_lose_no_history(spark, tmp_path, frame):
    schema = "k string, d date, total long"
    first, second = (frame([("a", f"2021-01-0{i}", 10 * i)], schema) for i in (1, 2))
    log = BatchLog(spark, str(tmp_path / "log"), first.schema, day="d")
    first.write.parquet(str(tmp_path / "in1"))
    accumulate_stream(landed(spark, str(tmp_path / "in1"), first.schema), log, str(tmp_path / "progress1"))
    second.write.parquet(str(tmp_path / "in2"))
    history = accumulate_stream(landed(spark, str(tmp_path / "in2"), first.schema), log, str(tmp_path / "progress2"))
    assert rows_of(history) == rows_of(first.union(second))
    assert log.read().select("run").distinct().count() == 2


def test_after_many_batches_a_read_opens_few_parts(spark, tmp_path, frame):
    log = BatchLog(spark, str(tmp_path / "log"), frame([("a", "2021-01-01", 1)], "k string, d date, total long").schema, day="d", tier=3)
    every = []
    for batch in range(14):
        rows = [("a", f"2021-01-{batch + 1:02d}", batch), ("b", "2021-01-01", batch)]
        every += rows
        log.append(frame(rows, "k string, d date, total long").coalesce(1), "run", batch)
        if batch == 4:
            reader, then = log.read(), rows_of(log.read())
    parts = log.versions.current().of("log")
    assert len(parts) <= 2 * 3 and len(log.read().inputFiles()) <= 12
    assert sorted((r["k"], str(r["d"]), r["total"]) for r in log.read().collect()) == sorted(every)
    assert log.read().select("batch").distinct().count() == 14
    # a reader from before the parts were merged; a merged batch that is run again; then only what is named stays
    assert rows_of(reader) == then
    log.append(frame([("a", "2021-01-03", 2), ("b", "2021-01-01", 2)], "k string, d date, total long"), "run", 2)
    assert log.versions.current().of("log") == parts
    log.versions.vacuum(keep=1, older_than_hours=0)
    assert log.read().count() == len(every)


def test_a_batch_that_runs_again_replaces_its_own_rows(spark, tmp_path, frame):
    schema = "k string, d date, total long"
    log = BatchLog(spark, str(tmp_path / "log"), frame([("a", "2021-01-01", 1)], schema).schema, day="d")
    assert log.read().count() == 0
    for _ in range(2):
        log.append(frame([("a", "2021-01-01", 1)], schema), "run", 0)
    log.append(frame([("a", "2021-01-01", 1)], schema), "other run", 0)
    assert sorted((r["run"], r["batch"]) for r in log.read().collect()) == [("other run", 0), ("run", 0)]
