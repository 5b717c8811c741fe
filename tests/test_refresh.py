"""Derived columns follow revisions: whatever the batches, the panel equals one computed anew."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.operators.dedupe import first_per_key
from tidewatch.operators.panel import Panel
from tidewatch.sources.versions import name_of
from tidewatch.streaming.log import landed
from tidewatch.streaming.refresh import Derived, RefreshedPanel, reaches

PANEL = Panel(("k", "place"), "d")
BASE = StructType().add("k", "string").add("place", "string").add("d", "date").add("x", "long").add("version", "integer")
DERIVED = {
    "avg3": Derived(lambda p: F.round(p.rolling_mean("x", 3), 6), 2),
    "change": Derived(lambda p: p.delta("x"), 1),
    "avg3_before": Derived(lambda p: p.lag("avg3", 2), 2, of=("avg3",)),
    "strict4": Derived(lambda p: F.round(p.rolling_mean("avg3_before", 4, "strict"), 6), 3, of=("avg3_before",)),
}


def order():
    return [F.col("version").desc(), F.col("x").asc_nulls_last()]


@pytest.fixture
def panel(spark, tmp_path):
    whole = {"peak": ("max", lambda: F.col("x")), "total": ("sum", lambda: F.col("x")), "days": ("count", lambda: F.col("x"))}
    return RefreshedPanel(spark, str(tmp_path / "p"), PANEL, BASE, order, DERIVED, whole, period=lambda d: F.date_trunc("week", d).cast("date"))


def anew(spark, rows):
    best = first_per_key(spark.createDataFrame(rows, BASE), ["k", "place", "d"], order())
    for name, d in DERIVED.items():
        best = best.withColumn(name, d.column(PANEL))
    return best.withColumns({"peak": PANEL.max("x"), "total": F.sum("x").over(PANEL.whole), "days": F.count("x").over(PANEL.whole)})


def rows_of(df):
    return sorted(map(str, df.collect()))


def day(n):
    return dt.date(2021, 1, 1) + dt.timedelta(days=n)


def test_reach_adds_up_along_the_chain():
    assert reaches(DERIVED) == {"avg3": 2, "change": 1, "avg3_before": 4, "strict4": 7}


@pytest.mark.parametrize("seed", [1])
def test_any_batches_equal_a_new_computation(spark, panel, seed):
    rng = random.Random(seed)
    every = []
    for version in range(5):
        span = (0, 60) if version in (0, 3) else sorted(rng.sample(range(70), 2))
        batch = [
            (k, place, day(n) if rng.random() > 0.02 else None, rng.choice([None, *range(9)]), version if rng.random() > 0.2 else 0)
            for k in ("a", "b", None) for place in ("x", None) for n in range(*span) if rng.random() < (0.6 if version == 0 else 0.15)
        ]
        every += batch
        panel.apply(spark.createDataFrame(batch, BASE))
        assert rows_of(panel.read()) == rows_of(anew(spark, every)), version


def test_one_revision_reads_and_writes_what_it_reaches(spark, panel):
    rows = [(k, "x", day(n), n, 0) for k in "ab" for n in range(140)]
    panel.apply(spark.createDataFrame(rows, BASE))
    late = [("a", "x", day(70), 500, 1)]
    done = panel.apply(spark.createDataFrame(late, BASE))
    weeks = lambda *ns: {name_of(day(n) - dt.timedelta(days=day(n).weekday())) for n in ns}
    assert weeks(70, 77) <= set(done.written) <= weeks(70, 77) and set(done.read) <= weeks(63, 70, 77, 84)
    assert rows_of(panel.read()) == rows_of(anew(spark, rows + late))
    fresh = panel.read().where("k = 'a' and peak = 500").count()
    assert fresh == 140  # the peak of the whole entity, merged when read


def test_the_same_batch_again_changes_nothing(spark, panel):
    batch = spark.createDataFrame([("a", "x", day(n), n, 0) for n in range(20)], BASE)
    first = panel.apply(batch).manifest
    assert panel.apply(batch).manifest == first == panel.versions.current()
    assert panel.apply(batch.limit(0)).manifest == first


def test_a_reader_between_two_batches_keeps_its_version(spark, panel):
    panel.apply(spark.createDataFrame([("a", "x", day(n), n, 0) for n in range(20)], BASE))
    reader = panel.read()
    before = rows_of(panel.read())
    panel.apply(spark.createDataFrame([("a", "x", day(3), 99, 1)], BASE))
    assert rows_of(reader) == before != rows_of(panel.read())


def test_as_a_stream(spark, panel, tmp_path):
    rng = random.Random(7)
    every = [("a", "x", day(rng.randrange(40)), rng.randrange(9), v) for v in range(60)]
    for lo in range(0, 60, 20):
        spark.createDataFrame(every[lo : lo + 20], BASE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = panel.stream(landed(spark, str(tmp_path / "in"), BASE, 1), str(tmp_path / "progress"))
    assert rows_of(out) == rows_of(anew(spark, every))
    lost = panel.stream(landed(spark, str(tmp_path / "in"), BASE, 2), str(tmp_path / "progress2"))
    assert rows_of(lost) == rows_of(anew(spark, every))
