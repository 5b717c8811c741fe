"""Entities that are cut into segments have the windows of plain ones; as-of joins have the rows of the definition."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.asof import asof_join
from tidewatch.operators.panel import Panel
from tidewatch.operators.segments import Columns, _plain, positioned, with_windows

PANEL = Panel(("k", "g"), "t", ties=("i",))
SCHEMA = "k string, g int, t int, i int, x long"
COLUMNS = Columns(
    fixed={"prev": lambda p: p.lag("x"), "diff": lambda p: p.delta("x", keep_first=True), "ramp": lambda p: F.round(p.rolling_mean("x", 4), 6), "strict": lambda p: F.round(p.rolling_mean("x", 3, "strict"), 6), "ramp_2": lambda p: p.lag("ramp", 2)},
    running={"total": ("sum", "x"), "n": ("count", "x"), "top": ("max", "x"), "low": ("min", "x"), "seen": ("last", "x")},
    whole={"peak": ("max", "x"), "size": ("count", "i"), "all": ("sum", "x"), "newest": ("last", "x")},
    reach=5,
)


def corpus(rng, n):
    for i in range(n):
        hot = rng.random() < 0.5
        yield ("hot" if hot else rng.choice(["a", "b", None]), 1 if hot else rng.choice([1, None]), rng.choice([None, *range(n // 2)]), i, rng.choice([None, None, *range(20)]))


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed,size", [(1, 5), (2, 17), (3, 64), (4, 10_000)])
def test_segments_equal_plain_windows(spark, seed, size):
    df = spark.createDataFrame(list(corpus(random.Random(seed), 400)), SCHEMA).repartition(4)
    out = with_windows(df, PANEL, COLUMNS, size)
    want = _plain(df, PANEL, COLUMNS)
    assert out.columns == want.columns and rows_of(out) == rows_of(want)


def test_places_count_every_row_once(spark):
    df = spark.createDataFrame([("hot", 1, t, i, 0) for i, t in enumerate([3] * 200 + list(range(100)))], SCHEMA)
    rows = positioned(df, PANEL).orderBy("_at").collect()
    assert [r["_at"] for r in rows] == list(range(300))
    assert [(r["t"], r["i"]) for r in rows] == sorted((r["t"], r["i"]) for r in rows)


def test_a_task_holds_one_segment_and_its_halo(spark):
    df = spark.createDataFrame(list(corpus(random.Random(5), 900)), SCHEMA)
    plan = with_windows(df, PANEL, COLUMNS, 50)
    text = plan._jdf.queryExecution().toString()
    assert "_segment" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    placed = positioned(df.where("k = 'hot'"), PANEL)
    assert placed.groupBy(F.floor(F.col("_at") / 50)).count().agg(F.max("count")).first()[0] == 50


def test_sums_of_decimals_keep_their_type(spark):
    df = spark.createDataFrame([("a", 1, t, 0, t) for t in range(30)], SCHEMA).withColumn("m", F.col("x").cast("decimal(18,2)"))
    columns = Columns(running={"total": ("sum", "m")}, whole={"all": ("sum", "m")})
    assert with_windows(df, PANEL, columns, 4).dtypes == with_windows(df, PANEL, columns, 400).dtypes


def test_bad_calls(spark):
    df = spark.createDataFrame([("a", 1, 1, 1, 1)], SCHEMA)
    with pytest.raises(ValueError, match="reach"):
        with_windows(df, PANEL, COLUMNS, 4)
    with pytest.raises(ValueError, match="repeat"):
        with_windows(df, PANEL, Columns(whole={"x": ("max", "x")}))
    assert with_windows(df.limit(0), PANEL, COLUMNS, 5).count() == 0


# as-of joins ------------------------------------------------------------------------
LEFT, RIGHT = "k string, t int, id int", "k string, since int, v string, w int"


def in_force(left, right, strict=False, within=None):
    out = []
    for k, t, i in left:
        known = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and (r[1] < t if strict else r[1] <= t)]
        best = max(known, key=lambda r: (r[1], r[3] is not None, r[3] or 0), default=None)
        if best is not None and within is not None and best[1] + within < t:
            best = None
        out.append((k, t, i, *(best[1:] if best else (None, None, None))))
    return sorted(map(str, out))


@pytest.mark.parametrize("seed,size,strict,within", [(1, 10_000, False, None), (2, 20, False, None), (3, 7, True, None), (4, 20, False, 3), (5, 1, True, 2)])
def test_asof_join(spark, seed, size, strict, within):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "a", "b", None])
    left = [(key(), rng.choice([None, *range(60)]), i) for i in range(150)]
    right = [(key(), rng.choice([None, *range(60)]), rng.choice([None, "x", "y"]), w) for w in range(80)]
    l, r = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)  # noqa: E741
    out = asof_join(l, r, ["k"], "t", ["since", "v", "w"], right_time="since", ties=["w"], strict=strict, within=None if within is None else F.lit(within), size=size)
    assert out.columns == ["k", "t", "id", "since", "v", "w"]
    assert sorted(map(str, map(tuple, out.collect()))) == in_force(left, right, strict, within)


def test_asof_join_sorts_once_and_forms_no_pairs(spark):
    l, r = spark.createDataFrame([("a", 1, 1)], LEFT), spark.createDataFrame([("a", 1, "x", 1)], RIGHT)  # noqa: E741
    plan = asof_join(l, r, ["k"], "t", ["v"], right_time="since")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError, match="both sides"):
        asof_join(l, r.withColumnRenamed("w", "id"), ["k"], "t", ["id"], right_time="since")
    assert asof_join(l, r.limit(0), ["k"], "t", ["v"], right_time="since").collect()[0]["v"] is None
    assert asof_join(l.limit(0), r, ["k"], "t", ["v"], right_time="since").count() == 0
