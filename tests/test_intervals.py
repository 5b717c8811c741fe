"""Interval joins against the definition, and how many rows they form."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.intervals import interval_join

POINTS, SPANS = "k string, t int, id int", "k string, lo int, hi int, rank int, v string"


def expected(points, spans, keyed=True):
    out = []
    for k, t, i in points:
        held = [(s[3] is not None, s[3] or 0, s[4] is not None, s[4] or "", s[4]) for s in spans if t is not None and (not keyed or (k is not None and s[0] == k)) and (s[1] is None or s[1] <= t) and (s[2] is None or t < s[2]) and (s[1] is None or s[2] is None or s[1] < s[2])]
        out.append((k, t, i, max(held)[-1] if held else None))
    return sorted(map(str, out))


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("seed,n,size", [(1, 60, 10_000), (2, 200, 25), (3, 1, 5), (4, 2, 1), (5, 33, 7)])
def test_against_the_definition(spark, seed, n, size):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "a", None])
    points = [(key(), rng.choice([None, *range(-5, 100)]), i) for i in range(150)]
    end = lambda: rng.choice([None, *range(0, 90)])
    spans = [(key(), end(), end(), rng.choice([None, 1, 2, 3]), rng.choice(["x", "y", "z", None])) for _ in range(n)]
    spans += [("hot", 10, 80, 0, "long"), ("hot", None, None, -1, "always")]
    p, s = spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)
    out = interval_join(p, s, ["k"], "t", ["v"], priority=["rank"], size=size)
    assert out.columns == ["k", "t", "id", "v"] and rows_of(out) == expected(points, spans)
    assert rows_of(interval_join(p, s, [], "t", ["v"], priority=["rank"], size=size)) == expected(points, spans, keyed=False)


def test_intervals_that_all_overlap_cost_no_pairs(spark):
    n = 3000
    nested = spark.range(n).select(F.lit("a").alias("k"), F.col("id").cast("int").alias("lo"), (F.lit(2 * n) - F.col("id")).cast("int").alias("hi"), F.col("id").cast("int").alias("rank"), F.col("id").cast("string").alias("v"))
    points = spark.range(2 * n).select(F.lit("a").alias("k"), F.col("id").cast("int").alias("t"), F.col("id").cast("int").alias("id"))
    out = interval_join(points, nested, ["k"], "t", ["v"], priority=["rank"])
    got = {r["t"]: r["v"] for r in out.collect()}
    assert all(got[t] == str(min(t, 2 * n - t - 1, n - 1)) for t in range(2 * n))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_precise_times(spark):
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    points = spark.range(3).select(F.col("id"), F.element_at(F.array(at("2024-01-01 00:00:00.000001"), at("2024-01-01 00:00:00.000002"), at("2024-01-01 00:00:00.000003")), (F.col("id") + 1).cast("int")).alias("t"))
    spans = spark.range(1).select(at("2024-01-01 00:00:00.000002").alias("lo"), at("2024-01-01 00:00:00.000003").alias("hi"), F.lit(1).alias("rank"), F.lit("x").alias("v"))
    out = interval_join(points, spans, [], "t", ["v"], priority=["rank"])
    assert [r["v"] for r in out.orderBy("id").collect()] == [None, "x", None]


def test_empty_sides(spark):
    p, s = spark.createDataFrame([("a", 1, 1)], POINTS), spark.createDataFrame([("a", 0, 5, 1, "x"), ("a", 3, 3, 9, "y"), ("a", 4, 2, 9, "z")], SPANS)
    assert rows_of(interval_join(p, s.limit(0), ["k"], "t", ["v"], priority=["rank"])) == ["('a', 1, 1, None)"]
    assert interval_join(p.limit(0), s, ["k"], "t", ["v"], priority=["rank"]).count() == 0
    assert rows_of(interval_join(p, s, ["k"], "t", ["v"], priority=["rank"])) == ["('a', 1, 1, 'x')"]
    with pytest.raises(ValueError, match="both sides"):
        interval_join(p, s.withColumnRenamed("v", "id"), ["k"], "t", ["id"], priority=["rank"])
