"""Joins: row counts, keys, sizes and the way around hot keys."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidewatch.operators.enrich import full_join_feeds, left_join_feeds, lookup, one_per_key, step_join, step_value
from tidewatch.functions.codes import folded

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(params=["broadcast", "shuffle"])
def way(request, spark):
    """Both ways a join can run."""
    if request.param == "shuffle":
        for key, value in NO_BROADCAST.items():
            spark.conf.set(key, value)
    yield request.param
    for key in NO_BROADCAST:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows has one key, a ninth has none."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(7)).when(n % 9 == 1, F.lit(None)).otherwise(n % 50)
    return spark.range(9000, numPartitions=8).select(n, key.cast("long").alias("k"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(40).select(F.concat(F.lit("name "), "id").alias("name"), F.col("id").alias("k"), F.when(F.col("id") != 7, F.col("id")).alias("w"))


def test_rows_and_column_order_are_the_same_both_ways(fact, dim, way):
    df = lookup(fact, dim, "k")
    assert df.columns == ["id", "k", "name", "w"]
    got = [(r["id"], r["k"], r["name"], r["w"]) for r in df.collect()]
    want = [(r["id"], k, *((f"name {k}", None if k == 7 else k) if k is not None and k < 40 else (None, None))) for r in fact.collect() for k in [r["k"]]]
    assert sorted(got, key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])
    assert ("BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()) == (way == "broadcast")


def test_no_job_runs_before_rows_are_asked_for(spark, fact, dim):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan only")
    lookup(lookup(fact, dim, "k"), dim.select("k", F.col("name").alias("again")), "k")
    assert list(tracker.getJobIdsForGroup("plan")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_keys_are_split_by_adaptive_execution(spark, dim):
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    for key, value in {**NO_BROADCAST, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        rows = spark.range(400_000, numPartitions=8).select(n, F.when(n % 2 == 0, 7).otherwise(n % 5000).alias("k"), F.sha2(n.cast("string"), 256).alias("wide"))
        df = lookup(rows, spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("w")), "k")
        df.write.format("noop").mode("overwrite").save()
        sizes = [r["count"] for r in df.withColumn("task", F.spark_partition_id()).where("k = 7").groupBy("task").count().collect()]
        assert sum(sizes) == 200_000 + 80 and len(sizes) >= 4
    finally:
        for key in NO_BROADCAST:
            spark.conf.unset(key)
        for key, value in keep.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_repeated_dimension_keys_are_refused(fact, dim, way):
    with pytest.raises(Exception, match="repeats a key"):
        lookup(fact, dim.unionByName(dim.limit(1)), "k").collect()
    assert one_per_key(dim, ["k"]).columns == dim.columns


def test_columns_on_both_sides_are_refused(fact, dim):
    with pytest.raises(ValueError, match="both sides"):
        lookup(fact, dim.withColumn("id", F.lit(1)), "k")


def test_missing_keys_match_only_when_asked(frame, way):
    left = frame([("a", 1), (None, 2)], "k string, x int")
    right = frame([("a", "A"), (None, "none"), ("b", "B"), ("c", "C")], "k string, y string")
    assert values(lookup(left, right, "k"), "y", "x") == ["A", None]
    assert values(lookup(left, right, "k", null_safe=True), "y", "x") == ["A", "none"]


def test_full_join_puts_keys_together(frame):
    a = frame([("x", "2021-01-01", 1)], "k string, d date, a int")
    b = frame([("x", "2021-01-01", 2), ("y", "2021-01-02", 3)], "k string, d date, b int")
    c = frame([("z", "2021-01-03", 4)], "k string, d date, c int")
    got = full_join_feeds([a, b, c], ["k", "d"]).orderBy("k").collect()
    assert [(r["k"], r["a"], r["b"], r["c"]) for r in got] == [("x", 1, 2, None), ("y", None, 3, None), ("z", None, None, 4)]
    with pytest.raises(ValueError, match="more than one side"):
        full_join_feeds([a, a], ["k", "d"])


def test_feeds_that_repeat_a_key_are_refused(frame):
    a = frame([("x", "2021-01-01", 1)], "k string, d date, a int")
    twice = frame([("x", "2021-01-01", 2), ("x", "2021-01-01", 3)], "k string, d date, b int")
    for joined in (left_join_feeds(a, twice, ["k", "d"]), full_join_feeds([a, twice], ["k", "d"])):
        with pytest.raises(Exception, match="feed repeats a key"):
            joined.collect()


def test_step_forms_agree(spark, frame):
    steps = [("2021-01-03", 0.0), ("2021-01-05", 0.5), ("2021-01-06", 0.9)]
    days = frame([(str(dt.date(2021, 1, 1) + dt.timedelta(days=i)),) for i in range(9)], "d date")
    table = frame([("2021-01-03", "2021-01-05", 0.0), ("2021-01-05", "2021-01-06", 0.5), ("2021-01-06", "2021-02-01", 0.9)], "lo date, hi date, p double")
    folded = values(days.withColumn("p", step_value("d", steps)), "p", "d")
    assert folded == [None, None, 0.0, 0.0, 0.5, 0.9, 0.9, 0.9, 0.9]
    assert values(step_join(days, "d", table), "p", "d") == folded
    with pytest.raises(ValueError):
        step_value("d", [])
    # an open step, one far beyond the data, one that holds no day, and a table longer than any CASE should be
    table = frame([("1990-01-01", "2021-01-03", 0.1), ("2021-01-04", None, 0.2), ("2021-01-03", "2021-01-03", 9.0)], "lo date, hi date, p double")
    assert values(step_join(days, "d", table), "p", "d") == [0.1, 0.1, None, *[0.2] * 6]
    assert values(step_join(days, "d", table.withColumn("hi", F.coalesce("hi", F.lit("9999-01-01").cast("date")))), "p", "d") == [0.1, 0.1, None, *[0.2] * 6]
    long = [(str(dt.date(2020, 1, 1) + dt.timedelta(days=i)), float(i)) for i in range(500)]
    assert values(days.withColumn("p", step_value("d", long)), "p", "d") == [366.0 + i for i in range(9)]


def test_long_literal_tables(spark):
    table = {f"k{i}": i for i in range(200)}
    rows = spark.createDataFrame([("k0",), ("k199",), ("other",), (None,)], "k string").select(folded("k", table).alias("v"))
    assert [r["v"] for r in rows.collect()] == [0, 199, None, None]
    with pytest.raises(ValueError):
        folded("k", {})
