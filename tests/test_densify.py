"""Days that are filled in are laid out behind the shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators.panel import densify

D = dt.date


def test_rows_and_new_days(spark):
    rows = [
        ("a", 1, D(2024, 2, 27), 5), ("a", 1, D(2024, 3, 2), 6), ("a", 1, D(2024, 3, 2), 7), ("a", 1, None, 8),
        (None, 1, D(2024, 1, 3), 1), (None, 1, D(2024, 1, 1), 2), ("a", None, D(2024, 1, 1), 3), ("b", 2, None, 4),
    ]
    df = spark.createDataFrame(rows, "k string, j int, d date, n long").withColumn("other", F.lit("x"))
    out = [tuple(r) for r in densify(df, ["k", "j"], "d", n=0).collect()]
    new = [("a", 1, D(2024, 2, 28)), ("a", 1, D(2024, 2, 29)), ("a", 1, D(2024, 3, 1)), (None, 1, D(2024, 1, 2))]
    want = [(*r, "x") for r in rows] + [(*r, 0, None) for r in new]
    assert sorted(map(str, out)) == sorted(map(str, want))


def test_no_day_that_is_filled_in_is_shuffled(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 1), 1), (1, D(2024, 1, 1), 1)], "k int, d date, n long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = densify(df, ["k"], "d", n=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "Exchange" in plan and "Exchange" not in plan[: plan.index("Generate")] and "Join" not in plan
