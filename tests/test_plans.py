"""What the physical plans must look like."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidewatch.operators import filters
from tidewatch.operators.dedupe import first_per_key
from tidewatch.operators.panel import Panel
from tidewatch.operators.reshape import widen
from tidewatch.plans import county
from tidewatch.registry import feeds
from tidewatch.registry.tables import events_panel, load


@pytest.fixture(autouse=True)
def fixed_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, node: str) -> int:
    return len(re.findall(node, plan(df)))


def test_windows_of_one_panel_share_one_shuffle_and_sort(spark):
    p = Panel(("k",), "d")
    df = spark.range(10).selectExpr("id % 3 AS k", "date_add(date'2021-01-01', cast(id as int)) AS d", "id AS x")
    df = df.withColumn("m", p.rolling_mean("x")).withColumns({"l": p.lag("m", 7), "c": p.change("m"), "top": p.max("m"), "n": p.size()})
    df = df.withColumn("filled", p.last_known("l")).where(F.col("n") >= 1)
    assert count(df, r"Exchange hashpartitioning") == 1
    assert count(df, r"\bSort \[") == 1
    assert "SinglePartition" not in plan(df)


def test_county_rows_are_shuffled_by_county_once(spark):
    df = county.county_panel(feeds.county_feeds(spark, SMALL))
    by_county = re.findall(r"Exchange hashpartitioning\(stname#\d+, ctyname#\d+, \d+\)", plan(df))
    # one for the windows; the other belongs to the latest-day subquery, after partial aggregation
    assert 1 <= len(by_county) <= 2


def test_latest_day_is_a_one_column_scan_pushed_into_filters(spark):
    events = load(spark, SMALL, "events")
    newest = filters.latest_of(events.select(F.to_date("ts").alias("d")), "d")
    df = filters.since_latest(events_panel(spark, SMALL), "d", 7, newest)
    text = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text
    tree = text.split("(1) Scan")[0]
    assert re.search(r"HashAggregate[\s\S]*Exchange[\s\S]*HashAggregate[\s\S]*Filter[\s\S]*Scan", tree)
    assert "Join" not in text


def test_scans_read_only_needed_columns(spark):
    df = load(spark, SMALL, "lineitem").groupBy("l_returnflag").agg(F.max("l_shipdate"))
    assert "ReadSchema: struct<l_returnflag:string,l_shipdate:timestamp_ntz>" in plan(df)


def test_entity_filter_reaches_the_scan_below_the_window(spark):
    p = Panel(("event_type",), "ts", ties=("event_id",))
    df = load(spark, SMALL, "events").withColumn("l", p.lag("value"))
    assert "In(event_type, [click,view])" in plan(filters.only_entities(df, "event_type", ["click", "view"]))
    assert filters.only_entities(df, "event_type", None) is df


def test_first_per_key_limits_copies_before_the_shuffle(spark):
    text = plan(first_per_key(load(spark, SMALL, "events"), ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()]))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit.*Partial", text)


def test_widening_shuffles_once_and_runs_no_job(spark):
    df = widen(load(spark, SMALL, "events"), ["user_id"], "event_type", ["value"], ["click", "view"])
    assert count(df, "Exchange") == 1 and "partial_max" in plan(df)


def test_coverage_is_counted_by_a_partial_aggregate(spark):
    df = filters.min_coverage(events_panel(spark, SMALL), "d")
    assert "Window" not in plan(df) and "BroadcastHashJoin" in plan(df)
