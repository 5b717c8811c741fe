"""Every registered query against its SQL, row by row."""

from __future__ import annotations

import re

import pytest

from compare import difference
from conftest import SMALL
from tidewatch.registry import BOOK


@pytest.mark.parametrize("name", list(BOOK))
def test_same_rows_as_sql(spark, con, name):
    query = BOOK[name]
    assert query.sql, "every query here can be said in SQL"
    df = query.run(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert node not in plan
    assert not re.search(r"Window \[.*\n(.*Sort.*\n)?.*Exchange SinglePartition", plan)
    assert difference(df, con, query.sql) is None


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(BOOK) <= set(e.queries()) and set(BOOK) <= set(e.oracle_sql()) <= set(e.queries())
    first = e.entry(spark)
    assert first.columns == ["event_type", "d", "n", "n_7d_avg", "lstwk_n_7d_avg", "n_incr_week"]
    assert first.count() > 0


@pytest.mark.parametrize(
    "name", ["right_join_enrich", "left_join_enrich_multi", "full_join_three_feeds", "flow_entity_daily_panel", "flow_trend_and_peak"]
)
def test_same_rows_when_no_dimension_may_be_broadcast(spark, con, name):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        df = BOOK[name].run(spark, SMALL)
        assert difference(df, con, BOOK[name].sql) is None
        columns = df.columns
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert columns == BOOK[name].run(spark, SMALL).columns
