"""Panel windows against plain Python on random gappy panels."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.operators.panel import Panel, with_latest, with_peak
from tidewatch.operators.reshape import lengthen, widen

P = Panel(("k",), "d")
cells = st.dictionaries(
    st.tuples(st.sampled_from("abc"), st.integers(0, 25)), st.one_of(st.none(), st.integers(0, 9)), min_size=1, max_size=50
)


def build(spark, data):
    rows = [(k, dt.date(2021, 1, 1) + dt.timedelta(days=d), x) for (k, d), x in data.items()]
    return spark.createDataFrame(rows, "k string, d date, x long").repartition(3)


def expected(data):
    series = defaultdict(list)
    for (k, d), x in sorted(data.items()):
        series[k].append((dt.date(2021, 1, 1) + dt.timedelta(days=d), x))
    out = {}
    for k, s in series.items():
        xs = [x for _, x in s]
        known = [x for x in xs if x is not None]
        peak = max(known, default=None)
        for i, (d, x) in enumerate(s):
            frame = xs[max(0, i - 6) : i + 1]
            have = [v for v in frame if v is not None]
            out[k, d] = {
                "ramp": sum(frame) / len(frame) if len(have) == len(frame) else None,
                "strict": sum(have) / 7 if len(have) == 7 else None,
                "total": sum(have) if len(have) == 7 else None,
                "lag2": xs[i - 2] if i >= 2 else None,
                "delta": x - xs[i - 1] if i and x is not None and xs[i - 1] is not None else None,
                "size": len(s),
                "nth": i + 1,
                "filled": x if x is not None else (known[-1] if known else None),
                "now": xs[-1],
                "top": peak,
                "top_day": max((e for e, v in s if v is not None and v == peak), default=None),
            }
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cells)
def test_panel_columns(spark, data):
    df = build(spark, data).withColumns(
        {
            "ramp": P.rolling_mean("x"),
            "strict": P.rolling_mean("x", mode="strict"),
            "total": P.rolling_total("x"),
            "lag2": P.lag("x", 2),
            "delta": P.delta("x"),
            "size": P.size(),
            "nth": P.position(),
            "filled": P.last_known("x"),
        }
    )
    df = with_peak(with_latest(df, P, now="x"), P, "x", "top", "top_day", "fall", "days")
    want = expected(data)
    got = {(r["k"], r["d"]): r.asDict() for r in df.collect()}
    assert got.keys() == want.keys()
    for key, columns in want.items():
        assert {c: got[key][c] for c in columns} == columns


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cells)
def test_long_to_wide_and_back(spark, data):
    df = build(spark, data)
    back = lengthen(widen(df, ["d"], "k", ["x"], ["a", "b", "c"]), ["d"], ["a", "b", "c"]).where(F.col("value").isNotNull())
    want = {(str(dt.date(2021, 1, 1) + dt.timedelta(days=d)), k, x) for (k, d), x in data.items() if x is not None}
    assert {(str(r["d"]), r["name"], r["value"]) for r in back.collect()} == want
