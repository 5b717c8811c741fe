"""Closest known names against all pairs; figures of spans against exact ones."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.sketches import DISTINCT_ERROR, RANK_ERROR, DailyQuality
from tidewatch.operators.spelling import nearest_names, neighbourhood, repair_names


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("seed,k", [(1, 1), (2, 2)])
def test_nearest_against_all_pairs(spark, seed, k):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 7)))
    names, known = sorted({word() for _ in range(120)}), sorted({word() for _ in range(60)})
    df = lambda words: spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["name"]: (r["distance"], r["nearest"], r["n"]) for r in nearest_names(df(names), df(known), k).collect()}
    want = {}
    for a in names:
        close = [(edits(a, b), b) for b in known if edits(a, b) <= k]
        if close:
            best = min(close)
            want[a] = (*best, sum(d == best[0] for d, _ in close))
    assert got == want


def test_neighbourhood(spark):
    row = spark.createDataFrame([("abc", "", None)], "a string, e string, n string").select(neighbourhood("a", 2), neighbourhood("e", 2), neighbourhood("n", 2)).first()
    assert sorted(row[0]) == ["a", "ab", "abc", "ac", "b", "bc", "c"] and row[1] == [""] and set(row[2]) <= {None}


def test_repair(spark):
    known = spark.createDataFrame([("New York",), ("Newark",), ("Dona Ana",), ("Maine",), ("Marne",), (None,)], "county string")
    rows = [(1, "new  york "), (2, "Nwe York"), (3, "Doña Ana"), (4, "Mazne"), (5, "Elsewhere"), (6, None), (7, ""), (8, "newyork"), (9, "Newark"), (9, "Newark")]
    df = spark.createDataFrame(rows, "id int, written string")
    out = repair_names(df, "written", known, "county")
    got = sorted((r["id"], r["repaired"], r["distance"]) for r in out.collect())
    assert got == [(1, "New York", 0), (2, "New York", 2), (3, "Dona Ana", 1), (4, None, None), (5, None, None), (6, None, None), (7, None, None), (8, "New York", 1), (9, "Newark", 0), (9, "Newark", 0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(Exception, match="repeats a key"):
        repair_names(df, "written", known.union(spark.createDataFrame([("MAINE",)], known.schema)), "county").collect()
    assert repair_names(df.limit(0), "written", known, "county").count() == 0
    assert repair_names(df, "written", known.limit(0), "county").where("repaired is not null").count() == 0


# spans -----------------------------------------------------------------------------------
def test_figures_of_spans_are_within_their_error(spark, tmp_path):
    rng = random.Random(3)
    rows = [(dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(60)), rng.randrange(3000), rng.choice([None, rng.gauss(0, 5)])) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "d date, k long, x double")
    quality = DailyQuality(spark, str(tmp_path), "d", "k", "x")
    quality.publish(df.where("d < '2021-02-10'").withColumn("x", F.lit(0.0)))
    quality.publish(df.where("d >= '2021-02-10'"))
    quality.publish(df.where("d < '2021-02-10'"))  # a revision replaces its days
    spans = [(dt.date(2021, 1, 1) + dt.timedelta(days=a), dt.date(2021, 1, 1) + dt.timedelta(days=b)) for a, b in ((0, 59), (5, 5), (20, 44), (58, 300), (9, 3))]
    got = {(r["first"], r["last"]): r for r in quality.spans(spark.createDataFrame(spans, "first date, last date"), (0.1, 0.5, 0.9)).collect()}
    assert set(got) == set(spans[:4])
    for (a, b), r in got.items():
        inside = [x for x in rows if a <= x[0] <= b]
        known = sorted(x[2] for x in inside if x[2] is not None)
        assert (r["n_rows"], r["n_values"]) == (len(inside), len(known))
        exact = len({x[1] for x in inside})
        assert abs(r["n_keys"] - exact) <= DISTINCT_ERROR * exact + 1
        for q in (0.1, 0.5, 0.9):
            rank = statistics.mean(x <= r[f"q{round(100 * q)}"] for x in known)
            assert abs(rank - q) <= RANK_ERROR + 1 / len(known)


def test_days_without_values(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2021, 1, 1), None, None), (None, 1, 1.0)], "d date, k long, x double")
    quality = DailyQuality(spark, str(tmp_path), "d", "k", "x")
    quality.publish(df)
    quality.publish(df)
    spans = spark.createDataFrame([(dt.date(2021, 1, 1), dt.date(2021, 1, 2))], "first date, last date")
    assert tuple(quality.spans(spans).first())[2:] == (1, 0, 0, None)
