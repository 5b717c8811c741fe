"""Missing-value, ordering and text rules on hand-made rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import values
from tidewatch.functions import codes, dates, missing, names
from tidewatch.operators.dedupe import first_per_key
from tidewatch.operators.panel import Panel, with_latest, with_peak, zero_fill

P = Panel(("k",), "d")


def series(frame, xs, k="a", start="2021-01-01"):
    first = dt.date.fromisoformat(start)
    return frame([(k, str(first + dt.timedelta(days=i)), x) for i, x in enumerate(xs)], "k string, d date, x double")


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_ramp_mean_and_missing(frame):
    df = series(frame, [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0])
    got = values(df.withColumn("m", P.rolling_mean("x")), "m", "d")
    assert got[:3] == [1.0, 1.5, 2.0]
    assert got[3:10] == [None] * 7
    assert got[10] == 8.0


def test_strict_mean_and_total(frame):
    df = series(frame, [1.0] * 6 + [8.0, None, 1.0])
    assert values(df.withColumn("m", P.rolling_mean("x", mode="strict")), "m", "d") == [None] * 6 + [2.0, None, None]
    assert values(df.withColumn("m", P.rolling_total("x")), "m", "d") == [None] * 6 + [14.0, None, None]


def test_ramp_equals_strict_from_the_seventh_row(frame):
    df = series(frame, [float(i * i % 11) for i in range(30)])
    both = df.withColumns({"r": P.rolling_mean("x"), "s": P.rolling_mean("x", mode="strict")})
    assert values(both, "r", "d")[6:] == values(both, "s", "d")[6:]


def test_windows_count_rows_not_days(frame):
    rows = [("a", f"2021-01-{d:02d}", float(d)) for d in (1, 5, 20)]
    df = frame(rows, "k string, d date, x double")
    assert values(df.withColumn("l", P.lag("x")), "l", "d") == [None, 1.0, 5.0]


def test_short_series_and_unknown_mode(frame):
    assert values(series(frame, [4.0]).withColumn("m", P.rolling_mean("x")), "m", "d") == [4.0]
    try:
        P.rolling_mean("x", mode="other")
        raise AssertionError("must fail")
    except ValueError:
        pass


def test_deltas(frame):
    df = series(frame, [5.0, 7.0, None, 9.0])
    assert values(df.withColumn("n", P.delta("x")), "n", "d") == [None, 2.0, None, None]
    assert values(df.withColumn("n", P.delta("x", keep_first=True)), "n", "d") == [5.0, 2.0, None, 9.0]


def test_sum_of_deltas_is_the_counter(frame):
    df = series(frame, [1.0, 4.0, 9.0, 16.0]).withColumn("n", P.delta("x", keep_first=True))
    assert sum(values(df, "n", "d")) == 16.0


def test_lags_stay_within_the_entity(frame):
    df = series(frame, [1.0, 2.0], "a").unionByName(series(frame, [10.0, 20.0], "b"))
    assert values(df.withColumn("l", P.lag("x")), "l", "k", "d") == [None, 1.0, None, 10.0]


def test_latest_keeps_a_missing_newest_value(frame):
    df = series(frame, [1.0, 2.0, None])
    assert values(with_latest(df, P, now="x"), "now", "d") == [None] * 3
    assert values(with_latest(series(frame, [1.0, 2.0]), P, now="x"), "now", "d") == [2.0, 2.0]


def test_peak_is_its_last_day_and_none_without_values(frame):
    df = with_peak(series(frame, [1.0, 4.0, 4.0, 2.0]), P, "x", "top", "top_day", "fall", "days")
    last = df.orderBy("d").collect()[-1]
    assert (last["top"], last["top_day"], last["fall"], last["days"]) == (4.0, dt.date(2021, 1, 3), -0.5, 1)
    none = with_peak(series(frame, [None, None]), P, "x", "top", "top_day", "fall", "days").first()
    assert (none["top"], none["top_day"], none["fall"], none["days"]) == (None, None, None, None)


def test_last_known_is_by_date(frame):
    rows = [("a", "2021-01-03", 3.0), ("a", "2021-01-01", None), ("a", "2021-01-02", 2.0), ("a", "2021-01-04", None)]
    df = frame(rows, "k string, d date, x double").withColumn("f", P.last_known("x"))
    assert values(df, "f", "d") == [3.0, 2.0, 3.0, 3.0]


def test_zero_fill_stops_after_the_window(frame):
    df = series(frame, [None, 5.0, None]).withColumn("z", zero_fill("x", "d", F.lit("2021-01-02").cast("date")))
    assert values(df, "z", "d") == [0.0, 5.0, None]


def test_first_row_mask(frame):
    assert values(series(frame, [1.0, 2.0]).withColumn("m", P.mask_first("x")), "m", "d") == [None, 2.0]


def test_division_and_sums(spark, frame):
    row = one(
        spark,
        missing.ratio(F.lit(1), F.lit(0)).alias("a"),
        missing.ratio_or_zero(F.lit(1), F.lit(0)).alias("b"),
        missing.rate_per(F.lit(1), F.lit(4)).alias("c"),
        missing.add_all(F.lit(1), F.lit(None).cast("int")).alias("d"),
        missing.relative_change(F.lit(3), F.lit(2)).alias("e"),
    )
    assert tuple(row) == (None, 0.0, 250.0, None, 0.5)
    df = frame([("a", None), ("a", None), ("b", 1.0)], "k string, x double")
    assert values(df.groupBy("k").agg(missing.sum_or_zero("x").alias("s")), "s", "k") == [0.0, 1.0]


def test_choice_membership_and_clip(spark):
    null = F.lit(None).cast("int")
    row = one(
        spark,
        missing.if_else_null(null > 1, F.lit("y"), F.lit("n")).alias("a"),
        missing.is_in(null, [1]).alias("b"),
        missing.clip(null, -5, 5).alias("c"),
        missing.clip(F.lit(9), -5, 5).alias("d"),
        missing.clip(F.lit(-9), -5, 5).alias("e"),
        missing.number(F.lit("x1")).alias("f"),
        missing.number(F.lit("1.5")).alias("g"),
        missing.default_to(null, 0).alias("h"),
    )
    assert tuple(row) == (None, False, None, 5, -5, None, 1.5, 0)


def test_dates(spark):
    day = dt.date(2021, 3, 5)
    texts = {"2021-03-05": day, "2021/3/5": day, "20210305": day, "3/5/2021": day, "5-Mar-2021": day, "soon": None, "2021-13-01": None}
    for text, want in texts.items():
        assert one(spark, dates.parse_date(F.lit(text), dates.ANY_FORMATS).alias("d"))["d"] == want
    assert one(spark, dates.parse_date(F.lit("3/5/2021")).alias("d"))["d"] is None
    assert one(spark, dates.date_head(F.lit("03/05/2021 11:59:59 PM")).alias("d"))["d"] == day
    assert one(spark, dates.parse_date(F.lit(20210305), dates.COMPACT).alias("d"))["d"] == day


def test_date_flags(frame):
    df = frame([("2021-03-01", "2021-03-08"), ("2021-03-02", "2021-03-08"), ("2021-03-08", "2021-03-08")], "d date, max_date date")
    got = df.withColumns(dates.as_of_columns("d")).withColumn("w", dates.in_last_week("d", "max_date")).orderBy("d").collect()
    assert [r["max_date_ind"] for r in got] == ["No", "No", "Yes"]
    assert [r["weekday_match"] for r in got] == ["Yes", "No", "Yes"]
    assert [r["w"] for r in got] == ["N", "Y", "Y"]
    assert got[0]["weekday"] == "Monday" and got[0]["two_week_date"] == dt.date(2021, 2, 22)


def test_display_date_uses_its_own_year(frame):
    row = frame([("2022-02-07",)], "d date").select(*[c.alias(n) for n, c in dates.calendar_parts("d").items()]).first()
    assert tuple(row) == (2022, "Feb", 2, 7, "2022-Feb-7")


def test_codes(spark):
    null = F.lit(None).cast("string")
    row = one(
        spark,
        codes.pad_code(F.lit("12")).alias("a"),
        codes.pad_code(F.lit(1001)).alias("b"),
        codes.pad_code(F.lit("123456")).alias("c"),
        codes.pad_code(null).alias("d"),
        codes.join_code(F.lit("01"), null).alias("e"),
        codes.two_way_label(F.lit(2), F.lit(1), "Blue", "Red").alias("f"),
        codes.two_way_label(F.lit(None).cast("int"), F.lit(1), "Blue", "Red").alias("g"),
        codes.two_way_label(F.lit(None).cast("int"), F.lit(1), "Blue", "Red", True).alias("h"),
    )
    assert tuple(row) == ("00012", "01001", "123456", None, None, "Blue", None, "Red")


def test_buckets(spark):
    rules = [(None, "0-50"), (50, "50-60"), (60, "60-70"), (70, "70-100")]
    for x, want in ((-1, "0-50"), (49.9, "0-50"), (50, "50-60"), (60, "60-70"), (70, "70-100"), (100, "70-100"), (None, None)):
        assert one(spark, codes.buckets(F.lit(x).cast("double"), rules).alias("b"))["b"] == want
    for x, want in ((0.45, "lo"), (0.5, "mid"), (0.55, "hi"), (None, None)):
        assert one(spark, codes.margin_bucket(F.lit(x).cast("double"), 0.45, 0.55, ("lo", "mid", "hi")).alias("b"))["b"] == want


def test_names(spark):
    assert names.clean_names(["State Code", "popEstimate2019", "Id", "id", "% change", "2nd", "a.b", ""]) == [
        "state_code", "pop_estimate2019", "id", "id_2", "percent_change", "x2nd", "a_b", "x",
    ]
    first = lambda s, a, b: one(spark, names.replace_first(F.lit(s), a, b).alias("x"))["x"]
    assert first("20_29_20_29", "0_", "0 to ") == "20 to 29_20_29"
    assert first("none", "0_", "0 to ") == "none"
    assert first("a.b.c", ".", "$1\\") == "a$1\\b.c"


def test_first_per_key_does_not_depend_on_partitioning(frame):
    rows = [("a", str(dt.date(2021, 1, 1) + dt.timedelta(days=i % 5)), float(i)) for i in range(200)]
    df = frame(rows, "k string, d date, x double")
    picks = {
        tuple(sorted((r["d"], r["x"]) for r in first_per_key(df.repartition(n), ["k", "d"], [F.col("x").desc()]).collect())) for n in (1, 3, 8)
    }
    assert len(picks) == 1
