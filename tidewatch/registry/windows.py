"""Window queries over the event and nation panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import ratio_or_zero
from ..operators import filters
from ..operators.panel import Panel, build_panel, with_latest, with_peak, zero_fill
from ..plans.reports import last_week
from .book import query, rounded
from .tables import (
    COUNTER_SQL, EVENTS, EVENTS_SQL, NATIONS, NATIONS_SQL, change_sql, events_panel, lag_sql, load, nations_counter, nations_panel,
    over, ramp_sql, rows, strict_sql,
)

N = "n_name"
E = "event_type"


def gaps(df: DataFrame, c: str, value: int, name: str = "m") -> DataFrame:
    """A measure with holes: one of its values counts as not reported."""
    return df.withColumn(name, F.nullif(F.col(c), F.lit(value)))


@query(
    "growth_panel",
    f"""
WITH p AS ({EVENTS_SQL}), m AS (SELECT *, {ramp_sql('n', E)} AS a FROM p)
SELECT event_type, d, n, round(a, 6) AS n_7d_avg, round({lag_sql('a', 7, E)}, 6) AS lstwk_n_7d_avg,
       round({change_sql('a', E)}, 6) AS n_incr_week
FROM m""",
)
def growth_panel(spark: SparkSession, sf: str) -> DataFrame:
    panel = events_panel(spark, sf).drop("v").withColumn("n_7d_avg", EVENTS.rolling_mean("n"))
    return rounded(panel.withColumns({"lstwk_n_7d_avg": EVENTS.lag("n_7d_avg", 7), "n_incr_week": EVENTS.change("n_7d_avg")}))


@query(
    "rolling_mean_ramp",
    f"""
WITH p AS (SELECT n_name, d, n, nullif(n, 3) AS m FROM ({NATIONS_SQL}))
SELECT n_name, d, n, m, round({ramp_sql('n', N)}, 6) AS n_7d_avg, round({ramp_sql('m', N)}, 6) AS m_7d_avg FROM p""",
)
def rolling_mean_ramp(spark: SparkSession, sf: str) -> DataFrame:
    panel = gaps(nations_panel(spark, sf).select(N, "d", "n"), "n", 3)
    return rounded(panel.withColumns({"n_7d_avg": NATIONS.rolling_mean("n"), "m_7d_avg": NATIONS.rolling_mean("m")}))


@query(
    "rolling_mean_strict",
    f"""
WITH p AS (SELECT n_name, d, n, nullif(n, 3) AS m FROM ({NATIONS_SQL}))
SELECT n_name, d, n, m, round({strict_sql('n', N)}, 6) AS n_7d_avg, round({strict_sql('m', N)}, 6) AS m_7d_avg FROM p""",
)
def rolling_mean_strict(spark: SparkSession, sf: str) -> DataFrame:
    panel = gaps(nations_panel(spark, sf).select(N, "d", "n"), "n", 3)
    return rounded(
        panel.withColumns({"n_7d_avg": NATIONS.rolling_mean("n", mode="strict"), "m_7d_avg": NATIONS.rolling_mean("m", mode="strict")})
    )


@query(
    "rolling_total_ratio",
    f"""
WITH p AS ({NATIONS_SQL}), t AS (SELECT n_name, d, n, n_f, CAST({strict_sql('n', N, fn='sum')} AS BIGINT) AS n_7d,
       CAST({strict_sql('n_f', N, fn='sum')} AS BIGINT) AS n_f_7d FROM p)
SELECT *, round(n_f_7d / nullif(n_7d, 0), 6) AS pct_7d FROM t""",
)
def rolling_total_ratio(spark: SparkSession, sf: str) -> DataFrame:
    panel = nations_panel(spark, sf).select(N, "d", "n", "n_f")
    return rounded(
        panel.withColumns(
            {"n_7d": NATIONS.rolling_total("n"), "n_f_7d": NATIONS.rolling_total("n_f"), "pct_7d": NATIONS.rolling_ratio("n_f", "n")}
        )
    )


@query(
    "counter_delta_first_kept",
    f"SELECT n_name, d, cum, coalesce(cum - {lag_sql('cum', 1, N)}, cum) AS new_n FROM ({COUNTER_SQL})",
)
def counter_delta_first_kept(spark: SparkSession, sf: str) -> DataFrame:
    return nations_counter(spark, sf).withColumn("new_n", NATIONS.delta("cum", keep_first=True))


@query("counter_delta_first_null", f"SELECT n_name, d, cum, cum - {lag_sql('cum', 1, N)} AS new_n FROM ({COUNTER_SQL})")
def counter_delta_first_null(spark: SparkSession, sf: str) -> DataFrame:
    return nations_counter(spark, sf).withColumn("new_n", NATIONS.delta("cum"))


LAGS = (1, 7, 14, 21, 28)


@query(
    "lags_1_7_14_21_28",
    f"SELECT n_name, d, n, {', '.join(f'{lag_sql("n", k, N)} AS n_lag_{k}' for k in LAGS)} FROM ({NATIONS_SQL})",
)
def lags(spark: SparkSession, sf: str) -> DataFrame:
    return nations_panel(spark, sf).select(N, "d", "n", *[NATIONS.lag("n", k).alias(f"n_lag_{k}") for k in LAGS])


@query("wow_change", f"SELECT event_type, d, v, round({change_sql('v', E)}, 6) AS v_incr_week FROM ({EVENTS_SQL})")
def wow_change(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(events_panel(spark, sf).select(E, "d", "v", EVENTS.change("v").alias("v_incr_week")))


@query(
    "latest_per_entity",
    f"""
WITH m AS (SELECT n_name, d, n, {ramp_sql('n', N)} AS a FROM ({NATIONS_SQL})),
     x AS (SELECT *, {lag_sql('a', 7, N)} AS b, max(d) OVER (PARTITION BY n_name) AS last_d FROM m)
SELECT n_name, d, n, round(max(CASE WHEN d = last_d THEN a END) OVER (PARTITION BY n_name), 6) AS recent_n,
       round(max(CASE WHEN d = last_d THEN b END) OVER (PARTITION BY n_name), 6) AS recent_n_1wk FROM x""",
)
def latest_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    panel = nations_panel(spark, sf).select(N, "d", "n").withColumn("a", NATIONS.rolling_mean("n")).withColumn("b", NATIONS.lag("a", 7))
    return rounded(with_latest(panel, NATIONS, recent_n="a", recent_n_1wk="b").drop("a", "b"))


@query(
    "peak_and_decline",
    f"""
WITH m AS (SELECT n_name, d, {strict_sql('n', N)} AS a FROM ({NATIONS_SQL})),
     x AS (SELECT *, max(a) OVER (PARTITION BY n_name) AS peak FROM m),
     y AS (SELECT *, max(CASE WHEN a = peak THEN d END) OVER (PARTITION BY n_name) AS peak_day FROM x)
SELECT n_name, d, round(a, 6) AS n_7d_avg, round(peak, 6) AS peak, peak_day, round((a - peak) / nullif(peak, 0), 6) AS decline,
       CAST(d - peak_day AS INTEGER) AS days_since_peak FROM y""",
)
def peak_and_decline(spark: SparkSession, sf: str) -> DataFrame:
    panel = nations_panel(spark, sf).select(N, "d", NATIONS.rolling_mean("n", mode="strict").alias("n_7d_avg"))
    return rounded(with_peak(panel, NATIONS, "n_7d_avg", "peak", "peak_day", "decline", "days_since_peak"))


@query(
    "min_history_filter",
    """
WITH p AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1, 2),
     c AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n_dates FROM p)
SELECT * FROM c WHERE n_dates >= 8""",
)
def min_history_filter(spark: SparkSession, sf: str) -> DataFrame:
    panel = build_panel(load(spark, sf, "orders"), ["o_custkey"], F.col("o_orderdate"), "d", n=rows())
    return filters.min_history(panel, Panel(("o_custkey",), "d"))


@query(
    "min_coverage_filter",
    f"""
WITH p AS (SELECT n_name, d, n FROM ({NATIONS_SQL})), c AS (SELECT d, count(*) AS n_states FROM p GROUP BY 1)
SELECT n_name, d, n, n_states, CAST(row_number() OVER (PARTITION BY n_name ORDER BY d) AS INTEGER) AS nth
FROM p JOIN c USING (d) WHERE n_states >= 5""",
)
def min_coverage_filter(spark: SparkSession, sf: str) -> DataFrame:
    covered = filters.min_coverage(nations_panel(spark, sf).select(N, "d", "n"), "d")
    return covered.withColumn("nth", NATIONS.position())


@query("drop_latest_day", f"WITH p AS ({EVENTS_SQL}) SELECT * FROM p WHERE d <> (SELECT max(CAST(ts AS DATE)) FROM events)")
def drop_latest_day(spark: SparkSession, sf: str) -> DataFrame:
    newest = filters.latest_of(load(spark, sf, "events").select(F.to_date("ts").alias("d")), "d")
    return filters.drop_latest(events_panel(spark, sf), "d", newest)


@query(
    "last_week_summary",
    f"""
WITH p AS ({EVENTS_SQL}), s AS (SELECT d, CAST(sum(n) AS BIGINT) AS n FROM p WHERE d >= (SELECT max(d) FROM p) - 7 GROUP BY 1)
SELECT d, n, n - lag(n) OVER (ORDER BY d) AS change FROM s""",
)
def last_week_summary(spark: SparkSession, sf: str) -> DataFrame:
    newest = filters.latest_of(load(spark, sf, "events").select(F.to_date("ts").alias("d")), "d")
    return last_week(events_panel(spark, sf), "d", "n", newest)


@query(
    "last_known_fill",
    f"""
WITH p AS (SELECT n_name, d, nullif(n, 1) AS m FROM ({NATIONS_SQL}))
SELECT n_name, d, m, coalesce(m, last_value(m IGNORE NULLS) OVER
       (PARTITION BY n_name ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS last_m FROM p""",
)
def last_known_fill(spark: SparkSession, sf: str) -> DataFrame:
    panel = gaps(nations_panel(spark, sf), "n", 1).select(N, "d", "m")
    return panel.withColumn("last_m", NATIONS.last_known("m"))


@query(
    "zero_fill_in_window",
    f"""
WITH p AS (SELECT n_name, d, n, nullif(n_f, 0) AS tests, nullif(n_urgent, 0) AS pos FROM ({NATIONS_SQL})),
     t AS (SELECT max(d) - 30 AS until_d FROM p),
     f AS (SELECT n_name, d, tests AS tests_before, CASE WHEN tests IS NULL AND d <= until_d THEN 0 ELSE tests END AS tests,
           CASE WHEN pos IS NULL AND d <= until_d THEN 0 ELSE pos END AS pos FROM p, t)
SELECT *, round(CASE WHEN tests = 0 THEN 0.0 ELSE pos / nullif(tests, 0) END, 6) AS pct_pos, round({ramp_sql('tests', N)}, 6) AS tests_7d_avg
FROM f""",
)
def zero_fill_in_window(spark: SparkSession, sf: str) -> DataFrame:
    panel = nations_panel(spark, sf).select(N, "d", F.nullif("n_f", F.lit(0)).alias("tests_before"), F.nullif("n_urgent", F.lit(0)).alias("pos"))
    until = F.date_sub(filters.latest_of(load(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")), "d"), 30)
    filled = panel.withColumns({"tests": zero_fill("tests_before", "d", until), "pos": zero_fill("pos", "d", until)})
    return rounded(filled.withColumns({"pct_pos": ratio_or_zero("pos", "tests"), "tests_7d_avg": NATIONS.rolling_mean("tests")}))


@query(
    "first_row_mask",
    f"""
WITH c AS (SELECT *, CAST(row_number() {over(N)} AS INTEGER) AS nth FROM ({COUNTER_SQL}))
SELECT n_name, d, cum, nth, CASE WHEN nth > 1 THEN cum - {lag_sql('cum', 1, N)} END AS new_n, CASE WHEN nth > 1 THEN cum END AS cum_masked FROM c""",
)
def first_row_mask(spark: SparkSession, sf: str) -> DataFrame:
    return nations_counter(spark, sf).withColumns(
        {"nth": NATIONS.position(), "new_n": NATIONS.mask_first(NATIONS.delta("cum")), "cum_masked": NATIONS.mask_first("cum")}
    )
