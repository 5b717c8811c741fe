"""The published panels over feeds made from the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import rename
from ..operators.dedupe import union_by_name
from ..plans import county, federal, hospital, nursing, peaks, reports, testing, trend
from ..plans.hospital import ADULT, CHILD, ICU
from ..sources.staging import shared_folder, staged
from . import feeds
from .book import query, rounded
from .feeds import CASES_CTE, COUNTY_SQL, HOSPITAL_CTE, NURSING_CTE, TEST_CTE, VAX_CTE
from .tables import NATIONS_SQL, SHIPMENTS_SQL, change_sql, lag_sql, nations_panel, over, ramp_sql, running, shipments_panel, strict_sql

C = "stname, ctyname"
S = "state"


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def asof_sql(latest: str) -> str:
    return f"""{latest} AS max_date, {latest} - 7 AS one_week_date, {latest} - 14 AS two_week_date,
 CASE WHEN date = {latest} THEN 'Yes' ELSE 'No' END AS max_date_ind, dayname(date) AS weekday, dayname({latest}) AS max_weekday,
 CASE WHEN dayname(date) = dayname({latest}) THEN 'Yes' ELSE 'No' END AS weekday_match"""


# counties --------------------------------------------------------------------------
CHANGES_SQL = f"""SELECT *, {lag_sql('cases', 1, C, 'date')} AS cases_prior, coalesce(cases - {lag_sql('cases', 1, C, 'date')}, cases) AS new_cases,
 {lag_sql('deaths', 1, C, 'date')} AS deaths_prior, coalesce(deaths - {lag_sql('deaths', 1, C, 'date')}, deaths) AS new_deaths"""

RESULT_SQL = """CASE WHEN ctyname = 'New York City' THEN 'Blue' WHEN votes_dem > votes_gop THEN 'Blue' WHEN NOT votes_dem > votes_gop THEN 'Red' END"""


@query(
    "flow_entity_daily_panel",
    f"""{COUNTY_SQL},
 ch AS ({CHANGES_SQL} FROM rated WHERE n_dates >= 8),
 m AS (SELECT *, {ramp_sql('new_cases', C, 'date')} AS pos_7d_avg, {ramp_sql('new_deaths', C, 'date')} AS death_7d_avg FROM ch),
 g AS (SELECT *, {lag_sql('pos_7d_avg', 7, C, 'date')} AS lstwk_pos_7d_avg, {lag_sql('death_7d_avg', 7, C, 'date')} AS lstwk_death_7d_avg,
     {change_sql('death_7d_avg', C, 'date')} AS deaths_incr_week, {change_sql('pos_7d_avg', C, 'date')} AS pos_incr_week,
     {lag_sql('pos_7d_avg', 14, C, 'date')} AS case_7d_15, {lag_sql('pos_7d_avg', 1, C, 'date')} AS case_yest,
     {lag_sql('death_7d_avg', 1, C, 'date')} AS death_yest, max(date) OVER (PARTITION BY {C}) AS last_d FROM m),
 a AS (SELECT *, max(CASE WHEN date = last_d THEN pos_7d_avg END) OVER (PARTITION BY {C}) AS recent_cases,
     max(CASE WHEN date = last_d THEN lstwk_pos_7d_avg END) OVER (PARTITION BY {C}) AS recent_cases_1wk,
     (SELECT max(date) FROM m) AS newest FROM g)
SELECT date, fips, stname, ctyname, cases, deaths, cbsaname, msaname, n_dates, cases_prior, new_cases, deaths_prior, new_deaths,
 {r6('pop', 'pop_density', 'caseper1k', 'deathper1k', 'pos_7d_avg', 'death_7d_avg', 'lstwk_pos_7d_avg', 'lstwk_death_7d_avg', 'deaths_incr_week',
     'pos_incr_week', 'case_7d_15', 'case_yest', 'death_yest', 'recent_cases', 'recent_cases_1wk')},
 biden AS "Biden", trump AS "Trump", total_votes, round(biden_pct, 6) AS biden_pct,
 CASE WHEN biden_pct <= 0.45 THEN 'Trump +10 or more' WHEN biden_pct < 0.55 THEN 'Biden +/- 10' WHEN biden_pct >= 0.55 THEN 'Biden + 10 or more' END AS biden_pct_bucket,
 votes_dem, votes_gop, {RESULT_SQL} AS result2016, {asof_sql('newest')}, state_code, region, division, series_complete_pop_pct,
 CASE WHEN series_complete_pop_pct >= 70 THEN '70-100' WHEN series_complete_pop_pct >= 60 THEN '60-70'
      WHEN series_complete_pop_pct >= 50 THEN '50-60' WHEN series_complete_pop_pct IS NOT NULL THEN '0-50' END AS full_vax_bin
FROM a LEFT JOIN share20 USING (fips) LEFT JOIN v16 USING (fips) LEFT JOIN regions USING (stname) LEFT JOIN vax USING (fips)""",
)
def entity_daily_panel(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(county.county_panel(feeds.county_feeds(spark, sf)))


@query(
    "flow_entity_daily_panel_strict",
    f"""{COUNTY_SQL},
 ch AS ({CHANGES_SQL}, max(date) OVER (PARTITION BY fips) AS last_fips FROM rated),
 newest AS (SELECT *, CASE WHEN fips IS NOT NULL THEN last_fips END AS newest FROM ch)
SELECT date, CASE WHEN length(CAST(fips AS VARCHAR)) < 5 THEN lpad(CAST(fips AS VARCHAR), 5, '0') ELSE CAST(fips AS VARCHAR) END AS fips,
 stname, ctyname, cases, deaths, cbsaname, msaname, cases_prior, new_cases, deaths_prior, new_deaths, {r6('pop', 'pop_density', 'caseper1k', 'deathper1k')},
 {RESULT_SQL} AS result2016, round({strict_sql('new_cases', C, 'date')}, 6) AS pos_7d_avg,
 round({strict_sql('new_deaths', C, 'date')}, 6) AS death_7d_avg, newest AS max_date, newest - 7 AS one_week_date, newest - 14 AS two_week_date,
 CASE WHEN date = newest THEN 'Yes' WHEN date <> newest THEN 'No' END AS max_date_ind, dayname(date) AS weekday, dayname(newest) AS max_weekday,
 CASE WHEN dayname(date) = dayname(newest) THEN 'Yes' WHEN dayname(date) <> dayname(newest) THEN 'No' END AS weekday_match
FROM newest LEFT JOIN v16 USING (fips)""",
)
def entity_daily_panel_strict(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(county.county_panel_strict(feeds.county_feeds(spark, sf)))


# state trend ------------------------------------------------------------------------
@query(
    "flow_trend_and_peak",
    f"""
WITH p AS (SELECT n_name AS state, d AS date, n_f AS "positiveIncrease", n AS "totalTestResultsIncrease", n_urgent AS "deathIncrease",
      n_o AS "hospitalizedCurrently" FROM ({NATIONS_SQL})),
 m AS (SELECT *, positiveIncrease / nullif(totalTestResultsIncrease, 0) AS pct_positive,
     {strict_sql('positiveIncrease', S, 'date')} AS pos_7d_avg, {strict_sql('totalTestResultsIncrease', S, 'date')} AS test_7d_avg,
     {strict_sql('deathIncrease', S, 'date')} AS death_7d_avg,
     CAST({strict_sql('totalTestResultsIncrease', S, 'date', 'sum')} AS BIGINT) AS totaltests_7d,
     CAST({strict_sql('positiveIncrease', S, 'date', 'sum')} AS BIGINT) AS totalpos_7d FROM p),
 t AS (SELECT *, totalpos_7d / nullif(totaltests_7d, 0) AS pct_pos_7d, {', '.join(f'{lag_sql(f"{x}_7d_avg", 7, S, "date")} AS lstwk_{x}_7d_avg' for x in ('death', 'pos', 'test'))},
     {lag_sql('hospitalizedCurrently', 7, S, 'date')} AS lstwk_hosp,
     hospitalizedCurrently - {lag_sql('hospitalizedCurrently', 1, S, 'date')} AS change_hosp,
     {change_sql('death_7d_avg', S, 'date')} AS deaths_incr_week, {change_sql('pos_7d_avg', S, 'date')} AS pos_incr_week,
     {change_sql('test_7d_avg', S, 'date')} AS tests_incr_week,
     max(death_7d_avg) OVER (PARTITION BY state) AS pd, max(pos_7d_avg) OVER (PARTITION BY state) AS pp FROM m),
 k AS (SELECT *, max(CASE WHEN death_7d_avg = pd THEN date END) OVER (PARTITION BY state) AS max_death_date,
     max(CASE WHEN pos_7d_avg = pp THEN date END) OVER (PARTITION BY state) AS max_pos_date FROM t)
SELECT state, date, positiveIncrease, totalTestResultsIncrease, deathIncrease, hospitalizedCurrently, totaltests_7d, totalpos_7d, lstwk_hosp, change_hosp,
 {r6('pct_positive', 'pos_7d_avg', 'test_7d_avg', 'death_7d_avg', 'pct_pos_7d', 'lstwk_death_7d_avg', 'lstwk_pos_7d_avg', 'lstwk_test_7d_avg',
     'deaths_incr_week', 'pos_incr_week', 'tests_incr_week')},
 round(pd, 6) AS max_deaths, max_death_date, round((death_7d_avg - pd) / nullif(pd, 0), 6) AS perc_decline_fr_death_peak,
 CAST(date - max_death_date AS INTEGER) AS days_since_peak_death,
 round(pp, 6) AS max_pos, max_pos_date, round((pos_7d_avg - pp) / nullif(pp, 0), 6) AS perc_decline_fr_pos_peak,
 CAST(date - max_pos_date AS INTEGER) AS days_since_peak_pos FROM k""",
)
def trend_and_peak(spark: SparkSession, sf: str) -> DataFrame:
    panel = nations_panel(spark, sf).select(
        F.date_format("d", "yyyyMMdd").cast("long").alias("date"),
        F.col("n_name").alias("state"),
        F.col("n_f").alias("positiveIncrease"),
        F.col("n").alias("totalTestResultsIncrease"),
        F.col("n_urgent").alias("deathIncrease"),
        F.col("n_o").alias("hospitalizedCurrently"),
    )
    return rounded(trend.state_trend(panel))


# tests ---------------------------------------------------------------------------------
TESTS_CTE = f"""{TEST_CTE},
 tests2 AS (SELECT *, {ramp_sql('new_tests', S, 'date')} AS new_tests_7d_avg, {ramp_sql('new_tests_positive', S, 'date')} AS new_pos_tests_7d_avg,
     new_tests_positive / nullif(new_tests, 0) AS pct_pos, max(date) OVER (PARTITION BY state) AS last_report_date FROM tests1),
 tests3 AS (SELECT *, {lag_sql('new_pos_tests_7d_avg', 14, S, 'date')} AS new_pos_tests_7d_avg_2wk FROM tests2),
 covered AS (SELECT date, count(*) AS n_states FROM tests1 GROUP BY 1 HAVING count(*) >= 5),
 tests AS (SELECT *, (SELECT max(date) FROM covered) AS test_date FROM tests3 JOIN covered USING (date))"""


def tests(cells: DataFrame) -> DataFrame:
    return testing.tests_by_state(testing.tests_wide(feeds.test_results(cells)))


@query(
    "flow_outcome_feed",
    f"""WITH {TESTS_CTE}
SELECT * REPLACE ({r6('new_tests_7d_avg', 'new_pos_tests_7d_avg', 'new_pos_tests_7d_avg_2wk', 'pct_pos')}) FROM tests""",
)
def outcome_feed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(tests(feeds.order_cells(spark, sf)))


# hospital ------------------------------------------------------------------------------
HOSP_CTE = f"""{HOSPITAL_CTE},
 hosp1 AS (SELECT *, currently_hospitalized - {lag_sql('currently_hospitalized', 1, S, 'date')} AS hosp_change,
     staffed_adult_icu_bed_occupancy - {lag_sql('staffed_adult_icu_bed_occupancy', 1, S, 'date')} AS total_icu_change,
     inpatient_beds_used - {lag_sql('inpatient_beds_used', 1, S, 'date')} AS total_hosp_change,
     {ICU} - {lag_sql(ICU, 1, S, 'date')} AS raw_icu, {ramp_sql('new_admit', S, 'date')} AS new_admit_7d_avg,
     {lag_sql('currently_hospitalized', 7, S, 'date')} AS currently_hospitalized_1wk, {lag_sql('new_admit', 7, S, 'date')} AS adm_1_wk FROM hosp0),
 hosp AS (SELECT * EXCLUDE (raw_icu), CAST(CASE WHEN raw_icu > 500 THEN 500 WHEN raw_icu < -500 THEN -500 ELSE raw_icu END AS DOUBLE) AS icu_change,
     {lag_sql('new_admit_7d_avg', 7, S, 'date')} AS new_admit_avg_1wk FROM hosp1)"""


def beds(cells: DataFrame) -> DataFrame:
    spark = cells.sparkSession
    carry, ranges = hospital.carry_table(spark, feeds.CARRY), hospital.range_table(spark, (feeds.ICU_FIX,))
    return hospital.hospital_panel(*feeds.hospital_feeds(cells), carry=carry, ranges=ranges)


@query("flow_corrected_series", f"WITH {HOSP_CTE} SELECT * REPLACE ({r6('new_admit_7d_avg', 'new_admit_avg_1wk')}) FROM hosp")
def corrected_series(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(beds(feeds.line_cells(spark, sf)))


@query("flow_series_refreshed", f"WITH {HOSP_CTE} SELECT * REPLACE ({r6('new_admit_7d_avg', 'new_admit_avg_1wk')}) FROM hosp")
def series_refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """The same series, published from the long feed and then refreshed with the archives and with the daily file."""
    cells = feeds.line_cells(spark, sf)
    corrections = {"carry": hospital.carry_table(spark, feeds.CARRY), "ranges": hospital.range_table(spark, (feeds.ICU_FIX,))}
    batches = hospital.version_rows(*feeds.hospital_feeds(cells))
    like = union_by_name(batches).schema
    panel = hospital.refreshed_series(spark, f"{shared_folder(spark)}/published/series-{uuid.uuid4().hex}", like)
    for rows in batches:
        panel.apply(hospital.series_batch(rows, like, **corrections))
    return rounded(hospital.read_series(panel, like))


BAND_COLUMNS = [f"{ADULT}_covid_{s}_{b}" for s in ("confirmed", "suspected") for b in feeds.BANDS] + [
    f"{CHILD}_covid_{s}" for s in ("confirmed", "suspected")
]
BAND_CASE = " ".join(f"WHEN ends_with(name, '{b}') THEN '{b.replace('_', ' to ')}'" for b in feeds.BANDS)


@query(
    "flow_band_series",
    f"""WITH {HOSPITAL_CTE},
 u AS (SELECT state, date, name, value FROM (SELECT state, date, {', '.join(BAND_COLUMNS)} FROM hosp0 WHERE {ADULT}_covid_confirmed_60_69 IS NOT NULL)
     UNPIVOT INCLUDE NULLS (value FOR name IN ({', '.join(BAND_COLUMNS)}))),
 b AS (SELECT state, date, CASE {BAND_CASE} ELSE 'pediatric' END AS age_group,
     CASE WHEN contains(name, 'confirmed') THEN 'confirmed' ELSE 'suspected' END AS status, value AS prev_day_admissions FROM u)
SELECT *, round({ramp_sql('prev_day_admissions', 'state, age_group, status', 'date')}, 6) AS adm_7d_avg FROM b""",
)
def band_series(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(hospital.admissions_by_age(beds(feeds.line_cells(spark, sf))))


# federal panel --------------------------------------------------------------------------
STEPS = (("1996-08-01", 0.0), ("1997-11-28", 0.006), ("1998-12-05", 0.08), ("1999-12-12", 0.379), ("2000-06-19", 0.77), ("2001-01-23", 0.999))
FULL = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def known_sql(c: str) -> str:
    return f"coalesce({c}, last_value({c} IGNORE NULLS) OVER (PARTITION BY state ORDER BY date {FULL}))"


def history(spark: SparkSession, panel: DataFrame) -> DataFrame:
    """Snapshots as the runs at the end of each year would have left them; the last run was started twice."""
    per_year = panel.groupBy("state", F.year("date").alias("y")).agg(
        F.coalesce(F.sum("new_tests"), F.lit(0)).alias("t"), F.coalesce(F.sum("new_tests_positive"), F.lit(0)).alias("p"), F.max("date").alias("date")
    )
    runs = per_year.select("state", running(federal.PANEL, "t").alias("total_tests"), running(federal.PANEL, "p").alias("total_pos_tests"), "date")
    return testing.history_changes(testing.accumulate(runs, testing.snapshot_totals(panel)))


HISTORY_CTE = """
 years AS (SELECT state, year(date) AS y, coalesce(sum(new_tests), 0) AS t, coalesce(sum(new_tests_positive), 0) AS p, max(date) AS date FROM tests GROUP BY 1, 2),
 runs AS (SELECT state, date, CAST(sum(t) OVER w AS BIGINT) AS total_tests, CAST(sum(p) OVER w AS BIGINT) AS total_pos_tests FROM years
     WINDOW w AS (PARTITION BY state ORDER BY date)),
 hist AS (SELECT *, total_tests - lag(total_tests) OVER w AS new_reported_tests, total_pos_tests - lag(total_pos_tests) OVER w AS new_reported_pos_tests
     FROM runs WINDOW w AS (PARTITION BY state ORDER BY date))"""

CASE_LAGS = ", ".join(f"{lag_sql('new_case_7d_avg', 7 * w, S, 'date')} AS case_7d_avg_{w}_wks" for w in (1, 2, 3, 4))
STEP_SQL = "CASE " + " ".join(f"WHEN date >= DATE '{d}' THEN {p}::DOUBLE" for d, p in reversed(STEPS)) + " END"


@query(
    "flow_federal_panel",
    f"""WITH {TESTS_CTE}, {HOSP_CTE}, {CASES_CTE}, {VAX_CTE}, {HISTORY_CTE},
 cases1 AS (SELECT *, tot_death - {lag_sql('tot_death', 1, S, 'date')} AS new_death_cdc, tot_cases - {lag_sql('tot_cases', 1, S, 'date')} AS new_case_tot FROM cases0),
 cases2 AS (SELECT *, {ramp_sql('new_case', S, 'date')} AS new_case_7d_avg, {ramp_sql('new_death', S, 'date')} AS new_death_7d_avg,
     {ramp_sql('new_death_cdc', S, 'date')} AS new_death_7d_avg_cdc, {ramp_sql('new_case_tot', S, 'date')} AS new_case_tot_7d_avg_cdc,
     {lag_sql('new_case', 7, S, 'date')} AS case_1_wk FROM cases1),
 cases3 AS (SELECT *, {CASE_LAGS} FROM cases2),
 cdays AS (SELECT date, count(*) AS n_states_cases FROM cases0 GROUP BY 1 HAVING count(*) >= 5),
 cases AS (SELECT *, (SELECT max(date) FROM cdays) AS case_death_date FROM cases3 JOIN cdays USING (date)),
 full3 AS (SELECT * FROM cases FULL JOIN (SELECT * RENAME (n_states AS n_states_tests) FROM tests) USING (state, date) FULL JOIN hosp USING (state, date)),
 base AS (SELECT * FROM full3 LEFT JOIN hist USING (state, date) LEFT JOIN vax USING (state, date)),
 place AS (SELECT base.* EXCLUDE (test_date, new_tests_7d_avg, new_pos_tests_7d_avg, new_pos_tests_7d_avg_2wk, pct_pos, new_tests, new_tests_positive),
     (SELECT max(test_date) FROM base) AS test_date, (SELECT max(date) FROM base) AS hosp_date,
     new_tests AS new_tests2, new_tests_positive AS new_tests_positive2,
     CASE WHEN new_tests IS NULL AND date <= (SELECT max(test_date) FROM base) THEN 0 ELSE new_tests END AS new_tests,
     CASE WHEN new_tests_positive IS NULL AND date <= (SELECT max(test_date) FROM base) THEN 0 ELSE new_tests_positive END AS new_tests_positive,
     {known_sql('currently_hospitalized')} AS last_hosp, {known_sql('new_case_7d_avg')} AS last_case_7d, {known_sql('new_death_7d_avg')} AS last_death_7d,
     {STEP_SQL} AS omi_pct FROM base),
 again AS (SELECT *, {ramp_sql('new_tests', S, 'date')} AS new_tests_7d_avg, {ramp_sql('new_tests_positive', S, 'date')} AS new_pos_tests_7d_avg,
     CASE WHEN new_tests = 0 THEN 0.0 ELSE new_tests_positive / nullif(new_tests, 0) END AS pct_pos FROM place),
 people AS (SELECT n_name AS state, count(*) * 1000 AS population FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey <> 0 GROUP BY 1),
 lands AS (SELECT n_name AS state, 'Land of ' || n_name AS state_name, r_name AS region, n_nationkey AS hex_x, n_regionkey AS hex_y
     FROM nation JOIN region ON r_regionkey = n_regionkey),
 wide AS (SELECT *, coalesce(population, 0) AS pop0, {lag_sql('new_pos_tests_7d_avg', 14, S, 'date')} AS new_pos_tests_7d_avg_2wk
     FROM again LEFT JOIN people USING (state) LEFT JOIN lands USING (state))
SELECT * EXCLUDE (pop0) REPLACE (pop0 AS population, {r6('new_case_7d_avg', 'new_death_7d_avg', 'new_death_7d_avg_cdc', 'new_case_tot_7d_avg_cdc',
     *[f'case_7d_avg_{w}_wks' for w in (1, 2, 3, 4)], 'new_tests_7d_avg', 'new_pos_tests_7d_avg', 'new_pos_tests_7d_avg_2wk', 'pct_pos',
     'new_admit_7d_avg', 'new_admit_avg_1wk', 'last_case_7d', 'last_death_7d')}),
 case_death_date - 7 AS one_wk_ago, case_death_date - 14 AS two_wks_ago,
 CASE WHEN date = hosp_date THEN 'Yes' ELSE 'No' END AS max_date_ind, CASE WHEN date + 7 > hosp_date THEN 'Y' ELSE 'N' END AS lst_wk_flag,
 'Trump' AS elect20, CAST(year(date) AS INTEGER) AS year, strftime(date, '%b') AS month, CAST(month(date) AS INTEGER) AS month_num,
 CAST(day(date) AS INTEGER) AS day, year(date) || '-' || strftime(date, '%b') || '-' || day(date) AS display_date,
 round(new_case_7d_avg * omi_pct, 6) AS omi_cases, round(new_case_7d_avg * (1 - omi_pct), 6) AS delta_cases
FROM wide""",
)
def federal_state(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = feeds.order_cells(spark, sf), feeds.line_cells(spark, sf)
    by_test = staged(tests(orders), "tests")
    census, population, hexes = feeds.state_places(spark, sf)
    panel = federal.federal_panel(
        federal.cases_and_deaths(feeds.cases_deaths(orders)),
        by_test,
        beds(lines),
        history(spark, by_test),
        federal.vaccination(feeds.state_vaccination(lines)),
        census,
        population,
        hexes,
        STEPS,
    )
    return rounded(panel)


# peak-indexed series ------------------------------------------------------------------------
def index_source(spark: SparkSession, sf: str) -> DataFrame:
    """Ramp means of orders beside shipments, by state and day."""
    orders = rename(nations_panel(spark, sf), {"state": "n_name", "date": "d"})
    means = orders.select(
        "state", "date", federal.PANEL.rolling_mean("n").alias("new_case_7d_avg"), federal.PANEL.rolling_mean("n_f").alias("new_death_7d_avg")
    )
    ships = rename(shipments_panel(spark, sf), {"state": "n_name", "date": "d", "currently_hospitalized": "shipped", ICU: "returned"})
    return means.join(ships.drop("qty"), ["state", "date"], "full")


def index_sql(side: str, where: str, start: str, shown: str) -> str:
    shares = ", ".join(
        f"{c} / nullif((SELECT max({c}) FROM t WHERE date {side}), 0) AS \"{n}\""
        for n, c in (("Cases", "nc"), ("Deaths", "nd"), ("Hospitalized", "ch"), ("ICU", "icu"))
    )
    return f"""
WITH a AS (SELECT n_name, d, {ramp_sql('n', 'n_name')} AS nc, {ramp_sql('n_f', 'n_name')} AS nd FROM ({NATIONS_SQL})),
 b AS (SELECT n_name, d, shipped, returned FROM ({SHIPMENTS_SQL})),
 f AS (SELECT n_name AS state, d AS date, nc, nd, shipped, returned FROM a FULL JOIN b USING (n_name, d)),
 m AS (SELECT state, date, nc, nd, {ramp_sql('shipped', 'state', 'date')} AS ch, {ramp_sql('returned', 'state', 'date')} AS icu FROM f
     WHERE date >= DATE '{start}' {where}),
 t AS (SELECT date, {', '.join(f'coalesce(sum({c}), 0) AS {c}' for c in ('nc', 'nd', 'ch', 'icu'))} FROM m GROUP BY 1),
 s AS (SELECT date, {shares} FROM t)
SELECT date, name, round(value, 6) AS value FROM s UNPIVOT (value FOR name IN ("Cases", "Deaths", "Hospitalized", "ICU"))
WHERE value <> 0 AND date >= DATE '{shown}'"""


@query("peak_indexed_series", index_sql("<= DATE '1999-12-01'", "", "1996-04-01", "1998-07-01"))
def peak_indexed_series(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(peaks.peak_index(index_source(spark, sf), "1998-07-01", None, False, "1996-04-01", "1999-12-01", 1997))


@query("peak_indexed_series_later", index_sql(">= DATE '1999-12-01'", "AND state = 'NATION_5'", "1996-04-01", "1999-09-01"))
def peak_indexed_series_later(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(peaks.peak_index(index_source(spark, sf), "1999-09-01", ["NATION_5"], True, "1996-04-01", "1999-12-01", 1997))


# nursing homes --------------------------------------------------------------------------------
@query(
    "flow_nursing_weekly",
    f"""WITH {NURSING_CTE} SELECT * EXCLUDE (week), strftime(week, '%m/%d/%Y') AS week_ending, (SELECT max(week) FROM weekly) AS max_date FROM weekly""",
)
def nursing_weekly(spark: SparkSession, sf: str) -> DataFrame:
    return nursing.weekly_totals(feeds.nursing_homes(spark, sf))


@query(
    "weekly_totals_vs_all",
    f"""WITH {NURSING_CTE}, {CASES_CTE},
 j AS (SELECT provider_state AS state, week AS date, new_covid_deaths, tot_death FROM weekly LEFT JOIN cases0 ON state = provider_state AND date = week),
 n AS (SELECT *, CAST(row_number() {over(S, 'date')} AS INTEGER) AS n FROM j)
SELECT state, date, tot_death, n, CASE WHEN n > 1 THEN tot_death - {lag_sql('tot_death', 1, S, 'date')} END AS new_deaths_all,
 CASE WHEN n > 1 THEN new_covid_deaths END AS new_deaths_nh FROM n""",
)
def weekly_totals_vs_all(spark: SparkSession, sf: str) -> DataFrame:
    weekly = nursing.weekly_totals(feeds.nursing_homes(spark, sf))
    return nursing.against_all_deaths(weekly, feeds.cases_deaths(feeds.order_cells(spark, sf)))


# reports -----------------------------------------------------------------------------------------
@query(
    "flow_quality_report",
    f"""{COUNTY_SQL}, {TEST_CTE},
 r AS (SELECT 'county counters' AS "check", (SELECT count(*) FROM counters) + (SELECT count(*) FROM counters WHERE cases = 1) AS n_rows,
       (SELECT count(*) FROM counters) AS n_distinct
   UNION ALL SELECT 'state and day of cases', (SELECT count(*) FROM ({NATIONS_SQL})), (SELECT count(*) FROM ({NATIONS_SQL}))
   UNION ALL SELECT 'state and day of tests', (SELECT count(*) FROM feed), (SELECT count(*) FROM tests1))
SELECT *, round(n_distinct / n_rows, 6) AS uniqueness FROM r""",
)
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    cells = feeds.order_cells(spark, sf)
    return rounded(
        reports.uniqueness(
            {
                "county counters": (feeds.county_counters(spark, sf, feeds.customers_of_nations(spark, sf)), None),
                "state and day of cases": (feeds.cases_deaths(cells), ["state", "submission_date"]),
                "state and day of tests": (feeds.test_results(cells), ["state", "date"]),
            }
        )
    )
