"""State by day: cases and deaths, tests, hospital, vaccination, places, imputation, variant split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import US, calendar_parts, in_last_week, is_latest, parse_date
from ..functions.missing import default_to, is_in, ratio_or_zero, split_by_share
from ..functions.names import rename
from ..operators.dedupe import first_per_key
from ..operators.enrich import full_join_feeds, left_join_feeds, lookup, overridden, step_value
from ..operators.filters import covered_days, latest_of, min_coverage
from ..operators.panel import Panel, zero_fill
from ..sources.staging import staged
from . import constants as k

PANEL = Panel(("state",), "date")
KEY = ["state", "date"]


def cases_and_deaths(raw: DataFrame, min_states: int = k.MIN_REPORTING) -> DataFrame:
    """Changes of both counters, ramp means and four weekly lags, on days that enough states report."""
    day = parse_date("submission_date", US) if dict(raw.dtypes)["submission_date"] == "string" else F.col("submission_date")
    feed = raw.select("tot_cases", "tot_death", "new_case", "new_death", "state", day.alias("date"))
    measures = [F.col(c).desc_nulls_last() for c in ("tot_cases", "tot_death", "new_case", "new_death")]
    panel = first_per_key(feed, KEY, measures).withColumns(
        {"new_death_cdc": PANEL.delta("tot_death"), "new_case_tot": PANEL.delta("tot_cases")}
    )
    panel = panel.withColumns(
        {
            "new_case_7d_avg": PANEL.rolling_mean("new_case"),
            "new_death_7d_avg": PANEL.rolling_mean("new_death"),
            "new_death_7d_avg_cdc": PANEL.rolling_mean("new_death_cdc"),
            "new_case_tot_7d_avg_cdc": PANEL.rolling_mean("new_case_tot"),
            "case_1_wk": PANEL.lag("new_case", 7),
        }
    )
    panel = panel.withColumns({f"case_7d_avg_{w}_wks": PANEL.lag("new_case_7d_avg", 7 * w) for w in (1, 2, 3, 4)})
    days = covered_days(feed.select(*KEY).distinct(), "date", min_states)
    covered = min_coverage(panel, "date", days=days).withColumn("case_death_date", latest_of(days, "date"))
    return covered.withColumns({"one_wk_ago": F.date_sub("case_death_date", 7), "two_wks_ago": F.date_sub("case_death_date", 14)})


def vaccination(raw: DataFrame) -> DataFrame:
    day = parse_date("date") if dict(raw.dtypes)["date"] == "string" else F.col("date")
    return rename(raw, {"state": "location"}).withColumn("date", day)


def regions(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("state").alias("state_name"), F.col("state_code").alias("state"), "region")


def merged(cases: DataFrame, tests: DataFrame, hospital: DataFrame, history: DataFrame, vax: DataFrame) -> DataFrame:
    """Three feeds in full, two more where they fit. All shuffle by (state, date) only.

    Of several snapshots with the same latest day the fullest is joined, and of several
    vaccination rows of a state and day the highest, so no row fans out.
    """
    tests = tests.withColumnRenamed("n_states", "n_states_tests")
    cases = cases.withColumnRenamed("n_states", "n_states_cases")
    full = full_join_feeds([cases, tests, hospital], KEY)
    history = first_per_key(history, KEY, [F.col("total_tests").desc_nulls_last(), F.col("total_pos_tests").desc_nulls_last()])
    shares = [F.col(c).desc_nulls_last() for c in sorted(set(vax.columns) - set(KEY))]
    return left_join_feeds(left_join_feeds(full, history, KEY, unique=True), first_per_key(vax, KEY, shares), KEY, unique=True)


def places(df: DataFrame, census: DataFrame, population: DataFrame, hexes: DataFrame) -> DataFrame:
    df = lookup(df, regions(census), "state")
    df = df.withColumn("region", overridden("region", "state", {k.NYC_STATE_CODE: k.NYC_REGION}))
    df = lookup(df, population.select("state", "population"), "state")
    return lookup(df.withColumn("population", default_to("population", 0)), hexes, "state")


def imputed(df: DataFrame) -> DataFrame:
    """Last known values by date, zero tests inside the reporting window, refreshed test means."""
    df = df.withColumn("test_date", latest_of(df, "test_date"))
    df = df.withColumns(
        {
            "last_hosp": PANEL.last_known("currently_hospitalized"),
            "last_case_7d": PANEL.last_known("new_case_7d_avg"),
            "last_death_7d": PANEL.last_known("new_death_7d_avg"),
        }
    )
    df = df.withColumns(
        {
            "new_tests2": F.col("new_tests"),
            "new_tests_positive2": F.col("new_tests_positive"),
            "new_tests": zero_fill("new_tests", "date", F.col("test_date")),
            "new_tests_positive": zero_fill("new_tests_positive", "date", F.col("test_date")),
        }
    )
    df = df.withColumns(
        {
            "new_tests_7d_avg": PANEL.rolling_mean("new_tests"),
            "new_pos_tests_7d_avg": PANEL.rolling_mean("new_tests_positive"),
            "pct_pos": ratio_or_zero("new_tests_positive", "new_tests"),
        }
    )
    return df.withColumn("new_pos_tests_7d_avg_2wk", PANEL.lag("new_pos_tests_7d_avg", 14))


def flagged(df: DataFrame, newest: Column) -> DataFrame:
    won = F.when(is_in("state", [k.NO_VOTE]), F.lit("NA")).when(is_in("state", k.STATES_2020), F.lit(k.PARTY_A)).otherwise(F.lit(k.PARTY_B))
    return df.withColumn("hosp_date", newest).withColumns(
        {
            "max_date_ind": is_latest("date", "hosp_date"),
            "lst_wk_flag": in_last_week("date", "hosp_date"),
            "elect20": won,
            **calendar_parts("date"),
        }
    )


def with_variant(df: DataFrame, steps=tuple(k.VARIANT_STEPS)) -> DataFrame:
    share = df.withColumn("omi_pct", step_value("date", list(steps)))
    new, old = split_by_share("new_case_7d_avg", "omi_pct")
    return share.withColumns({"omi_cases": new, "delta_cases": old})


def federal_panel(
    cases: DataFrame,
    tests: DataFrame,
    hospital: DataFrame,
    history: DataFrame,
    vax: DataFrame,
    census: DataFrame,
    population: DataFrame,
    hexes: DataFrame,
    steps=tuple(k.VARIANT_STEPS),
) -> DataFrame:
    """The merged panel is written once; its latest days and windows are then read from that table."""
    base = staged(merged(cases, tests, hospital, history, vax), "federal")
    full = places(imputed(base), census, population, hexes)
    return with_variant(flagged(full, latest_of(base, "date")), steps)
