"""Nursing homes: weekly totals per state, and their deaths beside all deaths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ANY_FORMATS, US, parse_date
from ..functions.missing import sum_or_zero
from ..operators.dedupe import first_per_key
from ..operators.enrich import left_join_feeds
from ..operators.filters import latest_of
from ..operators.panel import Panel

PANEL = Panel(("state",), "date")
MEASURES = {
    "n_residents": "total_number_of_occupied_beds",
    "new_hosp_covid": "residents_weekly_admissions_covid_19",
    "new_covid_deaths": "residents_weekly_covid_19_deaths",
    "new_covid_cases": "residents_weekly_confirmed_covid_19",
    "total_covid_deaths": "residents_total_covid_19_deaths",
    "total_covid_cases": "residents_total_confirmed_covid_19",
    "total_covid_hosp": "residents_total_admissions_covid_19",
}


def _day(df: DataFrame, name: str, formats) -> Column:
    return parse_date(name, formats) if dict(df.dtypes)[name] == "string" else F.col(name)


def weekly_totals(facilities: DataFrame) -> DataFrame:
    """One map-side combined aggregate; the latest week comes from a one-column scan."""
    sums = facilities.groupBy("provider_state", "week_ending").agg(*[sum_or_zero(c).alias(n) for n, c in MEASURES.items()])
    weeks = facilities.select(_day(facilities, "week_ending", US).alias("week"))
    return sums.withColumn("max_date", latest_of(weeks, "week"))


def against_all_deaths(weekly: DataFrame, all_deaths: DataFrame) -> DataFrame:
    """Deaths in homes and in all per state and week; the first week of a state is masked."""
    cdc = all_deaths.select("tot_death", "state", _day(all_deaths, "submission_date", ANY_FORMATS).alias("date"))
    cdc = first_per_key(cdc, ["state", "date"], [F.col("tot_death").desc_nulls_last()])
    homes = weekly.select(
        F.col("new_covid_deaths").alias("new_deaths_nh"),
        F.col("provider_state").alias("state"),
        _day(weekly, "week_ending", ANY_FORMATS).alias("date"),
    )
    both = left_join_feeds(homes, cdc, ["state", "date"])
    return both.select(
        "state",
        "date",
        "tot_death",
        PANEL.position().alias("n"),
        PANEL.mask_first(PANEL.delta("tot_death")).alias("new_deaths_all"),
        PANEL.mask_first("new_deaths_nh").alias("new_deaths_nh"),
    )
