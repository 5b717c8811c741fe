"""Build the extracts from a landing folder.

    python -m tidewatch.plans.run LANDING OUT [county strict trend federal ages nursing reports history]

`history` also takes in the snapshots of an earlier system, from test_history.csv.
"""

from __future__ import annotations

import os
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import parse_date
from ..operators.quality import frequency
from ..schemas import TEST_HISTORY
from ..sources.delimited import typed
from ..sources.extracts import publish_version, write_extract, write_table
from ..sources.landing import Landing
from ..sources.staging import staged, staging
from . import county, federal, hospital, nursing, reports, testing, trend

COUNTY_FEEDS = (
    "county_counters", "county_population", "metro_crosswalk", "density", "census_regions", "election_2016", "election_2020",
    "county_vaccination",
)


SNAPSHOT = ("state", "total_tests", "total_pos_tests", "date")
SNAPSHOT_SCHEMA = "state string, total_tests double, total_pos_tests double, date date"


def stored_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshots kept so far; none before the first run."""
    try:
        return spark.read.schema(SNAPSHOT_SCHEMA).parquet(folder).select(*SNAPSHOT)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SNAPSHOT_SCHEMA)


def keep_snapshots(new: DataFrame, folder: str) -> None:
    """Append the snapshots that are not stored yet; nothing is rewritten, and a repeated run adds nothing."""
    typed_ = new.select(*[F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(SNAPSHOT_SCHEMA)])
    staged(typed_.subtract(stored_snapshots(new.sparkSession, folder)), "snapshots").write.mode("append").parquet(folder)


def imported_history(raw: DataFrame) -> DataFrame:
    """History kept as text by an earlier system."""
    return typed(raw, TEST_HISTORY).withColumn("date", parse_date("date")).select(*SNAPSHOT)


def federal_extracts(feeds: Landing, out: str, wanted: set[str]) -> dict[str, DataFrame]:
    """Reads the stored snapshots but adds none: `snapshots`, today's and the imported ones, are kept by main."""
    spark = feeds.spark
    beds = staged(hospital.hospital_panel(feeds["hospital_series"], feeds["hospital_archives"], feeds["hospital_daily"]), "hospital")
    made = {"admissions_ages": hospital.admissions_by_age(beds)} if "ages" in wanted else {}
    if "federal" not in wanted:
        return made
    tests = staged(testing.tests_by_state(testing.tests_wide(feeds["test_results"])), "tests")
    new = testing.snapshot_totals(tests).select(*SNAPSHOT)
    if "history" in wanted:
        new = imported_history(feeds["test_history"]).unionByName(new)
    new = staged(new, "new_snapshots")
    history = testing.history_changes(testing.accumulate(stored_snapshots(spark, f"{out}/snapshots"), new))
    panel = federal.federal_panel(
        federal.cases_and_deaths(feeds["cases_deaths"]), tests, beds, history, federal.vaccination(feeds["state_vaccination"]),
        feeds["census_regions"], feeds["state_population"], feeds["hex_grid"],
    )
    if "reports" in wanted:
        panel = staged(panel, "federal_state")  # the reports read what is published
    made |= {"snapshots": new, "federal_state": panel}
    if "reports" in wanted:
        made["freshness"] = reports.federal_freshness(panel, beds)
        made["hospital_last_week"] = reports.last_week(beds, "date", "currently_hospitalized").withColumnRenamed("date", "day")
    return made


def county_checks(feeds: Landing) -> DataFrame:
    """Whether the feeds hold a key once: whole counter rows, counties and days, votes, states and days."""
    return reports.uniqueness(
        {
            "county counters": (feeds["county_counters"], None),
            "county and day": (feeds["county_counters"], ["state", "county", "date"]),
            "metro crosswalk": (feeds["metro_crosswalk"], None),
            "election 2016": (feeds["election_2016"], None),
            "election 2020": (feeds["election_2020"], ["fips5", "lname"]),
        }
    )


def extracts(feeds: Landing, out: str, wanted: set[str]) -> dict[str, DataFrame]:
    made: dict[str, DataFrame] = {}
    if "county" in wanted:
        made["county_panel"] = county.county_panel(feeds.load(*COUNTY_FEEDS))
        if "reports" in wanted:
            made["county_panel"] = staged(made["county_panel"], "county_panel")  # the reports read what is published
            made["uniqueness"] = county_checks(feeds)
            made["rows_by_state"] = frequency(made["county_panel"], "stname")
    if "strict" in wanted:
        made["county_panel_strict"] = county.county_panel_strict(feeds.load(*COUNTY_FEEDS))
    if "trend" in wanted:
        made["state_trend"] = trend.state_trend(feeds["state_tracking"])
    if wanted & {"federal", "ages"}:
        made |= federal_extracts(feeds, out, wanted)
    if "nursing" in wanted:
        weekly = nursing.weekly_totals(feeds["nursing_homes"])
        made["nursing_weekly"] = weekly
        made["nursing_and_all_deaths"] = nursing.against_all_deaths(weekly, feeds["cases_deaths"])
    return made


def publish(df: DataFrame, out: str, name: str) -> None:
    """A daily panel becomes a table by year first; its flat extract is then read from there.

    Each is written as a new version and named current when it is complete.
    """
    if "date" in df.columns:
        table = publish_version(df, os.path.join(out, "tables", name), lambda rows, folder: write_table(rows, folder, "date"))
        df = df.sparkSession.read.schema(df.schema).parquet(table)
    publish_version(df, os.path.join(out, name), write_extract)


def main(landing: str, out: str, wanted: set[str] | None = None) -> None:
    spark = SparkSession.builder.config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    wanted = wanted or {"county", "strict", "trend", "federal", "ages", "nursing", "reports"}
    with staging(spark):
        made = extracts(Landing(spark, landing), out, wanted)
        new = made.pop("snapshots", None)
        for name, df in made.items():
            publish(df, out, name)
        if new is not None:  # last: a run that fails before it can be run again
            keep_snapshots(new, f"{out}/snapshots")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], set(sys.argv[3:]) or None)
