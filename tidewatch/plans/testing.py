"""Tests by state and day, and the history of what each run reported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ANY_FORMATS, parse_date
from ..functions.missing import add_all, ratio, sum_or_zero
from ..operators.filters import covered_days, latest_of, min_coverage
from ..operators.panel import Panel
from ..operators.reshape import names_of, widen
from . import constants as k

PANEL = Panel(("state",), "date")
OUTCOMES = ("Positive", "Negative", "Inconclusive")


def outcome_feed(raw: DataFrame, formats: Sequence[str] = ANY_FORMATS) -> DataFrame:
    day = parse_date("date", formats) if dict(raw.dtypes)["date"] == "string" else F.col("date")
    return raw.select(
        "state",
        F.col("overall_outcome").alias("type"),
        day.alias("date"),
        F.col("new_results_reported").alias("new_tests"),
        F.col("total_results_reported").alias("total_tests"),
    )


def tests_wide(raw: DataFrame, outcomes: Sequence[str] | None = None) -> DataFrame:
    """A column per outcome: the known ones always, and any other that the feed holds."""
    feed = outcome_feed(raw)
    names = [*OUTCOMES, *(n for n in names_of(feed, "type") if n not in OUTCOMES)] if outcomes is None else outcomes
    return widen(feed, ["state", "date"], "type", ["new_tests", "total_tests"], names)


def tests_by_state(wide: DataFrame, min_states: int = k.MIN_REPORTING) -> DataFrame:
    """Ramp means and positivity, on days that enough states report."""
    panel = (
        wide.withColumn("new_tests", add_all("new_tests_negative", "new_tests_positive"))
        .withColumns(
            {
                "new_tests_7d_avg": PANEL.rolling_mean("new_tests"),
                "new_pos_tests_7d_avg": PANEL.rolling_mean("new_tests_positive"),
                "pct_pos": ratio("new_tests_positive", "new_tests"),
                "last_report_date": PANEL.max("date"),
            }
        )
        .withColumn("new_pos_tests_7d_avg_2wk", PANEL.lag("new_pos_tests_7d_avg", 14))
    )
    days = covered_days(wide, "date", min_states)
    return min_coverage(panel, "date", days=days).withColumn("test_date", latest_of(days, "date"))


def snapshot_totals(tests: DataFrame) -> DataFrame:
    """What today's run reports in total per state."""
    return tests.groupBy("state").agg(
        sum_or_zero("new_tests").alias("total_tests"),
        sum_or_zero("new_tests_positive").alias("total_pos_tests"),
        F.max("date").alias("date"),
    )


def history_changes(history: DataFrame) -> DataFrame:
    """Newly reported tests between snapshots of a state."""
    panel = Panel(("state",), "date", ties=("total_tests", "total_pos_tests"))
    return history.withColumns(
        {
            "new_reported_tests": panel.delta("total_tests"),
            "new_reported_pos_tests": panel.delta("total_pos_tests"),
        }
    )


def accumulate(history: DataFrame | None, today: DataFrame) -> DataFrame:
    """History with today's snapshot added; exact repeats count once."""
    both = today if history is None else history.unionByName(today)
    return both.distinct()
