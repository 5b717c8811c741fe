"""State trend: strict 7-day means and totals, weekly change, and whether the state has peaked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import COMPACT, parse_date
from ..functions.missing import ratio
from ..functions.names import select_present
from ..operators.dedupe import first_per_key
from ..operators.panel import Panel, with_peak
from ..schemas import STATE_TRACKING

PANEL = Panel(("state",), "date")


def state_trend(tracking: DataFrame) -> DataFrame:
    """All windows share one shuffle by state."""
    feed = select_present(tracking, list(STATE_TRACKING)).withColumn("date", parse_date("date", COMPACT))
    feed = first_per_key(feed, ["state", "date"], [F.col(c).desc_nulls_last() for c in feed.columns if c not in ("state", "date")])
    feed = feed.withColumn("pct_positive", ratio("positiveIncrease", "totalTestResultsIncrease"))
    means = feed.withColumns(
        {
            "pos_7d_avg": PANEL.rolling_mean("positiveIncrease", mode="strict"),
            "test_7d_avg": PANEL.rolling_mean("totalTestResultsIncrease", mode="strict"),
            "death_7d_avg": PANEL.rolling_mean("deathIncrease", mode="strict"),
            "totaltests_7d": PANEL.rolling_total("totalTestResultsIncrease"),
            "totalpos_7d": PANEL.rolling_total("positiveIncrease"),
        }
    )
    trend = means.withColumns(
        {
            "pct_pos_7d": ratio("totalpos_7d", "totaltests_7d"),
            "lstwk_death_7d_avg": PANEL.lag("death_7d_avg", 7),
            "lstwk_pos_7d_avg": PANEL.lag("pos_7d_avg", 7),
            "lstwk_test_7d_avg": PANEL.lag("test_7d_avg", 7),
            "lstwk_hosp": PANEL.lag("hospitalizedCurrently", 7),
            "change_hosp": PANEL.delta("hospitalizedCurrently"),
            "deaths_incr_week": PANEL.change("death_7d_avg"),
            "pos_incr_week": PANEL.change("pos_7d_avg"),
            "tests_incr_week": PANEL.change("test_7d_avg"),
        }
    )
    deaths = with_peak(trend, PANEL, "death_7d_avg", "max_deaths", "max_death_date", "perc_decline_fr_death_peak", "days_since_peak_death")
    return with_peak(deaths, PANEL, "pos_7d_avg", "max_pos", "max_pos_date", "perc_decline_fr_pos_peak", "days_since_peak_pos")
