"""Series shown as a share of their peak, before or from a given day."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.missing import sum_or_zero
from ..operators.filters import not_zero, only_entities
from ..operators.panel import Panel
from ..operators.reshape import lengthen
from ..sources.staging import staged
from . import constants as k
from .hospital import ICU

PANEL = Panel(("state",), "date")
SERIES = {"Cases": "new_case_7d_avg", "Deaths": "new_death_7d_avg", "Hospitalized": "currently_hospitalized", "ICU": "icu_7d"}


def daily_totals(df: DataFrame, states: Iterable[str] | None, start: str) -> DataFrame:
    """Per day over the chosen states: the two given means, and ramp means of the two hospital series."""
    rows = only_entities(df, "state", states).where(F.col("date") >= F.lit(start).cast("date"))
    means = rows.select(
        "state",
        "date",
        "new_case_7d_avg",
        "new_death_7d_avg",
        PANEL.rolling_mean("currently_hospitalized").alias("currently_hospitalized"),
        PANEL.rolling_mean(ICU).alias("icu_7d"),
    )
    return means.groupBy("date").agg(*[sum_or_zero(c).alias(c) for c in SERIES.values()])


def peak_index(
    df: DataFrame,
    filter_date: str,
    states: Iterable[str] | None = None,
    later_peak: bool = False,
    start: str = k.INDEX_FROM,
    regime_day: str = k.REGIME_DAY,
    after_year: int = k.INDEX_SHOWN_AFTER_YEAR,
) -> DataFrame:
    """Long table (date, name, value): each series over its own peak up to `regime_day`, or from it on.

    The totals have one row per day and are written down, as both the series and
    their peaks read them. The peaks are one row of four maxima, taken as one
    scalar subquery.
    """
    totals = staged(daily_totals(df, states, start), "daily_totals")
    split = F.lit(regime_day).cast("date")
    side = F.col("date") >= split if later_peak else F.col("date") <= split
    peaks = totals.agg(F.struct(*[F.max(F.when(side, F.col(c))).alias(c) for c in SERIES.values()])).scalar()
    held = totals.withColumn("_peak", peaks)
    index = held.select("date", *[F.try_divide(F.col(c).cast("double"), F.col(f"_peak.{c}").cast("double")).alias(n) for n, c in SERIES.items()])
    long = not_zero(lengthen(index, ["date"], list(SERIES)), "value")
    return long.where((F.year("date") > after_year) & (F.col("date") >= F.lit(filter_date).cast("date")))
