"""Date parsing, arithmetic, flags and calendar parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import col

ISO = "yyyy-M-d"
US = "M/d/yyyy"
COMPACT = "yyyyMMdd"
YEAR_FIRST = (ISO, "yyyy/M/d", COMPACT)
ANY_FORMATS = (*YEAR_FIRST, US, "d-MMM-yyyy")

# What a text must look like for a format to be tried on it. Without this test
# every misfit costs an exception inside the parser.
SHAPES = {
    ISO: r"^\d{4}-\d{1,2}-\d{1,2}$",
    "yyyy/M/d": r"^\d{4}/\d{1,2}/\d{1,2}$",
    COMPACT: r"^\d{8}$",
    US: r"^\d{1,2}/\d{1,2}/\d{4}$",
    "d-MMM-yyyy": r"^\d{1,2}-[A-Za-z]{3}-\d{4}$",
}


# A time of day after a date, with or without zone.
TIME = r"(T|\s+)\d{1,2}:\d{2}.*$"


def parse_date(c: Column | str, formats: str | Sequence[str] = YEAR_FIRST) -> Column:
    """Text to date by the first declared format that fits, whatever time follows it; else missing."""
    text = F.trim(col(c).cast("string"))
    text = F.when(text.contains(":"), F.regexp_replace(text, TIME, "")).otherwise(text)
    tries = []
    for f in [formats] if isinstance(formats, str) else formats:
        parsed = F.try_to_date(text, f)
        tries.append(F.when(text.rlike(SHAPES[f]), parsed) if f in SHAPES else parsed)
    return F.coalesce(*tries)


def date_head(c: Column | str, formats: str | Sequence[str] = US, width: int = 10) -> Column:
    """Date held in the first characters of a longer text."""
    return parse_date(F.substring(col(c), 1, width), formats)


def yes_no(condition: Column, yes: str = "Yes", no: str = "No") -> Column:
    """Flag text; missing when the condition is missing."""
    return F.when(condition, F.lit(yes)).when(~condition, F.lit(no))


def is_latest(day: Column | str, latest: Column | str) -> Column:
    return yes_no(col(day) == col(latest))


def in_last_week(day: Column | str, latest: Column | str) -> Column:
    return yes_no(F.date_add(col(day), 7) > col(latest), "Y", "N")


def weekday(day: Column | str) -> Column:
    return F.date_format(col(day), "EEEE")


def as_of_columns(day: str, latest: str = "max_date") -> dict[str, Column]:
    """The dates one and two weeks before the latest date, and the flags against it.

    The latest date is a column, not an expression: a scalar subquery is then
    planned once and not once per flag.
    """
    return {
        "one_week_date": F.date_sub(latest, 7),
        "two_week_date": F.date_sub(latest, 14),
        "max_date_ind": is_latest(day, latest),
        "weekday": weekday(day),
        "max_weekday": weekday(latest),
        "weekday_match": yes_no(weekday(day) == weekday(latest)),
    }


def calendar_parts(day: str) -> dict[str, Column]:
    """Year, month label and number, day, and a display date in the row's own year."""
    label = F.date_format(F.col(day), "MMM")
    return {
        "year": F.year(day),
        "month": label,
        "month_num": F.month(day),
        "day": F.dayofmonth(day),
        "display_date": F.concat_ws("-", F.year(day), label, F.dayofmonth(day)),
    }
