"""Column names and first-match text edits."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .missing import col


def clean_name(name: str) -> str:
    """One name in snake_case: words split at case changes and punctuation."""
    s = name.strip().replace("%", " percent ").replace("#", " number ").replace("'", "")
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    if not s:
        return "x"
    return f"x{s}" if s[0].isdigit() else s


def clean_names(names: Iterable[str]) -> list[str]:
    """All names in snake_case; a repeated name gets _2, _3, ..."""
    taken: set[str] = set()
    out = []
    for name in names:
        base = candidate = clean_name(name)
        n = 1
        while candidate in taken:
            n += 1
            candidate = f"{base}_{n}"
        taken.add(candidate)
        out.append(candidate)
    return out


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def starting(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def drop_ending(df: DataFrame, *suffixes: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(suffixes)])


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Select in the wanted order, leaving out names that do not occur."""
    return df.select(*[c for c in wanted if c in df.columns])


def rename(df: DataFrame, new_to_old: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for new, old in new_to_old.items()})


def replace_first(c: Column | str, what: str, by: str) -> Column:
    """Replace the first occurrence of a literal text only."""
    # the anchored group holds what precedes the first occurrence, so one match is possible at most
    safe = by.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col(c), "(?s)^(?<head>.*?)" + re.escape(what), "${head}" + safe)


def remove_first(c: Column | str, what: str) -> Column:
    return replace_first(c, what, "")
