"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import clean_name


NAMES_LIMIT = 1000


def names_of(df: DataFrame, names_from: str, limit: int = NAMES_LIMIT) -> list[str]:
    """The names a column holds, sorted: one job that returns at most `limit` names; more are an error."""
    found = [r[0] for r in df.select(names_from).where(F.col(names_from).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} names in {names_from}")
    return sorted(found)


def widen(df: DataFrame, ids: Sequence[str], names_from: str, values: Sequence[str], names: Sequence[str] | None = None, agg=F.max) -> DataFrame:
    """One column per (measure, name), called measure_name; one measure alone is called by the name.

    Written as conditional aggregates: one map-side combined aggregate on the
    ids, where a pivot would aggregate and shuffle twice. With given names no job runs, and a
    row with another name fails the job that reads the result; without, names_of finds them.
    A row without name counts for its ids only.
    """
    names = names_of(df, names_from) if names is None else list(names)
    single = len(values) == 1
    name = F.col(names_from)
    cols = []
    for value in values:
        for n in names:
            label = clean_name(n) if single else f"{value}_{clean_name(n)}"
            chosen = F.when(name == n, F.col(value))
            if not cols:
                chosen = chosen.when(~name.isin(*names), F.raise_error(F.concat(F.lit(f"a name of {names_from} is not listed: "), name)))
            cols.append(agg(chosen).alias(label))
    return df.groupBy(*ids).agg(*cols) if cols else df.select(*ids).distinct()


def lengthen(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)

