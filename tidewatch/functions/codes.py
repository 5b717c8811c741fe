"""Place codes and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import col, if_else_null


def join_code(*parts: Column | str) -> Column:
    """Code parts put together; one missing part makes the code missing."""
    return F.concat(*[col(p).cast("string") for p in parts])


def pad_code(c: Column | str, width: int = 5) -> Column:
    """Left-pad with zeros. Longer codes are kept whole and missing stays missing."""
    text = col(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def two_way_label(a: Column | str, b: Column | str, higher: str, lower: str, missing_is_lower: bool = False) -> Column:
    """`higher` where a > b, else `lower`; missing if either side is missing, or `lower` if so asked."""
    more = col(a) > col(b)
    if missing_is_lower:
        return F.when(more, F.lit(higher)).otherwise(F.lit(lower))
    return if_else_null(more, F.lit(higher), F.lit(lower))


def buckets(c: Column | str, rules: Sequence[tuple[float | None, str]]) -> Column:
    """Left-closed buckets. `rules` go up by lower bound; None means "from below"."""
    c = col(c)
    chain = None
    for low, label in reversed(list(rules)):
        test = c.isNotNull() if low is None else c >= low
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain


def margin_bucket(share: Column | str, low: float, high: float, labels: tuple[str, str, str]) -> Column:
    """Share at or below `low`, strictly between, at or above `high`.

    A missing share gives a missing bucket.
    """
    share = col(share)
    below, close, above = labels
    return (
        F.when(share <= low, F.lit(below))
        .when((share > low) & (share < high), F.lit(close))
        .when(share >= high, F.lit(above))
    )


def folded(c: Column | str, table: dict) -> Column:
    """Value for a key out of a literal table, missing when not listed. A table of data belongs into a join."""
    if not table:
        raise ValueError("empty literal table")
    keys, values = F.array(*map(F.lit, table)), F.array(*map(F.lit, table.values()))
    place = F.array_position(keys, col(c))
    return F.get(values, (place - 1).cast("int"))
