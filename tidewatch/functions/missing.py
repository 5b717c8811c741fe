"""Missing-value rules, decided once and used everywhere.

There is one missing marker, SQL NULL. Division by zero gives NULL, bad text
gives NULL, and a comparison with NULL is spelled out where it matters.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_in(c: Column | str, values: Iterable) -> Column:
    """Membership that answers false for a missing value. In a filter, plain isin drops such rows too and is pushed down."""
    return F.coalesce(col(c).isin(*values), F.lit(False))


def if_else_null(condition: Column, yes, no) -> Column:
    """Two-way choice that stays missing when the condition is missing."""
    return F.when(condition, yes).when(~condition, no)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b; missing when b is zero or either is missing."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def ratio_or_zero(a: Column | str, b: Column | str) -> Column:
    """a / b, but 0 when b is 0."""
    return F.when(col(b) == 0, F.lit(0.0)).otherwise(ratio(a, b))


def relative_change(now: Column | str, before: Column | str) -> Column:
    return ratio(col(now) - col(before), before)


def rate_per(a: Column | str, b: Column | str, per: int = 1000) -> Column:
    return ratio(a, b) * F.lit(per)


def sum_or_zero(c: Column | str) -> Column:
    """Sum that skips missing values; 0 when nothing is left."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def add_all(*cols: Column | str) -> Column:
    """Sum across columns; one missing part makes the total missing."""
    total = col(cols[0])
    for c in cols[1:]:
        total = total + col(c)
    return total


def clip(c: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]. A missing value stays missing, unlike with least/greatest."""
    c = col(c)
    return F.when(c > high, F.lit(high)).when(c < low, F.lit(low)).otherwise(c)


def default_to(c: Column | str, value) -> Column:
    return F.coalesce(col(c), F.lit(value))


def number(c: Column | str, kind: str = "double") -> Column:
    """Text to number; bad text is missing. A whole number may be written with a point: 1001.0 is 1001."""
    if kind not in ("long", "bigint", "int", "integer"):
        return col(c).try_cast(kind)
    exact = col(c).try_cast("decimal(38,6)")
    return F.coalesce(col(c).try_cast(kind), F.when(exact == F.floor(exact), exact.try_cast(kind)))


def split_by_share(c: Column | str, share: Column | str) -> tuple[Column, Column]:
    """A measure divided into the part that has a share and the rest."""
    return col(c) * col(share), col(c) * (F.lit(1) - col(share))
