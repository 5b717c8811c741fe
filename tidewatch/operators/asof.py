"""As-of join of two large tables: for each row the other side's value in force at its time.

Both sides are put into one stream per key, ordered by time, and the last known value is carried along: one
sort by (key, time), no ranges laid out and no pairs formed. Times have the precision of their columns. Keys
with more rows than one task should hold are cut into segments (see segments).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .panel import Panel
from .segments import SIZE, Columns, with_windows


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    *,
    right_time: str | None = None,
    ties: Sequence[str] = (),
    strict: bool = False,
    within: Column | None = None,
    size: int = SIZE,
) -> DataFrame:
    """All rows and columns of left, with the `values` of the newest right row of the same keys that is not younger.

    `strict` takes older rows only. Of right rows with the same time the last by `ties` counts. `within`, an interval, leaves
    out values that are older. Values are missing before the first right row, and where a key or the
    time is missing; a right row's own missing values are taken as they are. `right_time` may name
    another column and may be among the values.
    """
    right_time = right_time or time
    clash = sorted(set(values) & set(left.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}; rename them before the join")
    own = {f"_left_{k}": c for k, c in enumerate(left.columns)}
    key_names = [f"_key_{k}" for k in range(len(keys))]
    named = lambda df: [df[c].alias(n) for c, n in zip(keys, key_names)]
    rows = left.select(*named(left), left[time].alias("_time"), F.lit(0 if strict else 1).alias("_side"), *[left[c].alias(n) for n, c in own.items()])
    known = right.dropna(subset=[*keys, right_time])
    found = F.struct(known[right_time].alias("_at"), *[known[c].alias(c) for c in values]).alias("_right")
    steps = known.select(*named(known), known[right_time].alias("_time"), F.lit(1 if strict else 0).alias("_side"), F.struct(F.lit(0), *[known[c] for c in ties]).alias("_tie"), found)
    both = rows.unionByName(steps, allowMissingColumns=True)
    panel = Panel(tuple(key_names), "_time", ties=("_side", "_tie"))
    carried = with_windows(both, panel, Columns(running={"_found": ("last", F.col("_right"))}), size)
    mine = carried.where(F.col("_side") == (0 if strict else 1))
    in_force = F.col("_time").isNotNull()
    for k in key_names:
        in_force = in_force & F.col(k).isNotNull()
    if within is not None:
        in_force = in_force & (F.col("_found._at") + within >= F.col("_time"))
    return mine.select(*[F.col(n).alias(c) for n, c in own.items()], *[F.when(in_force, F.col(f"_found.{c}")).alias(c) for c in values])
