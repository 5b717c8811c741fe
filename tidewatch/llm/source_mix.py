"""Mixing sources to target weights by hash thresholds.

A row's place in its source is the hash of its id: taking the rows below a threshold
takes a fixed random part of the source, and a larger budget takes all that a smaller
one takes. A histogram of sizes by source and by the first BITS bits of the hash tells the bucket
in which a source's budget runs out; only that bucket's rows are counted again by the next BITS
bits, until the bucket is one row. No rows are sorted, and a source with a third of all rows is
4096 buckets summed in every task like any other.

Whole multiples of a source come first (copies of every row); the rest of the target is the budget
of the thresholds. The row at the edge does not fit. What is then still missing, if more than the
tolerance, goes to the rows behind the edge that fit into it, by the next threshold in the same order; at last one more
row is taken where that comes nearer. So whole rows are taken, first fit in hash order.

A null or empty text has size 0 and takes nothing; a null source is a source of its own, ranked
last; rows with a null id or the id of another row are told apart by their text, and
equal rows by their place in the input, where it does not matter which is taken.
Other columns are not read unless carried; result columns replace columns of the same name. An
empty table gives an empty table. All of it is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged
from .arrays import without

BITS = 12
WEIGHTS = (1, 2, 3)
CAP = 3  # no row more often than this, so no source beyond this many times its size
TOLERANCE = 0.001  # of a source's target: nearer than this is not tried
RESULT = ("size", "source_size", "target", "copies", "taken")
SPACE = r"\x20\x09-\x0D"
KEY = ("_mix_h", "_mix_g", "_mix_at")
#: (column, bits left out) of each level: the id's hash, the text's hash, the place
LEVELS = [(c, max(s, 0)) for c, top in zip(KEY, (60, 60, 63)) for s in range(top - BITS, -BITS, -BITS)]


def word_count(text: str) -> Column:
    """Runs of characters that are not white space; one pass, a character a word in memory."""
    marked = F.regexp_replace(F.concat(F.col(text), F.lit(" ")), f"[{SPACE}]*+[^{SPACE}]++[{SPACE}]++", "x")
    return F.when(F.col(text).rlike(f"[^{SPACE}]"), F.length(marked)).otherwise(0).cast("long")


def mix(
    docs: DataFrame,
    *,
    text: str = "text",
    source: str = "source",
    order: str = "doc_id",
    carry: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """The carried columns of every row with its size, its source's size and target, its copies and taken = size * copies."""
    kept = without(docs.select(*dict.fromkeys(carry)), RESULT).columns
    rows = staged(
        docs.select(
            *kept,
            F.col(source).alias("_mix_source"),
            word_count(text).alias("_mix_size"),
            F.conv(F.substring(F.md5(F.coalesce(F.col(order).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long").alias("_mix_h"),
            F.shiftrightunsigned(F.xxhash64(text), 4).alias("_mix_g"),
            F.monotonically_increasing_id().alias("_mix_at"),
        ),
        "mix-rows",
    )
    plan = _targets(_sources(rows, weights), cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("_mix_copies", whole).withColumn("_mix_budget", F.floor(F.col("target") - F.col("_mix_copies") * F.col("source_size")))
    plan = staged(plan.withColumn("_mix_near", F.floor(F.lit(tolerance) * F.col("target"))), "mix-plan")
    plan = _with_picks(rows, plan)
    copies = F.col("_mix_copies") + _picked().cast("long")
    out = _joined(rows, plan).withColumn("copies", copies)
    return out.select(*kept, F.col("_mix_size").alias("size"), "source_size", "target", "copies", (F.col("_mix_size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: every row of docs as often as it is taken, columns as they are."""
    names = [f"_mix_c{k}" for k in range(len(docs.columns))]
    named = {"text": "text", "source": "source", "order": "doc_id"} | {k: v for k, v in options.items() if k in ("text", "source", "order")}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    at = {k: names[[c.lower() for c in docs.columns].index(v.lower())] for k, v in named.items()}
    out = mix(own, carry=names, **(options | at))
    return out.withColumn("_mix_n", F.explode(F.expr("array_repeat(0, cast(copies AS int))"))).select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])


def _joined(rows: DataFrame, plan: DataFrame, how: str = "inner") -> DataFrame:
    """rows with what is planned for their source. The plan has one row a source: Spark broadcasts it by its size on disk, or splits hot sources."""
    plan = plan.withColumnRenamed("_mix_source", "_mix_other")
    return rows.join(plan, F.col("_mix_source").eqNullSafe(F.col("_mix_other")), how).drop("_mix_other")


def _sources(rows: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Size and weight of each source; its rank is counted range by range, so no task sees all sources."""
    sizes = rows.groupBy("_mix_source").agg(F.sum("_mix_size").alias("source_size"))
    ranges = sizes.repartitionByRange(F.col("_mix_source").asc_nulls_last())
    sizes = staged(ranges.withColumn("_mix_part", F.spark_partition_id()), "mix-sources")
    parts = sizes.groupBy("_mix_part").count()
    ahead = F.sum("count").over(Window.orderBy("_mix_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("_mix_part", F.coalesce(ahead, F.lit(0)).alias("_mix_ahead"))
    within = F.row_number().over(Window.partitionBy("_mix_part").orderBy(F.col("_mix_source").asc_nulls_last()))
    rank = F.col("_mix_ahead") + within - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    return staged(sizes.join(parts, "_mix_part").select("_mix_source", "source_size", weight.cast("long").alias("_mix_weight")), "mix-sources")


def _targets(sources: DataFrame, cap: int) -> DataFrame:
    """Shares of the total by weight; those beyond `cap` times their size stop there and the others share the rest, until none is beyond."""
    total, weight = sources.agg(F.sum("source_size"), F.sum("_mix_weight")).first()
    free, stopped = total or 0, 0
    most = F.col("source_size") * cap
    while True:
        share = F.col("_mix_weight") * (F.lit(float(free)) / F.lit(float(weight or 1)))
        over = share > most
        n, size, weights = sources.agg(F.count_if(over), F.sum(F.when(over, most)), F.sum(F.when(~over, F.col("_mix_weight")))).first()
        if (n or 0) == stopped or not weights:
            return sources.withColumn("target", F.least(share, most.cast("double")))
        free, weight, stopped = total - size, weights, n


def _key() -> Column:
    return F.struct(*KEY)


def _picked() -> Column:
    """Whether a row is inside one of its source's picks: (from, to, largest size)."""
    return F.exists("_mix_picks", lambda p: (_key() > p["lo"]) & (p["hi"].isNull() | (_key() < p["hi"])) & (F.col("_mix_size") <= p["most"]))


def _picks(tables: list[DataFrame], plan: DataFrame) -> DataFrame:
    lists = reduce(DataFrame.unionByName, tables).groupBy("_mix_source").agg(F.collect_list(F.struct("lo", "hi", "most")).alias("_mix_picks"))
    return staged(_joined(plan, lists, "left").withColumn("_mix_picks", F.coalesce("_mix_picks", F.array().cast(lists.schema["_mix_picks"].dataType))), "mix-plan")


def _with_picks(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with each source's picks: intervals of the hash order, each with the largest size it takes."""
    start = F.struct(*[F.lit(-1).cast("long").alias(c) for c in KEY])
    open_ = staged(plan.where("_mix_budget > _mix_near").select("_mix_source", F.col("_mix_budget").alias("most"), "_mix_near", start.alias("lo")), "mix-open")
    rounds = []
    while True:
        fitting = _joined(rows, open_).where((F.col("_mix_size") > 0) & (F.col("_mix_size") <= F.col("most")) & (_key() > F.col("lo")))
        edge = _edge(fitting.select("_mix_source", "_mix_size", "most", *KEY))
        found = staged(_joined(open_, edge, "left"), "mix-picks")
        rounds.append(found)
        later = found.where("hi is not null and most - _mix_before > _mix_near")
        open_ = later.select("_mix_source", (F.col("most") - F.col("_mix_before")).alias("most"), "_mix_near", F.col("hi").alias("lo"))
        if open_.isEmpty():
            break
        open_ = staged(open_, "mix-open")
    picks = [r.select("_mix_source", "lo", "hi", "most") for r in rounds]
    ended = reduce(DataFrame.unionByName, [r.where("hi is null").select("_mix_source") for r in rounds])
    if ended.isEmpty():
        return _picks(picks, plan)
    return _picks([*picks, _nearest(rows, _picks(picks, plan), ended)], plan)


def _nearest(rows: DataFrame, plan: DataFrame, ended: DataFrame) -> DataFrame:
    """For sources all of whose fitting rows are taken: the smallest other row, where the mix is nearer to the target with it."""
    ended = _joined(plan, ended.withColumn("_mix_ended", F.lit(True))).drop("_mix_ended")
    size = F.col("_mix_size")
    other = F.when(~_picked() & (size > 0), F.struct("_mix_size", *KEY))
    left = _joined(rows, ended).groupBy("_mix_source", "_mix_budget", "_mix_near").agg(F.sum(F.when(_picked(), size).otherwise(0)).alias("got"), F.min(other).alias("next"))
    miss = F.col("_mix_budget") - F.col("got")
    nearer = left.where((miss > F.col("_mix_near")) & (F.col("next._mix_size") - miss < miss))
    below = F.struct("next._mix_h", "next._mix_g", (F.col("next._mix_at") - 1).alias("_mix_at"))
    above = F.struct("next._mix_h", "next._mix_g", (F.col("next._mix_at") + 1).alias("_mix_at"))
    return nearer.select("_mix_source", below.alias("lo"), above.alias("hi"), F.col("next._mix_size").alias("most"))


def _edge(rows: DataFrame) -> DataFrame:
    """Per source whose rows exceed `most`: the first row in hash order that does not fit (hi), and the sum before it."""
    rows = rows.withColumn("_mix_before", F.lit(0).cast("long"))
    columns = rows.columns
    for level, (column, shift) in enumerate(LEVELS):
        bucket = F.shiftright(column, shift)
        sums = rows.groupBy("_mix_source", "most", "_mix_before", bucket.alias("_mix_bucket")).agg(F.sum("_mix_size").alias("_mix_sum"), F.count("*").alias("_mix_n"))
        upto = F.col("_mix_before") + F.sum("_mix_sum").over(Window.partitionBy("_mix_source").orderBy("_mix_bucket"))
        edge = sums.withColumn("_mix_upto", upto).where("_mix_upto > most and _mix_upto - _mix_sum <= most")
        edge = staged(edge.select("_mix_source", "_mix_bucket", (F.col("_mix_upto") - F.col("_mix_sum")).alias("_mix_before"), "_mix_n"), "mix-edge")
        rows = _joined(rows.drop("_mix_before"), edge).where(bucket == F.col("_mix_bucket")).select(*columns)
        if (edge.agg(F.max("_mix_n")).first()[0] or 0) <= 1:
            break
        rows = staged(rows, "mix-edge-rows") if level == 0 else rows
    return staged(rows.select("_mix_source", _key().alias("hi"), "_mix_before"), "mix-edge")
