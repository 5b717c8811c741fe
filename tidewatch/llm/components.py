"""Connected components of a table of links, by contraction.

Each round every node points to the smallest of itself and its neighbours, pointers are
followed one step further, and links are redrawn between the nodes pointed to. A hot node only adds
to a minimum, which is combined before the shuffle. Rounds end when no link is left; each
is written to the shared folder, so that no lineage grows and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of (a, b) links; the label is a node of the component, the same for all of it."""
    edges = staged(links.where("a <> b and a is not null and b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        first = staged(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("to")), "pointers")
        # the node pointed to may itself point to a smaller one
        further = first.select(F.col("node").alias("to"), F.col("to").alias("next"))
        pointers = staged(first.join(further, "to").select("node", F.col("next").alias("to")), "pointers")
        if labels is None:
            labels = pointers.select("node", F.col("to").alias("label"))
        else:
            moved = pointers.select(F.col("node").alias("label"), "to")
            labels = staged(labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        for end in ("a", "b"):
            edges = edges.join(pointers.select(F.col("node").alias(end), "to"), end).drop(end).withColumnRenamed("to", end)
        edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
