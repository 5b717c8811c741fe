"""Repair of names that a lookup does not find, by the closest known name.

Two names at most k edits apart have a text in common that each becomes by leaving out at most k characters. So each name is
listed with all texts it becomes that way (its neighbourhood), the lists are joined by equality, and the
edit distance is computed for names that meet only: never for all pairs. Only distinct names that are not found
as they are take part, and the known ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import col
from .enrich import lookup

EDITS = 2


def folded_name(c: Column | str) -> Column:
    """Spelling in which names are compared: lower case, single spaces, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(col(c), r"\s+", " ")))


def neighbourhood(c: Column | str, edits: int = EDITS) -> Column:
    """All texts that a name becomes by leaving out at most `edits` characters, itself among them."""
    texts = F.array(col(c))
    for _ in range(edits):
        texts = F.array_distinct(F.concat(texts, F.flatten(F.transform(texts, _one_left_out))))
    return texts


def _one_left_out(s: Column) -> Column:
    every = F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, F.length(s))))
    return F.when(F.length(s) > 0, every).otherwise(F.array().cast("array<string>"))


def nearest_names(names: DataFrame, known: DataFrame, edits: int = EDITS) -> DataFrame:
    """(name, nearest, distance, n) from one-column tables of distinct names: the closest known name, and how many are as close.

    Names without any known one within `edits` do not occur; of equally close ones the first by its letters is given.
    """
    left = names.toDF("name").select("name", F.explode(neighbourhood("name", edits)).alias("_text"))
    right = known.toDF("nearest").select("nearest", F.explode(neighbourhood("nearest", edits)).alias("_text"))
    met = left.join(right, "_text").select("name", "nearest").distinct()
    close = met.withColumn("distance", F.levenshtein("name", "nearest", edits)).where("distance >= 0")
    each = close.groupBy("name", "distance").agg(F.min("nearest").alias("nearest"), F.count(F.lit(1)).alias("n"))
    best = each.groupBy("name").agg(F.min(F.struct("distance", "nearest", "n")).alias("_best"))
    return best.select("name", "_best.nearest", "_best.distance", "_best.n")


def repair_names(df: DataFrame, name: str, known: DataFrame, known_name: str, *, edits: int = EDITS, into: str = "repaired", distance: str = "distance") -> DataFrame:
    """df with the known name that is meant, in its known spelling, and how many edits away it is.

    0 for a name found as it is, but for case and spaces. Missing where no known name is close enough or where several are
    equally close: a guess would be as often wrong as right. Two known names that fold to one are an error.
    """
    dimension = known.select(folded_name(known_name).alias("_known"), F.col(known_name).alias(into)).dropna().distinct()
    own = df.select(folded_name(name).alias("_name")).where("_name is not null").distinct()
    found = own.join(dimension.select(F.col("_known").alias("_name")), "_name", "left_semi").select("_name", F.col("_name").alias("_known"), F.lit(0).alias(distance))
    lost = own.join(dimension, F.col("_name") == F.col("_known"), "left_anti").select("_name")
    close = nearest_names(lost, dimension.select("_known").distinct(), edits).where("n = 1")
    meant = found.unionByName(close.select(F.col("name").alias("_name"), F.col("nearest").alias("_known"), distance if distance == "distance" else F.col("distance").alias(distance)))
    table = lookup(meant, dimension, "_known").drop("_known")
    return lookup(df.withColumn("_name", folded_name(name)), table, "_name", unique=True).select(*df.columns, into, distance)
