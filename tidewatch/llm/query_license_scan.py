from __future__ import annotations

from pyspark.sql import functions as F

from .book import query, table
from .license_scan import scan


def as_files(docs):
    """Documents laid out as files: source/lang/block of 400/id.txt, one of each 20 blocks' files being its directory's LICENSE."""
    block = F.floor(F.col("doc_id") / 400)
    nth = F.floor(F.col("doc_id") / 20) % 20
    folder = F.when(nth == 1, F.concat_ws("/", "source", "lang")).otherwise(F.concat_ws("/", "source", "lang", block))
    name = F.when(nth < 2, F.concat(F.lit("LICENSE."), F.col("doc_id"))).otherwise(F.concat(F.col("doc_id"), F.lit(".txt")))
    return docs.select("doc_id", F.concat_ws("/", folder, name).alias("path"), "text")


@query("op3_license_inheritance")
def op3_license_inheritance(spark, sf_dir):
    """Licence of every document, its own or that of the nearest directory above."""
    found = scan(as_files(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "path", "own", F.round("score", 6).alias("score"), "licence", "origin", "origin_directory")
