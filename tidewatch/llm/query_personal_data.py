from __future__ import annotations

from pyspark.sql import functions as F

from .book import query, table
from .personal_data import KINDS, scan
from .secret_scan import listed


@query("op9_character_tagger")
def op9_character_tagger(spark, sf_dir):
    """Personal data of every document: formats, and other spellings by a trained tagger."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
