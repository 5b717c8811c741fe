from __future__ import annotations

from pyspark.sql import functions as F

from .book import query, table
from .secret_scan import listed, scan


@query("op4_secret_randomness")
def op4_secret_randomness(spark, sf_dir):
    """Secrets of every document: formats, and random strings under false-discovery control."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
