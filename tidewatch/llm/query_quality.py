from __future__ import annotations

from .book import query, table
from .quality import score


@query("op10_pairwise_quality")
def op10_pairwise_quality(spark, sf_dir):
    """Bradley-Terry quality score of every document."""
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
