"""Which labelled rows are held out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column | str, folds: int = FOLDS) -> Column:
    """Whether crc32 of the id as text leaves no remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))
