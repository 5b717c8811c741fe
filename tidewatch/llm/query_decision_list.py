from __future__ import annotations

from .book import query, table
from .decision_list import judged

COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op2_decision_list")
def op2_decision_list(spark, sf_dir):
    """Base counts of every document, and whether the learned rules keep it."""
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(*COLUMNS)
