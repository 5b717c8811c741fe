from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text) with extra columns, some named like results."""

    def make(texts, ids=None):
        rows = [(i, t, "en", None, 7, "x") for i, t in zip(ids or range(len(texts)), texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score_note string")

    return make
