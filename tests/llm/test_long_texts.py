"""Operators that look at whole texts, on texts of a few megabytes between short ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import byte_bpe, decision_list, secret_scan

LONG = {
    "words": "plain words of a very long text that never ends " * 60_000,
    "one word": "x" * 2_000_000,
    "lines": "line\n" * 400_000,
    "digits": "0123456789abcdef" * 120_000,
    "white space": " \t\n" * 500_000,
}


@pytest.fixture(scope="module")
def long_docs(spark):
    rows = [(k, t) for k, t in enumerate(LONG.values())] + [(100, "short text"), (101, None), (102, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_secrets(long_docs):
    rows = {r["doc_id"]: r for r in secret_scan.scan(long_docs, draws=50).collect()}
    assert len(rows) == 8
    hexed = [s for s in rows[3]["base"] if s["kind"] == "hex"]
    assert [(s["start"], s["end"]) for s in hexed] == [(0, 16 * 120_000)]
    assert secret_scan.redact(long_docs, draws=50).count() == 8


def test_rules(spark, long_docs):
    labels = spark.createDataFrame([(k, k % 2) for k in (0, 1, 2, 3, 4, 100, 101, 102)], "doc_id long, quality int")
    rows = {r["doc_id"]: r for r in decision_list.judged(long_docs, labels).collect()}
    assert rows[0]["n_words"] == 10 * 60_000 and rows[1]["n_words"] == 1 and rows[2]["n_dup_lines"] == 400_000 - 1 and rows[4]["n_words"] == 0
    assert rows[2]["n_repeat_words"] == 400_000 and all(rows[k]["base_failed"] for k in (0, 1, 2, 3, 4))


def test_round_trips(long_docs):
    import public_tokenizers

    out = byte_bpe.encode_checked(long_docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert out.where(~F.col("round_trip")).count() == 0
