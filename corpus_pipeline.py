"""Filtering and tokenizing a corpus in stages.

Each stage works on all rows its predecessor kept. run() writes every stage's rows to the shared
folder and reads them back as the next one's documents, so that a lost executor costs
one stage at most. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.byte_bpe import encode_checked
from tidewatch.llm.decontaminate import remove
from tidewatch.llm.quality import accepted
from tidewatch.llm.secret_scan import redact
from tidewatch.llm.shingle_join import distinct_documents
from tidewatch.sources.staging import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking accepts."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars renewed where that happened."""
    return redact(docs, length="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit integers) and whether decoding them gives the text's bytes."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = encode_checked(docs.select("doc_id", "text", "lang", "source"), ranks, pattern)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", "round_trip")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]
#: None: a trained classifier, randomness tests and a tokenizer are not SQL. tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
