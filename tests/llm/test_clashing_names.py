"""Documents whose other columns are named like results, with nulls in them."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import byte_bpe, decision_list, decontaminate, license_scan, main_text, personal_data, quality, secret_scan, shingle_join, token_files

NAMES = (
    "n_words n_hit items longest_match matches hit_words contaminated base candidates spans n_tokens ids decoded score held_out predicted stats key"
    " component_id n_shingles kept rule base_failed own licence origin origin_directory holder depth _directory start a b label node word_chars _id _label"
).split()
TEXTS = ["one two three four five six seven eight nine ten eleven", 'token = "0123456789abcdef" é', None, "", "Released under the MIT License.", "x@y.zz and 1.2.3.4"]


@pytest.fixture
def tables(spark):
    rows = [(k, t, f"d/{k}") for k, t in enumerate(TEXTS)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, path string")
    filled = [F.when(F.col("doc_id") % 2 == 0, F.lit(n)).alias(n.upper() if k % 3 == 0 else n) for k, n in enumerate(NAMES)]
    labels = spark.createDataFrame([(k, k % 2, "x") for k in range(6)], "doc_id long, quality int, key string")
    bench = spark.createDataFrame([(1, TEXTS[0], 5)], "item_id long, text string, items int")
    return plain, plain.select(*filled[:10], "doc_id", *filled[10:], "text", "path"), labels, bench


RANKS, PATTERN, FILE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json")
OPERATORS = {
    "decontaminate": lambda docs, labels, bench: decontaminate.find(docs, bench),
    "remove": lambda docs, labels, bench: decontaminate.remove(docs, bench),
    "rules": lambda docs, labels, bench: decision_list.judged(docs, labels),
    "licences": lambda docs, labels, bench: license_scan.scan(docs),
    "secrets": lambda docs, labels, bench: secret_scan.scan(docs, draws=50),
    "redact": lambda docs, labels, bench: secret_scan.redact(docs, draws=50),
    "bpe": lambda docs, labels, bench: byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN),
    "join": lambda docs, labels, bench: shingle_join.grouped(docs),
    "distinct": lambda docs, labels, bench: shingle_join.distinct_documents(docs),
    "token files": lambda docs, labels, bench: token_files.encode(docs, FILE, 2),
    "personal data": lambda docs, labels, bench: personal_data.scan(docs, sample=10, epochs=1),
    "quality": lambda docs, labels, bench: quality.score(docs, labels),
    "accepted": lambda docs, labels, bench: quality.accepted(docs, labels),
    "pages": lambda docs, labels, bench: main_text.extract(docs, page="text", carry=("doc_id",)),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_other_columns_change_nothing(tables, name):
    plain, crowded, labels, bench = tables
    want = OPERATORS[name](plain, labels, bench)
    got = OPERATORS[name](crowded, labels, bench)
    columns = [c for c in want.columns if c != "path"]
    assert set(want.columns) <= set(got.columns) and len({c.lower() for c in got.columns}) == len(got.columns)
    rows = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert rows(got) == rows(want)
    if name in ("remove", "redact", "distinct", "accepted"):
        assert got.columns == crowded.columns
