from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from tidewatch.llm.byte_bpe import encoding
from tidewatch.llm.secret_scan import MARK

from .test_decontaminate import expected as windows_found
from .test_shingle_join import expected as linked


def words(rng, n):
    vocab = "the of and to in is that for was with as are this be on by from at an or it house tree water light".split()
    return [rng.choice(vocab) + rng.choice(["", "", "ing", "ed", "er", "s"]) for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(15)
    path = tmp_path_factory.mktemp("tables")
    items = [" ".join(words(rng, 25)) for _ in range(5)]
    texts = [" ".join(words(rng, rng.randint(40, 120))) + "." for _ in range(250)]
    bad = [" ".join(w + "###" for w in words(rng, 60)) for _ in range(40)]
    near = [texts[k].replace("the ", "the ", 1) + " tail" for k in range(20)]
    leaks = [f"{' '.join(words(rng, 40))} {items[k % 5]} {' '.join(words(rng, 40))}." for k in range(10)]
    secret = [" ".join(words(rng, 40)) + ' password = "0123456789abcdef0123" ' + " ".join(words(rng, 10)) + "." for _ in range(5)]
    every = [*texts, *bad, *near, *leaks, *secret]
    rows = [(k, t, "en", f"src{k % 3}", len(t)) for k, t in enumerate(every)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(k, int("###" not in t), 0) for k, t in enumerate(every) if k % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), every, items


def test_stages(spark, folder):
    path, every, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        from tidewatch.sources.staging import staged

        docs = staged(stage(spark, docs, path), name)
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        assert name == "tokens" or docs.columns == columns
    kept = [k for k, t in enumerate(every) if "###" not in t]
    assert len(set(seen["quality"]) ^ set(kept)) <= 3 and not [k for k in seen["quality"] if "###" in every[k]]
    ids = sorted(seen["quality"])
    want = {i for i, _, c in linked(ids, [every[k] for k in ids]) if i == c}
    assert set(seen["near_duplicates"]) == want
    ids = sorted(want)
    found = windows_found([every[k] for k in ids], list(enumerate(items)))
    clean = {k for k, f in zip(ids, found) if not f[1]}
    assert set(seen["decontamination"]) == clean == set(seen["secrets"]) == set(seen["tokens"])
    bpe = encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for k, r in seen["secrets"].items():
        assert ("password" in every[k]) == (MARK in r["text"]) and r["n_chars"] == len(r["text"])
        if MARK not in r["text"]:
            assert r["text"] == every[k]
        t = seen["tokens"][k]
        assert t["round_trip"] and np.frombuffer(t["ids"], "<u4").tolist() == bpe.encode_ordinary(r["text"])


def test_run_and_registration(spark, folder):
    path, _, _ = folder
    registered = __spark_entry__.queries()
    assert registered["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in registered if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    rows = corpus_pipeline.run(spark, path)
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"] and rows.count() > 200


def test_no_documents(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        assert out.count() == 0
        docs = docs if "text" not in out.columns else out


def test_nulls_and_repeats_in_every_stage(spark, folder):
    """Null ids, null and empty texts and repeated rows: each stage keeps or drops them as its own rule says, and none fails."""
    path, every, items = folder
    good = every[3]
    odd = [(None, good, None, None, None), (None, None, None, None, None), (7_000, "", "en", None, 0), (7_001, None, "en", "src0", None), (3, good, "en", "src0", len(good)), (3, good, "en", "src0", len(good))]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    docs = docs.limit(60).unionByName(spark.createDataFrame(odd, docs.schema))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        rows = out.collect()
        texts = [r["text"] for r in rows] if "text" in out.columns else []
        if name == "near_duplicates":
            # one of the rows of the same text stays, and every row without words, which is linked with nothing
            assert texts.count(good) == 1
            without = [r["text"] for r in docs.collect() if not (r["text"] or "").strip()]
            assert len([t for t in texts if not (t or "").strip()]) == len(without)
        if name in ("secrets", "tokens"):
            assert len(rows) == docs.count()
        if name != "tokens":
            assert out.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
        else:
            assert all(r["round_trip"] for r in rows)
            assert [r["n_tokens"] for r in rows if r["doc_id"] in (7_000, 7_001)] in ([0, 0], [0], [])
