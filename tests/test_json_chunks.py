"""A JSON document over many blocks gives the rows of the reader that takes it whole."""

from __future__ import annotations

import json
import random

import pytest

from tidewatch.sources.documents import read_nested_records, read_records
from tidewatch.sources.json_chunks import read_large_records

COLUMNS = {"a": "string", "n": "long", "x": "double", "deep": "struct<b: string, c: array<struct<d: string>>>"}
ODD = ["", "plain", 'say "hi"', "back\\slash", "\\", '\\"', "}", "{", "[{]}", '"}', "},{", "é 漢 🙂", "new\nline", "\t", '"records": [', "a\\\\\"}"]


def record(rng):
    out = {"a": rng.choice([None, *ODD]), "n": rng.choice([None, rng.randrange(99)])}
    if rng.random() < 0.5:
        out["x"] = rng.choice([1.5, -2e-3, None])
    if rng.random() < 0.6:
        out["deep"] = {"b": rng.choice(ODD), "c": [{"d": rng.choice(ODD)} for _ in range(rng.randrange(3))], rng.choice(ODD) or "k": {"z": [[]]}}
    return out


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def small_blocks(spark):
    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_to
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(name)


@pytest.mark.parametrize("seed,block,indent", [(1, 97, None), (2, 1000, 1), (3, 1 << 27, None), (4, 333, 2)])
def test_flat_arrays(spark, tmp_path, small_blocks, seed, block, indent):
    rng = random.Random(seed)
    for k in range(2):
        (tmp_path / f"{k}.json").write_text(json.dumps([record(rng) for _ in range(60)], indent=indent, ensure_ascii=seed % 2 == 0), encoding="utf-8")
    want = rows_of(read_records(spark, str(tmp_path), COLUMNS))
    small_blocks(block)
    out = read_large_records(spark, str(tmp_path), COLUMNS)
    assert len(want) == 120 and rows_of(out) == want


@pytest.mark.parametrize("seed,block,indent", [(1, 97, None), (2, 400, 1), (3, 1 << 27, 2)])
def test_the_array_of_a_field(spark, tmp_path, small_blocks, seed, block, indent):
    rng = random.Random(seed)
    other = [record(rng) for _ in range(20)]
    documents = [
        {"meta": {"records": [{"a": "inner"}], "s": '"records": ['}, "list": other, "records": [record(rng) for _ in range(50)], "after": other, "last": {"records": [{"a": "no"}]}},
        {"records": [record(rng) for _ in range(3)]},
        {"records": [], "x": other},
        {"x": other},
    ]
    for k, document in enumerate(documents):
        (tmp_path / f"{k}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=False), encoding="utf-8")
    want = rows_of(read_nested_records(spark, str(tmp_path), "records", COLUMNS))
    small_blocks(block)
    assert len(want) == 53 and rows_of(read_large_records(spark, str(tmp_path), COLUMNS, "records")) == want


def test_one_file_is_many_tasks(spark, tmp_path, small_blocks):
    rows = [{"a": f"text {k} }}", "n": k} for k in range(20_000)]
    (tmp_path / "one.json").write_text(json.dumps(rows))
    small_blocks(100_000)
    from tidewatch.sources.json_chunks import _fragments

    assert _fragments(spark, str(tmp_path)).rdd.getNumPartitions() >= 5
    out = read_large_records(spark, str(tmp_path), COLUMNS)
    assert out.selectExpr("count(*)", "sum(n)", "count(distinct a)").first() == (20_000, sum(range(20_000)), 20_000)


def test_empty_documents(spark, tmp_path):
    for k, text in enumerate(["[]", " [ ] \n", "[{}]", "﻿[{\"n\": 1}]"]):
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
    assert sorted(str(r["n"]) for r in read_large_records(spark, str(tmp_path), COLUMNS).collect()) == ["1", "None"]


def test_fragments_of_one_file_stay_spread(spark, tmp_path, small_blocks):
    """Nothing but a few rows a block is dealt by the file: it would put a whole document into one task."""
    from tidewatch.sources import json_chunks

    (tmp_path / "one.json").write_text(json.dumps({"records": [{"n": k} for k in range(3000)]}))
    small_blocks(3_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = json_chunks._with_depth(json_chunks._fragments(spark, str(tmp_path)), "records")
        held = json_chunks._of_array(rows, "records")
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert read_large_records(spark, str(tmp_path), COLUMNS, "records").count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_orders_in_several_documents(spark, tmp_path, monkeypatch):
    from tidewatch.registry import files

    orders = [(k, float(k), "1-URGENT" if k % 2 else None, k % 7) for k in range(95)] + [(None, 1.0, "x", 1), (3, 1.0, "x", None)]
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double, o_orderpriority string, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    paths, read = [], files.read_large_records
    monkeypatch.setattr(files, "read_large_records", lambda s, path, *more: (paths.append(path), read(s, path, *more))[1])
    one = rows_of(files.json_large_document(spark, str(tmp_path)))
    monkeypatch.setattr(files, "ORDERS_PER_DOCUMENT", 10)
    assert rows_of(files.json_large_document(spark, str(tmp_path))) == one and len(one) == 96  # the row without a key is left out, as before
    written = [spark.read.text(path, wholetext=True).collect() for path in paths]
    assert [len(x) for x in written] == [1, 10]
    for row in [r for x in written for r in x]:
        assert list(json.loads(row["value"])) == ["made", "orders", "others"]
