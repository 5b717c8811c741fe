"""Inferred types, and headers read from the first bytes."""

from __future__ import annotations

import datetime as dt
import gzip
import itertools

import pytest
from pyspark.sql import functions as F

from tidewatch.sources.delimited import headers, read_mixed
from tidewatch.sources.inference import KINDS, Kinds, infer, read_inferred, read_texts, with_types


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def types_of(df):
    return dict(df.dtypes)


def test_files_that_disagree(spark, tmp_path):
    put(tmp_path, "a.csv", "Id,Total,When,Code,Flag,Seen\n1,5,2021-01-02,007,true,2021-01-01 10:00\n2,NA,,12,FALSE,\n")
    put(tmp_path, "b.csv", "When,Id,Total,Code,Extra\n1/31/2021,3,6.5,8,\n2/1/2021,4,-1e3,9,\n")
    out = read_inferred(spark, [str(tmp_path)])
    assert types_of(out) == {"id": "bigint", "total": "double", "when": "date", "code": "string", "flag": "boolean", "seen": "timestamp_ntz", "extra": "string"}
    rows = [tuple(r) for r in out.select("id", "total", "when", "code", "flag").orderBy("id").collect()]
    assert rows == [(1, 5.0, dt.date(2021, 1, 2), "007", True), (2, None, None, "12", False), (3, 6.5, dt.date(2021, 1, 31), "8", None), (4, -1000.0, dt.date(2021, 2, 1), "9", None)]


def test_one_value_of_the_last_row_counts(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 19_999, "x").otherwise(F.col("id").cast("string")).alias("v"), F.when(F.col("id") == 19_999, "0.5").otherwise(F.col("id").cast("string")).alias("w"))
    found = infer(df)
    assert found["v"].counts["text"] == 1 and found["v"].type() == "string" and found["v"].type(tolerance=0.001) == "bigint" and found["w"].type() == "double"
    assert with_types(df, found, tolerance=0.001).where("v is null").count() == 1


VALUES = {
    "bigint": ["0", "-5", "+7", " 12 ", "999999999999999999"], "double": ["0.5", "1.", ".5", "1e9", "-2E-3"], "boolean": ["true", "False"],
    "date": ["2021-01-31", "1/2/2021"], "timestamp_ntz": ["2021-01-31 10:00:00", "2021-01-31T10:00:00.123"],
    "string": ["x", "007", "1,000", "2021-02-30", "13/13/2021", "9999999999999999999", "--", "NaN", "2021-01-31 25:00"],
}


def test_each_value_alone(spark):
    for want, texts in VALUES.items():
        row = spark.createDataFrame([tuple(texts)], ", ".join(f"c{k} string" for k in range(len(texts))))
        found = infer(row)
        assert [found[c].type() for c in row.columns] == [want] * len(texts)
        if want != "string":
            assert None not in tuple(with_types(row, found).first())


def test_kinds_form_a_lattice():
    one = {k: Kinds({k: 1}) for k in KINDS}
    for a, b, c in itertools.product(one.values(), repeat=3):
        assert a.merged(b).counts == b.merged(a).counts
        assert a.merged(b).merged(c).counts == a.merged(b.merged(c)).counts
        assert a.merged(b).type() == "string" or a.merged(b).merged(a).type() == a.merged(b).type()
    assert one["missing"].type() == "string" and one["missing"].merged(one["whole"]).type() == "bigint"
    assert one["date"].merged(one["whole"]).type() == "string"


def test_known_counts_of_older_files_are_merged(spark, tmp_path):
    put(tmp_path, "a.csv", "v\n1\n")
    assert types_of(read_inferred(spark, [str(tmp_path)])) == {"v": "bigint"}
    assert types_of(read_inferred(spark, [str(tmp_path)], known={"v": Kinds({"number": 3})})) == {"v": "double"}


def test_one_aggregate_and_no_sample(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("a b"), F.lit(None).cast("string").alias("n"))
    assert {c: k.type() for c, k in infer(df).items()} == {"a b": "bigint", "n": "string"}
    assert infer(df.limit(0))["n"].type() == "string"


# headers ---------------------------------------------------------------------------
def test_headers_read_the_first_bytes_only(spark, tmp_path):
    line = "1,2,3,4\n"
    for k in range(4):
        put(tmp_path, f"f {k}.csv", f"a,b,c,d{k % 2}\n" + line * 400_000)
    (tmp_path / "empty.csv").write_bytes(b"")
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("a,b,c,d0\n" + line)
    jvm = spark.sparkContext._jvm
    read = lambda: sum(s.getBytesRead() for s in jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    found = headers(spark, [str(tmp_path)])
    assert read() - before < 600_000  # of 12.8 MB
    assert {h: len(files) for h, files in found.items()} == {"a,b,c,d0": 3, "a,b,c,d1": 2}
    out = read_mixed(spark, [str(tmp_path)], {"a": "long", "d0": "long", "d1": "long"})
    assert out.agg(F.count("*"), F.count("d0"), F.count("d1")).first() == (1_600_001, 800_001, 800_000)


def test_headers_in_another_encoding(spark, tmp_path):
    put(tmp_path, "a.csv", "Doña,b\r\nx,1\r\n", "latin-1")
    put(tmp_path, "b.csv", "b,Doña\n2,y\n", "latin-1")
    assert set(headers(spark, [str(tmp_path)], "ISO-8859-1")) == {"Doña,b", "b,Doña"}
    assert read_texts(spark, [str(tmp_path)], "ISO-8859-1").count() == 2


def test_nothing_to_read(spark, tmp_path):
    put(tmp_path, "a.csv", "")
    with pytest.raises(ValueError, match="header"):
        read_inferred(spark, [str(tmp_path)])
