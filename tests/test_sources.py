"""Files of every kind the feeds come in."""

from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidewatch.sources.delimited import read_banner, read_feed, read_mixed, read_positional, read_text
from tidewatch.sources.documents import read_nested_records, read_records
from tidewatch.sources.extracts import write_extract, write_table
from tidewatch.sources.manifest import newest_links, placed, read_manifest
from tidewatch.sources.staging import shared_folder, staged, staging


def put(folder, name: str, text: str, encoding: str = "utf-8") -> str:
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_types_by_position(spark, tmp_path):
    path = put(tmp_path, "a.csv", "date,fips,cases\n2021-01-01,01001,5\n")
    df = read_positional(spark, path, {"date": "string", "fips": "string", "cases": "double"})
    assert tuple(df.first()) == ("2021-01-01", "01001", 5.0)
    with pytest.raises(Exception, match="header"):
        read_positional(spark, path, {"date": "string", "cases": "string", "fips": "double"}).collect()


def test_dirty_text_and_absent_columns(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'State Code,Total Cases,Extra_1\nNY,12,3\n"TX, new",n/a,x\n')
    df = read_feed(spark, path, {"state_code": "string", "total_cases": "double", "deaths": "double"}, prefixes=("extra",))
    assert [tuple(r) for r in df.orderBy("state_code").collect()] == [("NY", 12.0, None, 3.0), ("TX, new", None, None, None)]
    assert dict(read_text(spark, path).dtypes) == {"state_code": "string", "total_cases": "string", "extra_1": "string"}


def test_banner_and_latin_text(spark, tmp_path):
    path = put(tmp_path, "d.csv", "GEO.id,GEO.pop\nId,Population\n1,10\n2,bad\n3,30 \nDoña Ana,7\n", "latin-1")
    df = read_banner(spark, path, {"id": "string", "pop": "double"}, {"id": ["GEO.id", "Id"]}, "ISO-8859-1")
    assert sorted((r["id"], r["pop"]) for r in df.collect()) == [("1", 10.0), ("2", None), ("3", 30.0), ("Doña Ana", 7.0)]


def test_json_documents(spark, tmp_path):
    nested = put(tmp_path, "n.json", json.dumps({"runid": 4, "records": [{"fips": "1", "pct": 1.5}, {"fips": "2"}]}, indent=1))
    got = read_nested_records(spark, nested, "records", {"fips": "string", "pct": "double"})
    assert sorted((r["fips"], r["pct"]) for r in got.collect()) == [("1", 1.5), ("2", None)]
    flat = put(tmp_path, "f.json", json.dumps([{"date": 20210101, "death": 3}, {"date": 20210102}], indent=1))
    assert sorted((r["date"], r["death"]) for r in read_records(spark, flat, {"date": "long", "death": "double"}).collect()) == [
        (20210101, 3.0), (20210102, None),
    ]


def test_manifest_reads_the_newest_and_merges_by_name(spark, tmp_path):
    put(tmp_path, "old.csv", "state,beds\nNY,1\n")
    put(tmp_path, "mid.csv", "state,beds,extra_a\nNY,2,9\n")
    put(tmp_path, "new.csv", "extra_b,state,beds\n8,NY,3\n")
    manifest = spark.createDataFrame(
        [("01/01/2021 10:00:00 AM", "old.csv"), ("01/03/2021 10:00:00 AM", "new.csv"), ("01/02/2021 10:00:00 AM", "mid.csv")],
        "update_date string, archive_link string",
    )
    assert newest_links(manifest, 2) == ["new.csv", "mid.csv"]
    df = read_manifest(spark, manifest, {"state": "string", "beds": "double"}, ("extra",), str(tmp_path), 2).orderBy("source_rank")
    assert [r.asDict() for r in df.collect()] == [
        {"state": "NY", "beds": 3.0, "extra_b": 8.0, "source_rank": 0, "extra_a": None},
        {"state": "NY", "beds": 2.0, "extra_b": None, "source_rank": 1, "extra_a": 9.0},
    ]


def test_extract_and_table_round_trip(spark, tmp_path, frame):
    df = frame([("a", "2021-12-31", 1.5), ("b", "2022-01-01", None)], "k string, d date, x double")
    write_extract(df, str(tmp_path / "csv"))
    back = read_feed(spark, str(tmp_path / "csv"), {"k": "string", "d": "date", "x": "double"})
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    write_table(df, str(tmp_path / "pq"), "d")
    assert {p.name for p in (tmp_path / "pq").glob("year_part=*")} == {"year_part=2021", "year_part=2022"}
    assert spark.read.parquet(str(tmp_path / "pq")).where("year_part = 2022").count() == 1


def test_staging_uses_the_shared_folder(spark, frame):
    df = staged(frame([("a", 1), ("b", 2)], "k string, x int").where(F.col("x") > 1), "t")
    assert values(df, "k", "k") == ["b"]
    assert shared_folder(spark).removeprefix("file:") + "/staged/t-" in df.inputFiles()[0]


@pytest.mark.parametrize("named", ["/shared/x", "/shared/x/"])
def test_the_cluster_names_the_folder(named):
    session = SimpleNamespace(conf={"spark.checkpoint.dir": named, "spark.master": "yarn"})
    assert shared_folder(session) == "/shared/x"


def test_a_cluster_without_a_folder_is_refused_and_a_local_run_gets_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(conf={"spark.master": "yarn"}))
    for unknown in ({}, {"spark.master": "local-cluster[2,1,1024]"}):
        with pytest.raises(RuntimeError):
            shared_folder(SimpleNamespace(conf=unknown))
    local = SimpleNamespace(conf={"spark.master": "local[2]"})
    assert shared_folder(local) == shared_folder(local)


def test_missing_and_empty_text_differ_in_an_extract(spark, tmp_path, frame):
    df = frame([("a", ""), ("b", None), ("c", "x")], "k string, v string")
    write_extract(df, str(tmp_path / "csv"))
    lines = {r[0] for r in spark.read.text(str(tmp_path / "csv")).collect()}
    assert lines == {"k,v", 'a,""', "b,", "c,x"}


def test_headers_that_differ(spark, tmp_path):
    put(tmp_path, "a.csv", "state,cases\nTexas,7\n")
    put(tmp_path, "b.csv", "cases,state,more\n8,Ohio,x\n")
    columns = {"state": "string", "cases": "long", "more": "string"}
    with pytest.raises(Exception, match="header"):
        read_feed(spark, str(tmp_path), columns).collect()
    got = read_mixed(spark, [str(tmp_path)], columns, file="file")
    assert {(r["state"], r["cases"], r["more"], r["file"].rsplit("/", 1)[1]) for r in got.collect()} == {("Texas", 7, None, "a.csv"), ("Ohio", 8, "x", "b.csv")}


def test_links_that_name_their_own_place():
    assert placed("a/b.csv", "/in/") == "/in/a/b.csv"
    assert placed("https://host/a.csv", "/in") == "https://host/a.csv" and placed("/x/a.csv", "/in") == "/x/a.csv" and placed("a.csv", None) == "a.csv"


def test_staged_files_go_with_their_work(spark, frame, tmp_path):
    from pathlib import Path

    def files(df):
        return [Path(f.removeprefix("file:")) for f in df.inputFiles()]

    kept = staged(frame([("a", 1)], "k string, x int"), "kept")
    with staging(spark):
        one = staged(frame([("a", 1)], "k string, x int"), "one")
        with staging(spark):
            inner = files(staged(one, "inner"))
        assert inner and not any(f.exists() for f in inner) and all(f.exists() for f in files(one))
        one.write.parquet(str(tmp_path / "out"))
        mine = files(one)
    assert mine and not any(f.exists() for f in mine) and all(f.exists() for f in files(kept))
    with pytest.raises(ZeroDivisionError), staging(spark):
        lost = files(staged(kept, "lost"))
        1 / 0
    assert not any(f.exists() for f in lost) and spark.read.parquet(str(tmp_path / "out")).count() == 1
