from __future__ import annotations

import math
import re

import pytest

from tidewatch.llm import license_scan
from tidewatch.llm.license_scan import EXACT, LEAST, LICENCE_FILE, MARGIN, own_licences, scan
from tidewatch.llm.license_templates import TEMPLATES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def count(ws):
    out = {}
    for w in ws:
        out[w] = out.get(w, 0) + 1
    return out


def own(texts):
    vocab = {w for t in TEMPLATES for w in (*words(t.text), *t.must, *t.never)}
    n = len(texts)
    df = {w: sum(w in set(words(t or "")) for t in texts) for w in vocab}
    idf = lambda w: math.log((1 + n) / (1 + df.get(w, 0))) + 1
    vec = lambda ws: {w: c * idf(w) for w, c in count(ws).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    models = [(t, vec(words(t.text))) for t in TEMPLATES]
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        groups, now = [], []
        for line in [*lines, ""]:
            if words(line):
                now.append(line)
            elif now:
                groups.append("\n".join(now))
                now = []
        best, name, at = 0.0, None, 0
        for unit in [*lines, *groups, text or ""]:
            v = vec(words(unit))
            if not v:
                continue
            meant = [(k, t, m) for k, (t, m) in enumerate(models) if t.must <= set(v) and not t.never & set(v)]
            near = [(round(sum(x * m.get(w, 0) for w, x in v.items()) / norm(v) / norm(m), 10), -k, t.name) for k, t, m in meant]
            if not near:
                continue
            c, k, licence = max(near)
            if c < EXACT and c - max([x[0] for x in near if x[2] != licence], default=0) < MARGIN:
                continue
            if (c, k) > (best, -at):
                best, name, at = c, licence, -k
        out.append((name if best >= LEAST - 1e-9 else None, best))
    return out


def expected(paths, texts):
    mine = own(texts)
    folder = lambda p: None if p is None else p.rsplit("/", 1)[0] if "/" in p else ""
    holders = {}
    for p, (name, score) in zip(paths, mine):
        if p is not None and name and re.match(LICENCE_FILE, p.rsplit("/", 1)[-1]):
            key = (-round(score, 9), p)
            holders[folder(p)] = min(holders.get(folder(p), (key, name)), (key, name))
    out = []
    for p, (name, score) in zip(paths, mine):
        where = None
        if name is None and p is not None:
            parts = folder(p).split("/") if folder(p) else []
            where = next((d for d in ("/".join(parts[:k]) for k in range(len(parts), -1, -1)) if d in holders), None)
        licence = name or (holders[where][1] if where is not None else None)
        out.append((name, round(score, 6), licence, "own" if name else "inherited" if where is not None else "none", where))
    return out


APACHE, MIT, GPL, CC = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0."


def test_against_plain_vectors(spark):
    notice = next(t.text for t in TEMPLATES if t.text.startswith("Licensed under the Apache License, Version 2.0 (the"))
    half = len(notice) // 2
    files = [
        ("a/LICENSE", APACHE), ("a/b/x.txt", "no licence here"), ("a/b/c/LICENSE.md", MIT), ("a/b/c/y.txt", "text\n\ntext"), ("a/b/c/d/e/z.txt", None),
        ("top.txt", "words"), ("q/x.txt", f"prose before\n{GPL}\nprose after that goes on"), ("q/y.txt", ""), ("p/LICENSE", "not a licence at all"), ("p/x", "x y"),
        ("w/long.txt", f"header\n\n{notice[:half]}\n{notice[half:]}\n\n" + "filler words " * 500), ("w/two.txt", f"{CC}\n{MIT}"), (None, MIT), (None, "nothing"),
        ("r/COPYING", GPL), ("r/LICENCE", GPL.upper()), ("r/NOTICE.txt", MIT), ("r/s/t.txt", "é 漢"), ("a/b/x.txt", "no licence here"), ("dup/LICENSE", APACHE), ("dup/LICENSE", APACHE), ("dup/k", "k"),
        ("z/mixed.txt", "the License applies to this and that under the terms"), ("v/x", "x " * 60_000 + "\n" + APACHE),
    ]
    source = spark.createDataFrame([(k, p, t, "clash") for k, (p, t) in enumerate(files)], "k int, path string, text string, holder string")
    rows = sorted(scan(source).collect(), key=lambda r: r["k"])
    got = [(r["own"], round(r["score"], 6), r["licence"], r["origin"], r["origin_directory"]) for r in rows]
    want = expected([p for p, _ in files], [t for _, t in files])
    for g, w, f in zip(got, want, files):
        assert g[0] == w[0] and g[2:] == w[2:] and g[1] == pytest.approx(w[1], abs=2e-6), f


def test_a_licence_at_the_top_and_empty_table(spark):
    source = spark.createDataFrame([(1, "LICENSE", MIT), (2, "a/b", "x")], "k int, path string, text string")
    assert {r["k"]: (r["licence"], r["origin_directory"]) for r in scan(source).collect()} == {1: ("MIT", None), 2: ("MIT", "")}
    assert scan(source.limit(0)).count() == 0


def gnu(name, version, work="program"):
    return (
        f"# This {work} is free software; you can redistribute it and/or\n# modify it under the terms of the GNU {name}General Public License\n# as published by the Free Software Foundation; either"
        f" version {version}\n# of the License, or (at your option) any later version.\n#\n# This {work} is distributed in the hope that it will be useful,\n# but WITHOUT ANY WARRANTY; without even the implied"
        f" warranty of\n# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n# GNU {name}General Public License for more details."
    )


BSD = (
    "Copyright (c) 2020, Someone\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
    " conditions are met:\n\n* Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n* Redistributions in binary"
    " form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
THIRD = "\n* Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
HEADERS = [
    (gnu("", "2"), "GPL-2.0"), (gnu("", "3"), "GPL-3.0"), (gnu("Lesser ", "2.1", "library"), "LGPL-2.1"), (gnu("Lesser ", "3", "library"), "LGPL-3.0"), (gnu("Affero ", "3"), "AGPL-3.0"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\nCopyright (C) 1989 Someone", "GPL-2.0"), ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nPreamble", "GPL-3.0"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", "LGPL-2.1"), ("Licensed under the GPLv3.", "GPL-3.0"), ("Licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    (BSD, "BSD-2-Clause"), (BSD + THIRD, "BSD-3-Clause"), ("Licensed under the BSD 3-Clause License.", "BSD-3-Clause"), ("Licensed under the 2-Clause BSD License", "BSD-2-Clause"),
    ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 3.0.", "CC-BY-SA-3.0"), ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
    ("This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"), (CC, "CC-BY-NC-4.0"),
    ("// SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0"), ("# SPDX-License-Identifier: CC-BY-NC-SA-4.0", "CC-BY-NC-SA-4.0"), ("SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    ("Licensed under the Eclipse Public License, Version 2.0.", "EPL-2.0"), ("made available under the terms of the Eclipse Public License v1.0", "EPL-1.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"), (APACHE, "Apache-2.0"), (MIT, "MIT"), (GPL, "GPL-3.0"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"), ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.", "0BSD"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", "ISC"),
    # no licence that is known, or none at all
    ("Licensed under the Foo Public License, Version 2.0.", None), ("Licensed under the GNU General Public License, version 4.", None), ("Licensed under the Example License.", None), ("SPDX-License-Identifier: Foo-1.0", None),
    ("The licence of a driver was issued by the general public office in 2007.", None), ("by and by the permission was granted free of charge", None), ("You are licensed to drive under the following terms and conditions", None),
]


def test_every_header_has_its_own_name(spark):
    prose = [(1000 + k, f"ordinary prose number {k} of the corpus, by the author, with 2 or 3 words under the line", "x") for k in range(60)]
    files = spark.createDataFrame([(k, t, "x") for k, (t, _) in enumerate(HEADERS)] + prose, "k int, text string, path string")
    got = {r["k"]: r["own"] for r in own_licences(files).collect()}
    wrong = [(t[:70], got[k], want) for k, (t, want) in enumerate(HEADERS) if got[k] != want]
    assert not wrong, wrong
    assert not any(got[k] for k in got if k >= 1000)


def test_templates_mean_what_they_say(spark):
    """Each template is named by its own text."""
    files = spark.createDataFrame([(k, t.text) for k, t in enumerate(TEMPLATES)], "k int, text string")
    got = {r["k"]: r["own"] for r in own_licences(files).collect()}
    assert [(t.name, t.text, got[k]) for k, t in enumerate(TEMPLATES) if got[k] != t.name] == []


def test_a_hot_directory_is_dealt_over_pieces(spark):
    rows = [(k, f"hot/{k}.txt") for k in range(400)] + [(1000, "hot/LICENSE"), (1001, "cold/x"), (1002, None)]
    placed = spark.createDataFrame(rows, "k int, path string").withColumn("_directory", license_scan.directory("path"))
    nearest = spark.createDataFrame([("hot", ("MIT", "hot"))], "_directory string, _from struct<licence: string, holder: string>")
    few, many = (license_scan._joined(placed, nearest, "path", n) for n in (10, 0))
    key = lambda df: sorted(map(str, df.select("k", "path", "_directory", "_from").collect()))
    assert key(few) == key(many) and few.columns == many.columns


def test_directories_beyond_what_fits_are_not_broadcast(spark, monkeypatch, tmp_path):
    """Files that are small do not mean that the driver can hold the directories: 16 copies of each are joined."""
    placed = spark.createDataFrame([(k, f"{k % 7}/{k}.txt") for k in range(100)] + [(100, None)], "k int, path string").withColumn("_directory", license_scan.directory("path"))
    nearest = spark.createDataFrame([(str(k), ("MIT", "")) for k in range(5)], "_directory string, _from struct<licence: string, holder: string>")
    nearest.write.parquet(f"{tmp_path}/nearest")
    nearest = spark.read.parquet(f"{tmp_path}/nearest")
    key = lambda df: sorted(map(str, df.select("k", "path", "_directory", "_from").collect()))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    few, many = (license_scan._joined(placed, nearest, "path", n) for n in (5, 4))
    assert key(few) == key(many) and "BroadcastHashJoin" in plan(few)
    assert "SortMergeJoin" in plan(many) and "Broadcast" not in plan(many)
    monkeypatch.setattr(license_scan, "LARGE", 10, raising=False)  # bytes, for long paths
    wide = license_scan._joined(placed, nearest, "path", 5)
    assert key(few) == key(wide) and "Broadcast" not in plan(wide)


def test_inheritance_beyond_what_fits(spark, monkeypatch):
    files = [("LICENSE", MIT), ("top", "x"), ("a/b/c/x", "x"), ("a/LICENSE", APACHE), ("a/y", "y"), ("a/b/COPYING", "nothing"), ("d//LICENSE", GPL), ("d//e/z", "z"), (None, "n"), (None, None), ("a/y", "y"), ("a/y", CC)]
    source = spark.createDataFrame([(k, p, t) for k, (p, t) in enumerate(files)], "k int, path string, text string")
    few = sorted(scan(source).collect(), key=lambda r: r["k"])
    monkeypatch.setattr(license_scan, "LARGE", -1, raising=False)
    many = scan(source)
    assert sorted(many.collect(), key=lambda r: r["k"]) == few and "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
    want = expected([p for p, _ in files], [t for _, t in files])
    assert [(r["own"], r["licence"], r["origin"], r["origin_directory"]) for r in few] == [(w[0], *w[2:]) for w in want]


def test_very_long_texts(spark):
    files = spark.createDataFrame([(1, "word " * 600_000 + "\n\n" + APACHE), (2, "license " * 400_000), (3, "x" * 3_000_000)], "k int, text string")
    assert {r["k"]: r["own"] for r in own_licences(files).collect()} == {1: "Apache-2.0", 2: None, 3: None}
