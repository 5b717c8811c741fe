from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tidewatch.llm.query_source_mix import SQL
from tidewatch.llm.source_mix import TOLERANCE, mix, mixed


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    stopped = set()
    while True:
        free, weight = sum(sizes.values()) - sum(cap * sizes[s] for s in stopped), sum(w[s] for s in names if s not in stopped)
        over = {s for s in names if s not in stopped and w[s] * (free / (weight or 1)) > cap * sizes[s]}
        if not over or len(over | stopped) == len(names):
            return {s: min(float(cap * sizes[s]), w[s] * (free / (weight or 1))) if s not in stopped else float(cap * sizes[s]) for s in names}
        stopped |= over


def expected(rows, tolerance=TOLERANCE):
    """(id, text, source) rows to a counter of (id, size, source size, target, taken)."""
    by_source = defaultdict(list)
    for at, (i, text, source) in enumerate(rows):
        key = int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
        text_key = (xxhash.xxh64(text.encode(), seed=42).intdigest() if text is not None else 42) >> 4
        by_source[source].append((key, text_key, at, size_of(text), i))
    total = {s: sum(x[3] for x in g) for s, g in by_source.items()}
    out = Counter()
    for s, target in targets(total).items():
        copies = math.floor(target / total[s]) if total[s] else 0
        left = most = math.floor(target - copies * total[s])
        near = math.floor(tolerance * target)
        taken, stop = set(), left <= near
        group = sorted(by_source[s])
        for x in group:
            if not stop and 0 < x[3] <= most:
                if x[3] <= left:
                    left -= x[3]
                    taken.add(x)
                else:
                    most, stop = left, left <= near
        rest = [(x[3], x) for x in group if x not in taken and x[3] > 0]
        if not stop and left > near and rest and min(rest)[0] - left < left:
            taken.add(min(rest)[1])
        for x in group:
            out[(x[4], x[3], total[s], target, x[3] * (copies + (x in taken)))] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "size", "source_size", "target", "taken").collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def corpus(rng, n, sources, hot=0.34):
    text = lambda: " ".join("w" * rng.randint(1, 9) for _ in range(int(rng.paretovariate(0.9)) % 900))
    same = text() + " same"
    return [(k, same if rng.random() < 0.2 else text(), sources[0] if rng.random() < hot else rng.choice(sources)) for k in range(n)]


@pytest.mark.parametrize("seed,n,sources", [(1, 300, ["b", "a", "é", None]), (2, 40, ["x"]), (3, 500, [f"s{k}" for k in range(40)]), (4, 7, ["p", "q", "r", "s"])])
def test_first_fit_in_hash_order(spark, seed, n, sources):
    rows = corpus(random.Random(seed), n, sources)
    out = found(mix(table(spark, rows)))
    assert out == expected(rows)
    for row in out:
        assert row[4] <= 3 * row[1]


def test_shares_come_near_their_targets(spark):
    rows = corpus(random.Random(9), 2000, ["a", "b", "c", "d"])
    sums = mix(table(spark, rows), carry=("doc_id", "source")).groupBy("source", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) <= 0.002 * r["target"] for r in sums)
    assert abs(sum(r["target"] for r in sums) - sum(size_of(t) for _, t, _ in rows)) < 1e-3


def test_equal_rows_null_ids_and_odd_texts(spark):
    rows = [(5, "one two three", "a")] * 50 + [(None, "one two", "a")] * 30 + [(None, f"t {'x ' * k}", "b") for k in range(20)]
    rows += [(7, None, "a"), (8, "", None), (9, " \n\t ", None), (10, "a\x85b c d", None), (11, "word " * 200_000, "c"), (12, "w" * 300_000, "b")]
    out = found(mix(table(spark, rows)))
    assert out == expected(rows)
    assert out == found(mix(table(spark, rows).repartition(5)))


def test_empty_and_wordless_tables(spark):
    assert mix(table(spark, [])).count() == 0
    out = mix(table(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in out] == [(0, 0.0, 0)] * 2


def test_rows_of_the_mix(spark):
    rows = corpus(random.Random(5), 200, ["a", "b", "c", None])
    plan = {r["doc_id"]: r["copies"] for r in mix(table(spark, rows)).collect()}
    crowded = table(spark, rows).select("doc_id", F.lit("s").alias("Size"), F.lit(None).cast("int").alias("target"), "source", F.lit(3).alias("_mix_h"), "text")
    out = mixed(crowded)
    assert out.columns == crowded.columns
    got = Counter((r["doc_id"], r["text"], r["source"], r["Size"]) for r in out.collect())
    assert got == Counter({(i, t, s, "s"): plan[i] for i, t, s in rows if plan[i]})


def test_clashing_names_and_other_weights(spark):
    rows = corpus(random.Random(6), 150, ["a", "b", "c"])
    crowded = table(spark, rows).withColumns({"TAKEN": F.lit(1), "copies": F.lit("x"), "_mix_source": F.lit(2)})
    assert found(mix(crowded)) == expected(rows)
    even = mix(table(spark, rows), weights=(1,), cap=1)
    assert all(r["target"] == r["source_size"] and r["taken"] == r["size"] for r in even.collect() if r["target"] >= r["source_size"])


def test_plan_is_native(spark):
    plan = mix(table(spark, corpus(random.Random(7), 60, ["a", "b"])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_sql(spark, con, tmp_path):
    from compare import difference

    from tidewatch.llm.query_source_mix import op12_source_mix

    assert difference(op12_source_mix(spark, "/root/testdata/sf0.001"), con, SQL) is None
