from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.conversation_repair import as_rows, damage, repair, report
from tidewatch.llm.query_conversation_repair import SQL
from tidewatch.llm.role_grammar import START, after_row, deleted, ended

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def word(x):
    return " " if x is None else str(x)


def damaged(rows):
    for conv, turn, role, text in rows:
        part = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        if part == 0:
            continue
        text = "" if part == 1 else re.sub("[.!?]", "", text) if part == 2 else text
        yield from [(conv, turn, "user" if part == 4 else role, text)] * (2 if part == 3 else 1)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """Dijkstra over (rows read, roles so far as a state), by (cost, audit, lines)."""
    step = {("z", "s"): "s", ("z", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    best = {(0, "z"): (0, "", ())}
    for k in range(len(rows) + 1):
        for _ in range(2):
            for state in "zsua":
                if (k, state) in best:
                    cost, audit, lines = best[k, state]
                    for x in "ua":
                        if (state, x) in step:
                            to, way = (k, step[state, x]), (cost + 2, audit + "I", (*lines, f"{names[x]}:"))
                            best[to] = min(best.get(to, way), way)
        if k == len(rows):
            break
        _, role, text = rows[k]
        for state in "zsua":
            if (k, state) not in best:
                continue
            cost, audit, lines = best[k, state]
            ways = [(state, (cost + 3, audit + "D", lines))]
            if marks[k] not in ("blank", "duplicate"):
                extra = int(marks[k] == "truncated")
                if (state, role[:1]) in step:
                    ways.append((step[state, role[:1]], (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
                ways += [(step[state, x], (cost + 2 + extra, audit + "R", (*lines, f"{names[x]}:{text}"))) for x in "ua" if (state, x) in step]
            for to, way in ways:
                best[k + 1, to] = min(best.get((k + 1, to), way), way)
    return min(best[len(rows), x] for x in "za" if (len(rows), x) in best)


def expected(rows, after):
    held = defaultdict(list)
    for conv, turn, role, text in after:
        held[conv].append((turn, role, text))
    out = []
    for conv in {r[0] for r in rows}:
        here = sorted(held[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        marks = faults(here)
        known = [t for t, _, _ in here if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for _, r, _ in here]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(here, marks)
        count = Counter(marks)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "uploader", "User"]
TEXTS = ["Yes.", "No!", "cut", "", " \n", None, "why? ", "a\nb.", "Ünd.", "x.\x0b", "é"]


def corpus(rng, conversations, longest):
    for conv in conversations:
        turns = [rng.choice([None, t, t, t, t, t]) for t in range(rng.randint(0, longest))]
        yield from ((conv, t, rng.choice(ROLES), rng.choice(TEXTS) if rng.random() < 0.6 else f"text {rng.randint(0, 99)}.") for t in turns)


@pytest.mark.parametrize("seed,longest", [(1, 4096), (2, 5), (3, 1), (4, 12)])
def test_against_dynamic_programming(spark, seed, longest):
    rng = random.Random(seed)
    rows = [*corpus(rng, [None, *range(40)], 9), *corpus(rng, [100, 101, -7], 60)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(report(damage(df), longest)) == expected(rows, damaged(rows))
    plain = [(c, t, word(r), word(x)) for c, t, r, x in rows]
    assert found(report(as_rows(df), longest)) == expected(rows, plain)


def test_all_short_sequences():
    """Every sequence of up to five rows and every way to edit it."""
    kinds = [("u", ""), ("a", ""), ("s", ""), ("t", "truncated"), ("u", "blank"), ("a", "truncated")]
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            front = {START: (0, "", "")}
            for initial, fault in rows:
                front = deleted(front) if fault == "blank" else after_row(front, initial, fault == "truncated")
            cost, audit, made = ended(front)[1]
            named = [(k, {"u": "user", "a": "assistant", "s": "system", "t": "tool"}[i], "x") for k, (i, _) in enumerate(rows)]
            want = cheapest(named, [f for _, f in rows])
            assert (cost, audit) == want[:2]
            assert LEGAL.fullmatch(made.replace("-", "")) and [line[0] for line in want[2]] == list(made.replace("-", ""))


@pytest.mark.parametrize("longest", [4096, 50])
def test_one_conversation_with_a_third_of_all_rows(spark, longest):
    rng = random.Random(8)
    hot = [(5, k % 400 if k % 3 else None, rng.choice(ROLES[:5]), f"text {k % 150}.") for k in range(900)]
    same = [(6, 3, "user", "again")] * 300 + [(None, None, "assistant", "so.")] * 200
    rows = [*hot, *same, *corpus(rng, range(10, 80), 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(report(as_rows(df), longest)) == expected(rows, [(c, t, word(r), word(x)) for c, t, r, x in rows])


def test_very_long_texts_and_names(spark):
    rows = [(1, 0, "user", "long " * 400_000), (1, 1, "assistant", "x" * 2_000_000 + "."), (2, 0, "user" * 1000, ".")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(report(as_rows(df))) == expected(rows, rows)


def test_pieces_hold_the_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "Two."), (1, 3, "user", "open")]
    for longest in (10, 2):
        pieces = repair(as_rows(spark.createDataFrame(rows, SCHEMA)), longest).orderBy("piece").collect()
        turns = [tuple(t) for p in pieces for t in p["turns"]]
        assert turns == [("user", "Hi."), ("assistant", "Two.")]
        assert "".join(p["audit"] for p in pieces) == "KDRD" and {p["pieces"] for p in pieces} == {len(pieces)}


def test_empty_and_all_gone(spark):
    assert report(damage(spark.createDataFrame([], SCHEMA))).count() == 0
    gone = [(c, t, "user", "x.") for c in range(400) for t in [1] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    for longest in (4096, 0):
        rows = found(report(damage(spark.createDataFrame(gone, SCHEMA)), longest))
        assert [r[1:] for r in rows] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())] * len(gone)


def test_other_columns(spark):
    rows = list(corpus(random.Random(3), range(10), 8))
    df = spark.createDataFrame(rows, SCHEMA)
    names = ("_conv", "_GONE", "piece", "audit", "turns", "cost", "gaps", "_n")
    crowded = df.withColumns({c: F.lit("x") for c in names})
    assert found(report(damage(crowded), 4)) == found(report(damage(df), 4))


def test_sql(spark, con):
    from compare import difference

    from tidewatch.llm.query_conversation_repair import op13_conversation_repair

    assert difference(op13_conversation_repair(spark, "/root/testdata/sf0.001"), con, SQL) is None


def test_sql_on_odd_rows(spark, tmp_path):
    import duckdb
    from compare import difference

    rows = list(corpus(random.Random(12), [None, *range(60)], 12))
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{tmp_path}/c")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    assert difference(report(damage(df)), con, SQL) is None
