from __future__ import annotations

import re

import numpy as np
import pytest

from tidewatch.llm.decontaminate import find, probe, remove, search, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(low(text or ""))


def expected(texts, items):
    windows = {}
    for i, t in items:
        w = words(t)
        if i is None or not w:
            continue
        k = min(10, len(w))
        for p in range(len(w) - k + 1):
            windows.setdefault(tuple(w[p : p + k]), set()).add(str(i))
    out = []
    for t in texts:
        w, hit, names = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                found = windows.get(tuple(w[p : p + k]))
                if found:
                    hit.update(range(p, p + k))
                    names |= found
        out.append((len(w), len(hit), sorted(names)))
    return out


def vocabulary(n, rng):
    return [f"w{k}" if k % 3 else f"é{k}" for k in range(n)]


def cases():
    rng = np.random.default_rng(1)
    vocab = vocabulary(30, rng)
    items = [(k, " ".join(rng.choice(vocab, rng.integers(1, 40)))) for k in range(12)]
    items += [(100, items[0][1]), (101, items[3][1] + " tail words"), (None, "w1 w2"), (102, None), (103, ""), (104, "..."), (105, "W4"), (104, items[5][1])]
    texts = [" ".join(rng.choice(vocab, rng.integers(0, 60))) for _ in range(30)]
    for k in range(20):
        passage = items[k % 12][1]
        cut = passage.split()[k % 5 :]
        texts.append(f"Start {texts[k]} {'! '.join(cut).upper()}, {texts[k + 1]}")
    texts += [None, "", "...", texts[31], texts[31], " ".join(rng.choice(vocab, 30000)) + " " + items[1][1], "x" * 100000, "1234 5678"]
    return texts, items


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_against_all_windows(spark, docs, block):
    texts, items = cases()
    bench = spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, n_words string")
    got = find(docs(texts), bench, block=block)
    assert got.columns[:6] == ["doc_id", "text", "lang", "source", "n_chars", "score_note"]
    rows = {r["doc_id"]: r for r in got.collect()}
    for k, want in enumerate(expected(texts, items)):
        r = rows[k]
        assert (r["n_words"], r["n_hit"], r["items"]) == want, texts[k]
        assert r["contaminated"] == (want[1] > 0)
        w = words(texts[k])
        for m in r["matches"]:
            passage = words(dict((str(i), t) for i, t in items if i is not None and t)[m["item_id"]]) if m["item_id"] not in ("104",) else None
            if passage:
                a, b, n = m["item_word"], m["doc_word"], m["words"]
                assert w[b : b + n] == passage[a : a + n]
                assert w[b + n : b + n + 1] != passage[a + n : a + n + 1] or len(w) == b + n or len(passage) == a + n
        assert r["longest_match"] == max([m["words"] for m in r["matches"]], default=0)
    kept = remove(docs(texts), bench, block=block)
    assert kept.columns == docs(texts).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [k for k, want in enumerate(expected(texts, items)) if not want[1]]


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = find(docs(["a b c", None]), bench).collect()
    assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows] == [(3, 0, [], False), (0, 0, [], False)]
    assert remove(docs(["a b c"]), bench).count() == 1
    full = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert find(docs([]), full).count() == 0
    assert remove(docs([]), full).count() == 0


def test_suffixes_are_sorted():
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 4, 500)
    for depth in (2, 7, 64):
        got = [tuple(tokens[i : i + depth].tolist()) for i in suffix_array(tokens, depth)]
        # what follows a 0 is not ordered: compare up to the first one
        cut = [t[: t.index(0)] if 0 in t else t for t in got]
        assert cut == sorted(cut, key=lambda t: t + ((0,) if len(t) < depth else ())) or all(a <= b or a[: len(b)] == b for a, b in zip(cut, cut[1:]))
        assert sorted(suffix_array(tokens, depth).tolist()) == np.flatnonzero(tokens).tolist()


def test_search_gives_the_longest_match():
    p = probe([("a", "x y z x y"), ("b", "y z")], window=2)
    code = {w: k for k, w in enumerate(p.vocabulary)}
    assert len(code) == 3
    order = p.codes[:3]
    x, y, z = order.tolist()
    tokens = np.array([x, y, z, 0, y, z, x, y, 0])
    which, place, long = search(suffix_array(tokens, 8), tokens, p)
    found = {(int(p.start[w]), int(q)): int(n) for w, q, n in zip(which, place, long)}
    assert found[(0, 0)] == 3 and found[(1, 4)] == 4 and found[(0, 6)] == 2 and found[(5, 1)] == 2


def test_a_full_block_stays_within_its_bound():
    """Arrays of a block of 4 MB, whatever its words: short ones, repeated texts, one long item."""
    import pickle
    import tracemalloc

    from tidewatch.llm.decontaminate import BLOCK

    rng = np.random.default_rng(5)
    vocab = np.array([f"w{k}" for k in range(60_000)])
    long = " ".join(rng.choice(vocab, BLOCK // 14))
    items = [("long", long), *((str(k), "a b c " * 40) for k in range(BLOCK // 960)), *((f"x{k}", t) for k, t in enumerate(map(" ".join, rng.choice(vocab, (BLOCK // 4 // 280, 40)))))]
    assert 0.9 * BLOCK <= sum(len(t) for _, t in items) <= 1.2 * BLOCK
    tracemalloc.start()
    p = probe(items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6 and len(pickle.dumps(p)) < 80e6
    assert len({int(c) for c in p.window_class}) + 0 == len(p.class_items[0]) - 1
