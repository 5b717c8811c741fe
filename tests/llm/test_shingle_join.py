from __future__ import annotations

import random

import numpy as np
import pytest

from tidewatch.llm import shingle_join
from tidewatch.llm.components import components
from tidewatch.llm.shingle_join import distinct_documents, grouped, links_between, pair_signatures, prefix, spanning_links, token_classes, top_band


def shingle_set(text):
    w = []
    for part in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" "):
        if part:
            w.append(part)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def expected(ids, texts):
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for k in range(len(sets)):
        if ids[k] is not None:
            least[root(k)] = min(ids[k], least.get(root(k), ids[k]))
    return sorted((ids[k] if ids[k] is not None else -1, len(sets[k]), least.get(root(k), -1) if sets[k] else (ids[k] if ids[k] is not None else -1)) for k in range(len(sets)))


def rows(df):
    null = lambda x: -1 if x is None else x
    return sorted((null(r[0]), r["n_shingles"], null(r["component_id"])) for r in df.collect())


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
    return words


def cases(seed=10):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage = text(40)
    texts = []
    for n in (4, 5, 8, 9, 12, 20, 33, 64, 130, 300):  # near copies at every size, some too far
        base = text(n)
        texts += [changed(rng, base, rng.randint(0, max(1, n // 20))) for _ in range(6)]
    hub = text(150)
    texts += [changed(rng, hub, rng.randint(0, 5)) for _ in range(60)]  # copies of one text that link through it only
    texts += [hub[:k] for k in range(100, 150, 5)]
    texts += [passage + text(rng.randint(3, 12)) for _ in range(30)]  # a common passage, nearly but not quite enough
    texts += [text(30) + passage + text(30) for _ in range(20)]
    texts += [text(60) for _ in range(20)]
    joined = [" ".join(t) for t in texts]
    joined += [joined[0], joined[10].upper(), joined[10], "  " + joined[70].replace(" ", "\n\t "), None, "", " \n", "one", "one", "two words", "a b c d", "a b c d e", "É é", "é é", "x " * 3000, "x " * 50]
    rng.shuffle(joined)
    return joined


@pytest.mark.parametrize("rare,block", [(8, 4096), (3, 16), (1000, 4096)])
def test_against_all_pairs(docs, rare, block):
    texts = cases()
    ids = [*range(100, 100 + len(texts) - 1), None]
    got = grouped(docs(texts, ids), rare=rare, block=block)
    assert rows(got) == expected(ids, texts)


def test_kept_documents(docs):
    texts = cases(11)
    ids = [7 * k % 1009 for k in range(len(texts))]
    source = docs(texts, ids).union(docs([texts[0], texts[0]], [ids[0], ids[0]]))
    kept = distinct_documents(source)
    assert kept.columns == source.columns
    got = sorted(r["doc_id"] for r in kept.select("doc_id").collect())
    want = sorted(i for i, n, c in expected(ids, texts) if i == c)
    empty = not shingle_set(texts[0])
    assert got == sorted(want + [ids[0]] * 2 if empty else want)


def test_rows_that_share_an_id_are_told_apart(docs):
    a, b, c = (" ".join(f"{w}{k}" for k in range(40)) for w in "abc")
    near = b + " more"
    rows = [(5, a), (5, b), (1, a), (7, c), (7, c + " more"), (7, ""), (None, a), (None, near), (None, "x y z"), (None, "x y z"), (None, None)]
    kept = distinct_documents(docs([t for _, t in rows], [i for i, _ in rows])).collect()
    got = [(r["doc_id"], r["text"]) for r in kept]
    assert len(got) == 6 and (1, a) in got and (5, b) in got and (7, "") in got and (None, "x y z") in got and (None, None) in got
    assert sum(i == 7 and t in (c, c + " more") for i, t in got) == 1


def test_empty_table(docs):
    assert grouped(docs([])).count() == 0 and distinct_documents(docs([])).count() == 0
    assert distinct_documents(docs([None, "", None])).count() == 3


def test_prefixes_hold_shared_tokens():
    rng = np.random.default_rng(3)
    for n in (4, 9, 16, 40, 100, 257):
        for _ in range(20):
            base = rng.choice(1 << 40, n, replace=False).astype(np.uint64)
            drop = rng.integers(0, n // 5 + 1)
            x = np.sort(base)
            y = np.sort(np.append(base[drop:], rng.choice(1 << 40, rng.integers(0, 3), replace=False).astype(np.uint64)))
            common = len(np.intersect1d(x, y))
            if 5 * common < 4 * (len(x) + len(y) - common):
                continue
            b = max(top_band(np.array([0 + min(len(x), len(y))]))[0], 0)
            top = int(np.frexp(float(max(len(x), len(y))))[1] - 1)
            assert top <= b
            g = int(token_classes(np.array([top]))[0])
            px, py = (s[: int(prefix(np.array([len(s)]), np.array([top]))[0])] for s in (x, y))
            assert len(np.intersect1d(px, py)) >= min(g + 1, common)
            assert len(np.intersect1d(pair_signatures(x, len(x), 0), pair_signatures(y, len(y), 0)))


def test_spanning_links_connect_what_links():
    rng = np.random.default_rng(4)
    base = rng.choice(1 << 40, 60, replace=False).astype(np.uint64)
    index = [np.setdiff1d(base, rng.choice(base, k % 14)) for k in range(80)]
    n = np.array([len(x) for x in index])
    found = spanning_links(index, n, -n.astype(float))

    def groups(pairs):
        label = list(range(len(index)))
        for _ in label:
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    everything = [(k, int(o)) for k, near in links_between(index, n, ((k, index[k], int(n[k])) for k in range(len(index)))) for o in near]
    assert groups(found) == groups(everything)


def test_components(spark):
    rng = random.Random(5)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(7, x) for x in range(8, 60)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(3, 3), (None, 4)]
    label = {}
    for a, b in pairs:
        if a is not None and a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    for _ in label:
        for a, b in pairs:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
    assert groups(got) == groups(label)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_two_ways_of_filtering_sets(docs, monkeypatch):
    texts = cases(12)
    ids = list(range(len(texts)))
    monkeypatch.setattr(shingle_join, "KEYS_LIMIT", 0)
    assert rows(grouped(docs(texts, ids))) == expected(ids, texts)


def test_a_small_limit_of_frequent_tokens(docs, monkeypatch):
    texts = cases(13)
    ids = list(range(len(texts)))
    monkeypatch.setattr(shingle_join.frequent_tokens, "__defaults__", (shingle_join.RARE, 20))
    assert rows(grouped(docs(texts, ids))) == expected(ids, texts)


def test_classes_without_tokens_do_not_end_the_choice():
    assert shingle_join.least_class({4: 50, 5: 20, 9: 3, 14: 1}, 100) == 4
    assert shingle_join.least_class({4: 50, 5: 20, 9: 3, 14: 1}, 24) == 5
    assert shingle_join.least_class({14: 9}, 5) == 15 and shingle_join.least_class({}, 5) == 1


def test_probes_are_dealt_over_tasks(docs, monkeypatch):
    """Blocks of two sets and deals of few tokens: the links across blocks are the same."""
    rng = random.Random(31)
    base = [" ".join(rng.choice(["aa", "bb", "cc", "dd", "ee"]) + str(rng.randint(0, 9)) for _ in range(60)) for _ in range(4)]
    texts = []
    for b in base:
        for k in range(14):
            w = b.split()
            w[rng.randrange(len(w))] = f"x{k}"
            texts.append(" ".join(w))
    want = {i: c for i, _, c in expected(list(range(len(texts))), texts)}
    dealt, seen = shingle_join._probed, []

    def small(home, sent, tokens=0):
        seen.append(1)
        return dealt(home, sent, 100)

    monkeypatch.setattr(shingle_join, "_probed", small)
    got = {r["doc_id"]: r["component_id"] for r in grouped(docs(texts), rare=2, block=2).collect()}
    assert got == want and seen
