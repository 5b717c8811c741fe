from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import ranked_search
from tidewatch.llm.ranked_search import automaton, count_terms, item_terms, norms, search

LOWER = {c: c + 32 for c in range(65, 91)}
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, k=10):
    """(item, rank, doc, score) rows, by the definition."""
    held = [(i, terms_of(t)) for i, t in docs]
    big_n, big_l = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = Counter(t for _, ts in held for t in set(ts))
    out = []
    for item, text in sorted({x for x in items if None not in x}):
        scores = []
        for i, ts in held:
            tf, n = Counter(ts), len(ts)
            score = 0
            for t in terms_of(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * tf[t] // (1000 * tf[t] + 8 * (25 + 75 * n * big_n // big_l)))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


VOCABULARY = "a b ab ba aba x x1 1 été ÉTÉ Ете naïve don t the The THE of in-on z".split()


def texts(rng, n, longest=40):
    return [rng.choice(["", "  ", "-"]) + rng.choice([" ", ".", "_", "\x00", "\n", "  "]).join(rng.choices(VOCABULARY, k=rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("seed,block,cells", [(1, 1 << 20, 1 << 21), (2, 60, 1 << 21), (3, 1 << 20, 50)])
def test_against_the_definition(spark, monkeypatch, seed, block, cells):
    monkeypatch.setattr(ranked_search, "CELLS", cells)
    rng = random.Random(seed)
    docs = [*enumerate(texts(rng, 150)), (None, "a b the of"), (None, "a b the of"), (7, "x1 the"), (900, None), (901, "")]
    items = [*enumerate(texts(rng, 12, 8)), (3, "the of the"), (3, "the of the"), (50, None), (None, "the"), (51, ""), (52, "absent words")]
    assert found(search(*tables(spark, docs, items), block=block)) == expected(docs, items)


def test_ties_among_copies(spark):
    docs = [(k, "same words here") for k in range(200, 0, -1)] + [(500, "other text"), (501, "words words")]
    d, i = tables(spark, docs, [(1, "words words here"), (2, "same")])
    assert found(search(d.repartition(7), i)) == expected(docs, [(1, "words words here"), (2, "same")])


def test_pieces_of_a_long_text():
    rng = random.Random(4)
    text = ("".join(rng.choice([" ", "-", ""]) + rng.choice(VOCABULARY) for _ in range(3000))).encode()
    block = item_terms([("1", " ".join(VOCABULARY))])
    machine = automaton(block.terms)
    buf, at = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole = count_terms(machine, buf, at)
    assert int(whole[0][0]) == len(terms_of(text.decode()))
    for piece in (1, 2, 7, 100, len(text) - 1, len(text)):
        cut = count_terms(machine, buf, at, piece)
        assert all(np.array_equal(a, b) for a, b in zip(whole, cut))


def test_very_long_texts(spark):
    docs = [(1, "alpha beta " * 300_000), (2, "w" * 2_000_000 + " alpha"), (3, "beta"), (4, "gamma")]
    items = [(1, "alpha"), (2, "beta alpha")]
    assert found(search(*tables(spark, docs, items))) == expected(docs, items)


def test_norms_beyond_64_bits():
    n = np.array([10**7, 5])
    assert norms(n, 10**12, 10**15).tolist() == [25 + 75 * 10**7 * 10**12 // 10**15, 25]


def test_empty_tables(spark):
    for docs, items in (([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None), (2, "--")], [(1, "a")])):
        out = search(*tables(spark, docs, items))
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_other_columns(spark):
    rng = random.Random(6)
    docs, items = list(enumerate(texts(rng, 40))), list(enumerate(texts(rng, 5, 6)))
    d, i = tables(spark, docs, items)
    extra = {c: F.lit("x") for c in ("rank", "SCORE", "terms", "counts", "n", "number")}
    assert found(search(d.withColumns(extra), i.withColumns(extra | {"doc_id": F.lit(None)}))) == expected(docs, items)


def test_sql(spark, con):
    from compare import difference

    from tidewatch.llm.query_ranked_search import SQL, op11_ranked_search

    assert difference(op11_ranked_search(spark, "/root/testdata/sf0.001"), con, SQL) is None
