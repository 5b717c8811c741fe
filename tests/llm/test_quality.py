from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import decision_list, quality

STATS = quality.STATS


def corpus(n=400):
    rng = random.Random(8)
    words = "the of and to in is that for was with as are this be on by from at an or it".split()
    texts, labels = [], []
    for _ in range(n):
        w = [rng.choice(words) + rng.choice(["", "", "ing", "ed", "er"]) for _ in range(rng.randint(30, 120))]
        kind = rng.randint(0, 5)
        if kind == 0:
            texts.append(" ".join(x + rng.choice(["###", "$$$", "%%%"]) for x in w))
        elif kind == 1:
            texts.append(" ".join(x.upper() + "!!" for x in w))
        else:
            texts.append(" ".join(w).capitalize() + ".\n" + " ".join(reversed(w)) + ".")
        labels.append(int(kind > 1))
    return texts, labels


@pytest.fixture
def labelled(spark, docs):
    texts, labels = corpus()
    ids = [*range(len(texts)), None, 900, 901, 902]
    odd = [None, "", "x" * 50_000, "a " * 40_000]
    source = docs([*texts, *odd], ids).union(docs([texts[0]] * 2, [0, 0]))
    table = spark.createDataFrame([(i, y, 0) for i, y in enumerate(labels)] + [(None, 1, 0), (5, None, 0), (3, labels[3], 1)], "doc_id long, quality int, toxic int")
    return source, table, dict(enumerate(labels)), texts


def fold(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_ranking_on_held_out_rows(labelled):
    source, table, labels, _ = labelled
    got = quality.score(source, table)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.collect()
    assert len(rows) == 406
    for r in rows:
        assert r["held_out"] == fold(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) >= 0.95


def test_labels_of_held_out_rows_do_not_matter(spark, labelled):
    source, table, _, _ = labelled
    from pyspark.sql import functions as F

    from tidewatch.llm.quality_folds import held_out

    turned = table.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    a, b = (sorted(quality.score(source, t).collect(), key=key) for t in (table, turned))
    assert a == b
    assert decision_list.learn(decision_list.text_stats(source), table) == decision_list.learn(decision_list.text_stats(source), turned)


def test_accepted_keeps_columns_and_good_texts(labelled):
    source, table, labels, _ = labelled
    kept = quality.accepted(source, table)
    assert kept.columns == source.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    scored = {r["doc_id"]: r["predicted"] for r in quality.score(source, table).collect()}
    assert sorted(i for i in ids if i is not None) == sorted(i for r in source.collect() if (i := r["doc_id"]) is not None and scored[i])
    assert np.mean([i in set(ids) for i, y in labels.items() if y]) > 0.97


def test_without_labels_or_rows(spark, docs, labelled):
    source, table, _, _ = labelled
    none = table.limit(0)
    assert {r["score"] for r in quality.score(source, none).collect()} == {0.5}
    assert quality.accepted(source, none).count() == 406
    one = table.where("quality = 1")
    assert {r["score"] for r in quality.score(source, one).collect()} == {0.5}
    assert quality.score(docs([]), table).count() == 0 and quality.accepted(docs([]), table).count() == 0
    assert decision_list.judged(docs([]), table).count() == 0
    assert decision_list.learn(decision_list.text_stats(source), none).rules == ()
    assert decision_list.learn(decision_list.text_stats(source), one).rules == ()


def test_pairwise_fit_orders_by_worth():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(STATS))).astype(np.float32)
    better = x[:, 2] + 0.1 * rng.normal(size=600) > 0.5
    ranking = quality.fit(x, better, pairs=4000)
    s = ranking.score(x)
    assert ((s >= 0.3) == better).mean() > 0.95


# ---- the decision list

SPACE = " \t\n\x0b\x0c\r"


def brute(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in SPACE:
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    seen, cover = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for p in places:
                cover.update(range(p, p + 5))
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover)


def test_base_counts(docs):
    rng = random.Random(9)
    parts = ["a", "b", "é", "漢", " ", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\xa0", "\x1c", "#", "<", "|", "x y z w v", "$$"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    texts += [None, "", " \n ", "a b c d e a b c d e", "a a a a a a", "a a a a a", "same\nsame\n same\n\n\nsame", "w " * 5000, "z" * 100_000]
    rows = decision_list.text_stats(docs(texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_rules_are_learned_and_applied_in_order(labelled):
    source, table, labels, texts = labelled
    stats = decision_list.text_stats(source)
    rules = decision_list.learn(stats, table)
    assert rules.rules and all(len(r) <= decision_list.TESTS for r in rules.rules)
    rows = decision_list.judged(source, table).collect()
    assert len(rows) == 406
    for r in rows:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        first = next((k for k, rule in enumerate(rules.rules, 1) if all((r[t.stat] >= t.limit) == t.above for t in rule)), None)
        assert (r["base_failed"], r["rule"], r["kept"]) == (failed, first, not failed and first is None)
    held = [(r["kept"], labels[r["doc_id"]]) for r in rows if fold(r["doc_id"]) and r["doc_id"] in labels and not r["base_failed"]]
    assert np.mean([a == b for a, b in held]) >= 0.95


def test_no_python_runs_in_the_decision_list(labelled):
    source, table, _, _ = labelled
    df = decision_list.judged(source, table)
    for frame in (df, decision_list.text_stats(source)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_the_sample_is_the_first_by_hash(spark):
    from pyspark.sql import functions as F

    rows = spark.range(5000).select(F.col("id").alias("_id"))
    want = [r["_id"] for r in rows.orderBy(F.xxhash64("_id")).limit(300).collect()]
    assert [r["_id"] for r in quality._first_by_hash(rows.union(rows), 300).collect()] == want
    assert quality._first_by_hash(rows.limit(10), 300).count() == 10


@pytest.mark.parametrize("hot", range(6))
def test_an_id_that_most_rows_share_leaves_the_sample_whole(spark, hot):
    """Whatever its hash, it is one id of the sample; the others are there too."""
    from pyspark.sql import functions as F

    ids = spark.range(3000).select(F.lit(hot).cast("long").alias("_id")).unionByName(spark.range(100, 1100).select(F.col("id").alias("_id")))
    chosen = {r["_id"] for r in quality._first_by_hash(ids, 400).collect()}
    assert len(chosen) == 400
    assert len({r["_id"] for r in quality._first_by_hash(ids, 5000).collect()}) == 1001


def test_one_id_on_most_rows_still_trains(spark, labelled):
    source, table, labels, texts = labelled
    from pyspark.sql import functions as F

    some = next(k for k in labels if not fold(k))
    crowd = spark.range(20_000).select(F.lit(some).cast("long").alias("doc_id"), F.concat(F.lit("### x "), F.col("id").cast("string")).alias("text"))
    both = source.select("doc_id", "text").unionByName(crowd)
    rows = quality.score(both, table, sample=200).where(F.col("doc_id") != some).collect()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if fold(r["doc_id"]) and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) >= 0.95


def naive_stats(text):
    """STATS by their definitions, one text at a time."""
    raw = (text or "").encode()
    size = max(len(raw), 1)
    kinds = [bytes(range(65, 91)), bytes(range(48, 58)), b"#*$%&|<>!", b".,;:?'\"()-"]
    spaces = sum(b in b" \t\n\v\f\r" for b in raw)
    lower, non_ascii = sum(97 <= b < 123 for b in raw), sum(b >= 128 for b in raw)
    counts = [sum(b in k for b in raw) for k in kinds]
    other = len(raw) - sum(counts) - lower - non_ascii - spaces
    words = [bytes(b + 32 if 65 <= b < 91 else b for b in w) for w in raw.translate(bytes.maketrans(b"\t\n\v\f\r", b"     ")).split(b" ") if w]
    n = max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    mean = lambda test: sum(map(test, words)) / n
    symbol = lambda b: b in kinds[2]
    return [
        np.log1p(len(words)), np.log1p(len(lines)), mean(len), *(counts[k] / size for k in (0, 1, 2, 3)), other / size, non_ascii / size, spaces / size,
        len(set(words)) / n, max(Counter(words).values(), default=0) / n, sum(a == b for a, b in zip(words, words[1:])) / n, sum(c for c in windows.values() if c > 1) / n,
        len(set(lines)) / max(len(lines), 1), len(words) / max(len(lines), 1),
        mean(lambda w: w[0] >= 128 or w[:1].isalnum()), mean(lambda w: symbol(w[-1]) or symbol(w[0])), mean(lambda w: len(w) <= 3), mean(lambda w: len(w) >= 12),
    ]


def test_statistics_by_their_definitions():
    rng = random.Random(21)
    parts = ["a", "Be", "é", "漢字", " ", " ", "\n", "\t", "\v", "\x1c", "#", "12", ".", "--", "x y z w v ", "$a", "long" * 4, "~", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 70))) for _ in range(300)] + ["", None, "\n\n", "same\nsame\n", "w " * 400]
    raw = [(t or "").encode() for t in texts]
    got = quality.text_stats(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    np.testing.assert_allclose(got, np.array([naive_stats(t) for t in texts]), rtol=1e-5, atol=1e-6)


def test_very_long_text(docs, labelled):
    source, table, _, _ = labelled
    long = docs(["word number one " * 300_000, "z" * 3_000_000], ids=[10_000_000, 10_000_001])
    out = quality.score(source.select("doc_id", "text").unionByName(long.select("doc_id", "text")), table).where("doc_id >= 10000000").collect()
    assert len(out) == 2 and all(0 <= r["score"] <= 1 for r in out)


def pair_loss_slope(x, better, w, ridge):
    a, b = x[better], x[~better]
    p = 1 / (1 + np.exp((a @ w)[:, None] - (b @ w)[None]))
    return -(p.sum(1) @ a - p.sum(0) @ b) / p.size + ridge * w


def known_rows(spark, n=700):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(n, len(STATS))), 2).astype(np.float32)
    better = x[:, 2] + x[:, 5] + 0.8 * rng.normal(size=n) > -0.5
    ids = [k for k in range(2 * n) if not fold(k)][:n]
    stats = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)], "doc_id long, stats array<float>")
    labels = spark.createDataFrame([(i, int(y)) for i, y in zip(ids, better)], "doc_id long, quality int")
    return x, better, stats, labels


def test_every_labelled_row_and_every_pair_trains(spark):
    x, better, stats, labels = known_rows(spark)
    few, many = (quality.train(stats.repartition(5), labels, sample=n, pairs=200) for n in (40, 5000))
    for got in (few, many):
        want = [np.sort(np.concatenate([np.quantile(x[side, j], quality.QUANTILES) for side in (better, ~better)]).astype(np.float32))[: quality.BINS - 1] for j in range(len(STATS))]
        np.testing.assert_allclose(got.edges, want, atol=1e-6)
        slope = pair_loss_slope(quality._one_hot(quality._cells(got.edges, x)).astype(float), better, got.weights.ravel(), quality.RIDGE)
        assert np.abs(slope).max() < 2e-5  # of all pairs, to a step of the grid
        worth = np.sort(got.worth(x))
        k = int((~better).sum())
        assert got.cut == pytest.approx((worth[k - 1] + worth[k]) / 2) and got.scale == pytest.approx(worth.std() / 4)
    assert np.abs(few.weights - many.weights).max() < 0.02


def test_counts_of_worths_give_the_sums_over_all_pairs():
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 4, (2, 3000))
    got = quality._over_pairs(counts)
    worth = np.arange(3000) / quality.GRID
    p = 1 / (1 + np.exp(worth[:, None] - worth))
    np.testing.assert_allclose(got, [p @ counts[1] / counts[1].sum(), counts[0] @ p / counts[0].sum()], rtol=1e-9)
