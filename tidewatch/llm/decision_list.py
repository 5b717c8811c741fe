"""Quality rules as a learned decision list, with built-in expressions only.

Text statistics are plain column expressions. The rules to drop a text are learned from labelled
statistics by sequential covering: a rule grows by the threshold test that gains most information
about the worse class, is pruned back to the prefix that does best on rows kept aside, and is
taken if it is right often enough; the rows it covers leave, and the next rule is grown. The
list becomes one ordered CASE expression.

Learning reads a table of counts: one row per combination of binned statistics, made by one
aggregation over all labelled rows, so each growing step is a small aggregate. Only sums per
(statistic, bin) come to the driver: at most STATS x (CUTS + 1) rows.

A null text counts as empty; texts without words have all statistics 0 and fail the base rule.
Rows without label or id do not train; held-out ids never do. With no labelled rows, or only
one class, the list is empty and keeps all that the base rule keeps. Repeated rows
are judged alike, and train as often as they are labelled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .quality_folds import held_out

# fixed values: white space, symbols and the base rule
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

CUTS = 16
RULES = 12
TESTS = 4
PRECISION = 0.75
COVER = 3
PRUNE_SHARE = 3  # one labelled row of so many prunes

STATS = ("symbol_share", "upper_share", "mark_share", "word_length", "distinct_share", "repeat_share", "dup_line_share", "line_words", "stop_share", "words")


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def _bound(value: Column, use) -> Column:
    """use(value) with value computed once, also where the optimizer moves the expression to another place."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _window_hashes(w: Column) -> Column:
    """64-bit hash of each window of words."""
    window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    return F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), window)).otherwise(F.array().cast("array<bigint>"))


def _repeated_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(sorted_):
        same = F.filter(sorted_, lambda x, k: F.get(sorted_, k - 1)["h"].eqNullSafe(x["h"]) | F.get(sorted_, k + 1)["h"].eqNullSafe(x["h"]))
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    places = _bound(pairs, twice)
    # each window adds the words the one before it did not hold
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(places, start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")), lambda a: a["n"])
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)


def text_stats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and STATS of each text."""
    t = F.col("_t")
    df = docs.select(F.col(id), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    df = df.withColumn("_w", F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), ""))
    df = df.withColumn("_l", F.filter(F.split(t, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("_w")
    chars = F.length(t)
    df = df.select(
        id,
        n.cast("long").alias("n_words"),
        _without(t, SPACE).cast("long").alias("word_chars"),
        (chars - _without(t, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _bound(_bound(F.col("_w"), _window_hashes), _repeated_words).cast("long").alias("n_repeat_words"),
        chars.alias("_chars"),
        F.size("_l").alias("_lines"),
        (chars - _without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("_upper"),
        (chars - _without(t, "!?~=+^@\\_{}[]")).alias("_marks"),
        (chars - _without(t, ".,;:")).alias("_stops"),
        F.size(F.array_distinct("_w")).alias("_distinct"),
    )

    def share(part, whole):
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    shares = {
        "symbol_share": share("n_symbols", "_chars"),
        "upper_share": share("_upper", "_chars"),
        "mark_share": share("_marks", "_chars"),
        "word_length": share("word_chars", "n_words"),
        "distinct_share": share("_distinct", "n_words"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "_lines"),
        "line_words": share("n_words", "_lines"),
        "stop_share": share("_stops", "n_words"),
        "words": F.col("n_words").cast("double"),
    }
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return df.select(id, *base, *[v.alias(k) for k, v in shares.items()])


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    stat: str
    above: bool  # value >= limit, else value < limit
    limit: float
    bin: int  # first bin at or above the limit

    def column(self) -> Column:
        return F.col(self.stat) >= F.lit(self.limit) if self.above else F.col(self.stat) < F.lit(self.limit)

    def binned(self) -> Column:
        return F.col(self.stat) >= self.bin if self.above else F.col(self.stat) < self.bin

    def __str__(self) -> str:
        return f"{self.stat} {'>=' if self.above else '<'} {self.limit:.6g}"


Rule = tuple[Test, ...]


@dataclass(frozen=True)
class DecisionList:
    """Rules to drop a text, in order; what no rule covers is kept."""

    rules: tuple[Rule, ...]

    def rule_of(self) -> Column:
        """Number of the first rule that covers a row, from 1; null when none does."""
        out = None
        for k, rule in enumerate(self.rules, 1):
            test = _all(t.column() for t in rule)
            out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
        return F.lit(None).cast("int") if out is None else out

    def keeps(self) -> Column:
        return self.rule_of().isNull()

    def __str__(self) -> str:
        return "\n".join("drop if " + " and ".join(map(str, r)) for r in self.rules) + "\nelse keep"


def _all(tests) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _cuts(labelled: DataFrame) -> dict[str, list[float]]:
    """Thresholds of each statistic: quantiles of either class, so that the rarer one has as many."""
    marks = [(k + 0.5) / (CUTS // 2) for k in range(CUTS // 2)]
    by_class = labelled.groupBy("_bad").agg(*(F.percentile_approx(s, marks, 1000).alias(s) for s in STATS)).collect()
    return {s: sorted({v for r in by_class for v in r[s] or []}) for s in STATS}


def _cells(labelled: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """(bins of STATS, part, bad, good): how many labelled rows of either class fall into a combination of bins."""
    bins = [reduce(lambda a, b: a + b, [(F.col(s) >= c).cast("int") for c in cuts[s]], F.lit(0)).alias(s) for s in STATS]
    part = F.when(F.pmod(F.xxhash64("_id"), F.lit(PRUNE_SHARE)) == 0, F.lit("prune")).otherwise(F.lit("grow")).alias("part")
    return labelled.select(*bins, part, "_bad").groupBy(*STATS, "part").agg(F.sum(F.col("_bad").cast("long")).alias("bad"), F.sum((~F.col("_bad")).cast("long")).alias("good"))


def _totals(cells: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
    """Per statistic and bin: rows of the worse and of the better class."""
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("stat"), F.col(s).alias("bin")) for s in STATS))).alias("e")
    rows = cells.select(each, "bad", "good").groupBy("e.stat", "e.bin").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
    out: dict[str, dict[int, tuple[int, int]]] = {s: {} for s in STATS}
    for r in rows:
        out[r["stat"]][r["bin"]] = (r["bad"], r["good"])
    return out


def _information(bad: int, good: int) -> float:
    return math.log2(bad / (bad + good))


def _best_test(totals, cuts) -> tuple[Test, int, int] | None:
    """The test with the largest gain: worse rows covered times the information gained for each."""
    bad, good = (sum(v[k] for v in totals[STATS[0]].values()) for k in (0, 1))
    if not bad or not good:
        return None
    best, best_gain = None, 1e-9
    for s in STATS:
        low_bad = low_good = 0
        for b in range(1, len(cuts[s]) + 1):
            x, y = totals[s].get(b - 1, (0, 0))
            low_bad, low_good = low_bad + x, low_good + y
            for above, p, n in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                if p < COVER or p + n == bad + good:
                    continue
                gain = p * (_information(p, n) - _information(bad, good))
                if gain > best_gain:
                    best, best_gain = (Test(s, above, cuts[s][b - 1], b), p, n), gain
    return best


def _pruned(rule: list[Test], cells: DataFrame) -> tuple[Rule, int, int]:
    """The prefix with the largest (worse - better) / all on the rows kept aside, and what it covers there."""
    sums = []
    for k in range(1, len(rule) + 1):
        inside = _all(t.binned() for t in rule[:k])
        sums += [F.sum(F.when(inside, F.col(c)).otherwise(0)).alias(f"{c}{k}") for c in ("bad", "good")]
    r = cells.agg(*sums).first()
    covered = [(r[f"bad{k}"] or 0, r[f"good{k}"] or 0) for k in range(1, len(rule) + 1)]
    k = max(range(len(rule)), key=lambda i: ((covered[i][0] - covered[i][1]) / max(sum(covered[i]), 1), covered[i][0], -i))
    return tuple(rule[: k + 1]), *covered[k]


def learn(stats: DataFrame, labels: DataFrame, *, id: str = "doc_id", label: str = "quality") -> DecisionList:
    """Decision list from rows with STATS and labels (1: better); held-out ids and rows the base rule fails are left out."""
    known = labels.select(F.col(id).alias("_id"), (F.col(label) != 1).alias("_bad")).where("_id is not null and _bad is not null").where(~held_out("_id"))
    labelled = staged(stats.where(~base_failed()).select(F.col(id).alias("_id"), *STATS).join(known, "_id"), "labelled")
    cuts = _cuts(labelled)
    left = staged(_cells(labelled, cuts), "cells")
    rules: list[Rule] = []
    while len(rules) < RULES:
        grow, aside = left.where("part = 'grow'"), left.where("part = 'prune'")
        tests: list[Test] = []
        while len(tests) < TESTS:
            found = _best_test(_totals(grow.where(_all(t.binned() for t in tests))), cuts)
            if found is None:
                break
            tests.append(found[0])
            if not found[2]:
                break
        if not tests:
            break
        rule, bad, good = _pruned(tests, aside)
        seen = left.where(_all(t.binned() for t in rule)).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
        bad_all, good_all = seen["bad"] or 0, seen["good"] or 0
        if bad_all < COVER or bad_all < PRECISION * (bad_all + good_all) or bad < PRECISION * (bad + good):
            break
        rules.append(rule)
        left = left.where(~_all(t.binned() for t in rule))
    return DecisionList(tuple(rules))


def judged(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """text_stats() of docs with base_failed, rule (the first rule that covers the row) and kept."""
    stats = staged(text_stats(docs, id, text), "rules")
    rules = learn(stats, labels, id=id, label=label)
    return stats.withColumn("base_failed", base_failed()).withColumn("rule", rules.rule_of()).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
