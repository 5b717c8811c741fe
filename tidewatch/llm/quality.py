"""Quality classifier: Bradley-Terry ranking on preference pairs.

Statistics of each text (STATS) are cut into bins by quantiles of the training texts; a text is
the set of its bins. Every pair of a better and a worse labelled text is a preference;
the probability that a beats b is sigmoid(w.(x_a - x_b)), and w is fitted by logistic loss on
the feature differences of all pairs. The worth of a text is w.x. The cut between the classes is the
quantile of the training worths at the share of worse texts; the score maps it to CUT:
score = sigmoid((worth - cut) / scale + logit(CUT)).

Training reads every labelled row that is not held out, in passes over their statistics: quantiles are exact, found eight bits at a
time, and Newton's steps are for all pairs. Weights are multiples of 1/GRID, so worths are too, and the number of texts
of each worth and class gives every text the sum over all its pairs; no pair is listed. Only the curvature takes worths
in COARSE steps. The first weights come from SAMPLE ids (chosen by hash) and PAIRS pairs; they decide how many steps
it takes and not where these end. A null text counts as empty; empty
texts get the score of their bins. Rows without label, or whose id is null, never train. An id
that many rows share trains once, by the text whose statistics hash least, and an id with both labels trains for both.
Without both labels the score is 0.5 everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .arrays import FOLD, WORD_BETWEEN_SPACES, WORD_OF_LETTERS, add_columns, hashed, in_workers, keep_rows, lists, mixed, words
from .quality_folds import held_out

SAMPLE = 20_000
PAIRS = 24_000
BINS = 12
CUT = 0.3
GRID = 1024
COARSE = 128
STEPS = 16
PARTS = 8
RIDGE = 1e-3

STATS = (
    "n_words n_lines word_length upper digit symbol punctuation other_ascii non_ascii space distinct_words top_word"
    " repeated_next repeated_windows distinct_lines line_words alpha_words marked_words short_words long_words"
).split()

_CLASS = np.full(256, 5, np.int64)  # 5: other ASCII
for _k, _letters in enumerate((range(65, 91), range(97, 123), range(48, 58), b"#*$%&|<>!", b".,;:?'\"()-", (), range(128, 256), b" \t\n\v\f\r")):
    _CLASS[list(_letters)] = _k
_LINE = np.ones(256, bool)
_LINE[10] = False


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, most copies of one value, and rows in values that occur twice or more, by row."""
    key, counts = np.unique(h ^ mixed(row.astype(np.uint64) + np.uint64(1)), return_counts=True) if len(h) else (h, np.zeros(0, np.int64))
    own = h ^ mixed(row.astype(np.uint64) + np.uint64(1))
    copies = counts[np.searchsorted(key, own)]
    distinct = np.bincount(row, 1 / np.maximum(copies, 1), minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, row, copies)
    return distinct, top, np.bincount(row, copies > 1, minlength=n)


def text_stats(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """STATS of each text as float32 (texts x stats); shares are of the text's words, lines or bytes."""
    n = len(at) - 1
    size = np.diff(at)
    by_class = np.bincount(np.repeat(np.arange(n) * 8, size) + _CLASS[buf], minlength=n * 8).reshape(n, 8)
    share = by_class / np.maximum(size, 1)[:, None]

    starts, ends, row = words(buf, at, WORD_BETWEEN_SPACES)
    n_words = np.bincount(row, minlength=n)
    some = np.maximum(n_words, 1)
    long = ends - starts
    h = hashed(FOLD[buf], starts, ends)
    distinct, top, _ = _distinct(row, h, n)
    same_next = np.append((h[1:] == h[:-1]) & (row[1:] == row[:-1]), False) if len(h) else np.zeros(0, bool)
    if len(h) >= 5:
        window = row[4:] == row[:-4]
        w = np.zeros(len(h) - 4, np.uint64)
        for k in range(5):
            w = mixed(w + h[k : len(h) - 4 + k])
        _, _, repeated = _distinct(row[:-4][window], w[window], n)
    else:
        repeated = np.zeros(n)
    last = buf[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    letters = WORD_OF_LETTERS[buf[starts]] if len(starts) else np.zeros(0, bool)
    marked = (_CLASS[last] == 3) | (_CLASS[buf[starts]] == 3) if len(starts) else np.zeros(0, bool)

    l_starts, l_ends, l_row = words(buf, at, _LINE)
    n_lines = np.bincount(l_row, minlength=n)
    d_lines, _, _ = _distinct(l_row, hashed(buf, l_starts, l_ends), n)

    def of_words(flag):
        return np.bincount(row, flag, minlength=n) / some

    columns = [
        np.log1p(n_words), np.log1p(n_lines), of_words(long),
        share[:, 0], share[:, 2], share[:, 3], share[:, 4], share[:, 5], share[:, 6], share[:, 7],
        distinct / some, top / some, of_words(same_next), repeated / some,
        d_lines / np.maximum(n_lines, 1), n_words / np.maximum(n_lines, 1),
        of_words(letters), of_words(marked), of_words(long <= 3), of_words(long >= 12),
    ]
    return np.stack(columns, 1).astype(np.float32)


@dataclass(frozen=True)
class Ranking:
    """Bin edges and weights of each statistic, and where the cut lies."""

    edges: np.ndarray  # stats x (BINS - 1)
    weights: np.ndarray  # stats x BINS
    cut: float
    scale: float

    def worth(self, stats: np.ndarray) -> np.ndarray:
        total = np.zeros(len(stats))
        for k in range(stats.shape[1]):
            total += self.weights[k][np.searchsorted(self.edges[k], stats[:, k], "right")]
        return total

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not self.scale:
            return np.full(len(stats), 0.5)
        z = (self.worth(stats) - self.cut) / self.scale + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


QUANTILES = np.linspace(0, 1, BINS // 2 + 2)[1:-1]


def _joined_edges(by_class: np.ndarray) -> np.ndarray:
    """Edges of one statistic. Half of the quantiles are from each class: the rarer one decides as much."""
    return np.sort(by_class.astype(np.float32).ravel())[: BINS - 1]


def _cells(edges: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """The features of each text: one per statistic."""
    return np.stack([j * BINS + np.searchsorted(edges[j], stats[:, j], "right") for j in range(len(edges))], 1)


def _one_hot(cells: np.ndarray) -> np.ndarray:
    x = np.zeros((len(cells), cells.shape[1] * BINS), np.float32)
    x[np.arange(len(cells))[:, None], cells] = 1
    return x


def fit(stats: np.ndarray, better: np.ndarray, pairs: int = PAIRS, seed: int = 7, ridge: float = RIDGE, edges: np.ndarray | None = None) -> Ranking:
    """Fits on rows of statistics and a boolean 'better', by random pairs of them."""
    k = len(STATS)
    if not better.any() or better.all():
        return Ranking(np.zeros((k, BINS - 1), np.float32), np.zeros((k, BINS)), 0.0, 0.0)
    if edges is None:
        edges = np.array([_joined_edges(np.array([np.quantile(stats[side, j], QUANTILES) for side in (better, ~better)])) for j in range(k)])
    x = _one_hot(_cells(edges, stats))
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(better), np.flatnonzero(~better)
    diff = x[rng.choice(good, pairs)] - x[rng.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(12):  # Newton steps on the logistic loss of the differences
        p = 1 / (1 + np.exp(diff @ w.astype(np.float32)))
        slope = -(diff.T @ p).astype(float) / pairs + ridge * w
        curve = (diff.T * (p * (1 - p))) @ diff / np.float32(pairs) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    worth = x @ w
    share = (~better).mean()
    cut = _cut(worth, better, share)
    return Ranking(edges, w.reshape(k, BINS), cut, float(worth.std()) / 4 or 1.0)


def _cut(worth: np.ndarray, better: np.ndarray, share: float) -> float:
    """Middle of the gap at the quantile `share` of the worths."""
    order = np.sort(worth)
    at = min(max(round(share * len(order)), 1), len(order) - 1)
    return float((order[at - 1] + order[at]) / 2)


def add_stats(docs: DataFrame, text: str = "text", name: str = "stats") -> DataFrame:
    def work(rows, buf, at):
        values = text_stats(buf, at)
        n = len(values)
        return [lists(np.repeat(np.arange(n), values.shape[1]), pa.array(values.ravel()), n)]

    return add_columns(docs, text, f"{name} array<float>", work)


def _first_by_hash(ids: DataFrame, sample: int) -> DataFrame:
    """The `sample` distinct ids (column _id) with the smallest hashes; all of them if there are no more.

    Ids that are far from the first ones are left out before they are sorted, by a bound on the hash that
    leaves about twice as many as asked for, so that what is gathered does not grow with the table. Hashes of distinct
    ids spread evenly, however often an id occurs.
    """
    ids = ids.select("_id").distinct()
    h, n = F.xxhash64("_id"), ids.count()
    if n > 2 * sample:
        ids = ids.where(h <= int(-(2**63) + 2 * sample / n * 2**64))
    return ids.orderBy(h).limit(sample)


def _known(labels: DataFrame, id: str, label: str) -> DataFrame:
    """The labels that training may see: not those of rows that held_out() names."""
    return labels.select(F.col(id).alias("_id"), F.col(label).alias("_label")).where("_label is not null and _id is not null").where(~held_out("_id"))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Side (0 better, 1 worse) and statistics of each row."""
    flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return 1 - batch.column("better").to_numpy(zero_copy_only=False).astype(np.int64), flat.reshape(-1, len(STATS))


def _counted(rows: DataFrame, count) -> tuple[np.ndarray, np.ndarray]:
    """Keys and how often they are: count(batches) gives the (keys, counts) of a task."""

    def run(batches):
        keys, n = count(batches)
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["k", "n"])

    found = in_workers(rows.select("better", "stats"), run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    return found["k"].to_numpy(), found["n"].to_numpy()


def quantiles(rows: DataFrame, n: list[int]) -> np.ndarray:
    """numpy's quantiles of all rows (side x stat x QUANTILES); n: rows of each side, none 0.

    A float's bits in order are a number; the row of a rank is found eight bits at a time, by counts of
    the values that share the bits found before.
    """
    k, places = len(STATS), [np.array(m - 1) * QUANTILES for m in n]
    ranks = np.array([np.append(np.floor(x), np.ceil(x)) for x in places]).astype(np.int64)
    wanted = ranks.shape[1]
    left = np.repeat(ranks[:, None], k, 1)
    found = np.zeros((2, k, wanted), np.int64)
    for shift in (24, 16, 8, 0):
        known = [[np.unique(found[side, j]) for j in range(k)] for side in (0, 1)]

        def count(batches):
            held = np.zeros((2, k, wanted, 256), np.int64)
            for batch in batches:
                sides, stats = _matrix(batch)
                bits = (stats + np.float32(0)).view(np.uint32)
                bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.int64)
                for side in (0, 1):
                    own = bits[sides == side]
                    for j in range(k):
                        top, digit, at = own[:, j] >> (shift + 8), (own[:, j] >> shift) & 255, known[side][j]
                        slot = np.minimum(np.searchsorted(at, top), len(at) - 1)
                        hit = at[slot] == top
                        held[side, j] += np.bincount(slot[hit] * 256 + digit[hit], minlength=wanted * 256).reshape(wanted, 256)
            keys = np.flatnonzero(held)
            return keys, held.ravel()[keys]

        counts = np.zeros(2 * k * wanted * 256, np.int64)
        keys, n_of = _counted(rows, count)
        counts[keys] = n_of
        upto = np.cumsum(counts.reshape(2, k, wanted, 256), 3)
        for side in (0, 1):
            for j in range(k):
                own = upto[side, j][np.searchsorted(known[side][j], found[side, j])]
                digit = (own <= left[side, j][:, None]).sum(1)
                left[side, j] -= np.where(digit > 0, own[np.arange(wanted), digit - 1], 0)
                found[side, j] = found[side, j] << 8 | digit
    bits = found.astype(np.uint32)
    values = np.where(bits >> 31, bits & np.uint32((1 << 31) - 1), ~bits).astype(np.uint32).view(np.float32).astype(float)
    low, high = values[..., : wanted // 2], values[..., wanted // 2 :]
    return low + (high - low) * np.array([x - np.floor(x) for x in places])[:, None]


def _worths(rows: DataFrame, edges: np.ndarray, w: np.ndarray) -> tuple[int, np.ndarray]:
    """Least worth, in steps of the grid, and the number of rows of each side at it and each one above."""

    def count(batches):
        parts = [np.zeros(0, np.int64)]
        for batch in batches:
            sides, stats = _matrix(batch)
            parts.append(w[_cells(edges, stats)].sum(1) * 2 + sides)
        return np.unique(np.concatenate(parts), return_counts=True)

    keys, n = _counted(rows, count)
    least = int((keys >> 1).min())
    counts = np.zeros((2, int((keys >> 1).max()) - least + 1), np.int64)
    counts[keys & 1, (keys >> 1) - least] = n
    return least, counts


def _over_pairs(counts: np.ndarray) -> np.ndarray:
    """For each side and worth, the mean over the other side's rows of the probability that the worse one wins."""
    n = counts.shape[1]
    losing = 1 / (1 + np.exp(np.clip(np.arange(1 - n, n) / GRID, -500, 500)))  # by how much the better one is worth more
    size = 1 << (3 * n).bit_length()

    def folded(other, kernel):
        full = np.fft.irfft(np.fft.rfft(other / other.sum(), size) * np.fft.rfft(kernel, size), size)
        return full[n - 1 : 2 * n - 1]

    return np.stack([folded(counts[1], losing), folded(counts[0], losing[::-1])])


def _newton(rows: DataFrame, edges: np.ndarray, w: np.ndarray, least: int, counts: np.ndarray, ridge: float) -> np.ndarray:
    """Weights after a step on the loss of all pairs. The curvature is that of pairs whose worths are taken in COARSE steps."""
    n, features = counts.shape[1], len(w)
    each = counts.sum(1)
    slopes = _over_pairs(counts) * np.array([-1.0, 1.0])[:, None] / each[:, None]
    place = np.arange(n) * COARSE // n
    coarse = np.stack([np.bincount(place, counts[side], COARSE) for side in (0, 1)]) / each[:, None]
    middle = (np.arange(COARSE) + 0.5) * n / COARSE / GRID
    p = 1 / (1 + np.exp(np.clip(middle[:, None] - middle, -500, 500)))
    spread = p * (1 - p)
    bends = np.stack([spread @ coarse[1], spread.T @ coarse[0]]) / each[:, None]
    width = features + features * features + 2 * COARSE * features

    def run(batches):
        slope, curve, sums = np.zeros(features), np.zeros((features, features)), np.zeros(2 * COARSE * features)
        for batch in batches:
            sides, stats = _matrix(batch)
            cells = _cells(edges, stats)
            at = w[cells].sum(1) - least
            slope += np.bincount(cells.ravel(), np.repeat(slopes[sides, at], cells.shape[1]), features)
            x = _one_hot(cells)
            curve += (x * bends[sides, place[at]].astype(np.float32)[:, None]).T @ x
            sums += np.bincount((((sides * COARSE + place[at]) * features)[:, None] + cells).ravel(), minlength=len(sums))
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([slope, curve.ravel(), sums]).tobytes()], pa.binary())], names=["sums"])

    def add(table):
        total = np.zeros(width)
        for chunk in table.column("sums").chunks:
            for x in chunk:
                total += np.frombuffer(x.as_buffer())
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    made = in_workers(rows.select("better", "stats"), run, "sums binary").withColumn("part", F.spark_partition_id() % PARTS)
    total = np.zeros(width)
    for r in made.groupBy("part").applyInArrow(add, "sums binary").collect():
        total += np.frombuffer(r["sums"])
    slope, curve, sums = np.split(total, [features, features + features * features])
    sums = sums.reshape(2, COARSE, features) / each[:, None, None]
    across = sums[0].T @ spread @ sums[1]
    curve = curve.reshape(features, features) - across - across.T + ridge * np.eye(features)
    now = w / GRID
    return np.round((now - np.linalg.solve(curve, slope + ridge * now)) * GRID).astype(np.int64)


def _ranking(edges: np.ndarray, w: np.ndarray, least: int, counts: np.ndarray) -> Ranking:
    """The cut is the middle of the gap at the quantile of the worths at the share of worse rows."""
    both = counts.sum(0)
    n = int(both.sum())
    at = min(max(round(float(counts[1].sum() / n) * n), 1), n - 1)
    low, high = np.searchsorted(np.cumsum(both), [at - 1, at], "right") + least
    worth = np.arange(least, least + len(both)) / GRID
    mean = float(worth @ both) / n
    scale = float(np.sqrt((worth - mean) ** 2 @ both / n)) / 4
    return Ranking(edges, w.reshape(len(edges), BINS) / GRID, float(low + high) / 2 / GRID, scale or 1.0)


def train(stats: DataFrame, labels: DataFrame, *, id: str = "doc_id", label: str = "quality", sample: int = SAMPLE, pairs: int = PAIRS, ridge: float = RIDGE) -> Ranking:
    """Ranking from rows (id, stats) and labels. Each id trains once for every label it has, by one of its texts."""
    known = _known(labels, id, label).distinct()
    joined = stats.select(F.col(id).alias("_id"), "stats").join(known, "_id").groupBy("_id", "_label").agg(F.min_by("stats", F.xxhash64("stats")).alias("stats"))
    rows = staged(joined.select("_id", "_label", (F.col("_label") == 1).alias("better"), "stats"), "training")
    n = {r["better"]: r["count"] for r in rows.groupBy("better").count().collect()}
    if len(n) < 2:
        return fit(np.zeros((0, len(STATS)), np.float32), np.zeros(0, bool))
    edges = np.array([_joined_edges(x) for x in quantiles(rows, [n[True], n[False]]).swapaxes(0, 1)])
    some = rows.join(F.broadcast(_first_by_hash(rows, sample)), "_id", "left_semi").orderBy(F.xxhash64("_id"), "_label").limit(sample).select("stats", "better").toArrow()
    x = some["stats"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(some.num_rows, len(STATS))
    w = np.round(fit(x, some["better"].to_numpy(), pairs, ridge=ridge, edges=edges).weights.ravel() * GRID).astype(np.int64)
    least, counts = _worths(rows, edges, w)
    for _ in range(STEPS):
        new = _newton(rows, edges, w, least, counts, ridge)
        if (new == w).all():
            break
        w = new
        least, counts = _worths(rows, edges, w)
    return _ranking(edges, w, least, counts)


def score(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality", **options) -> DataFrame:
    """id, held_out, score and predicted (1 at CUT or more) of every row of docs.

    Statistics are computed once and written; training reads the labelled ones, scoring all.
    """
    stats = staged(add_stats(docs.select(id, text), text).drop(text), "quality")
    shared = docs.sparkSession.sparkContext.broadcast(train(stats, labels, id=id, label=label, **options))

    def work(batches):
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            values = shared.value.score(flat.reshape(batch.num_rows, len(STATS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["id", "score"])

    kind = stats.schema[id].dataType.simpleString()
    scored = in_workers(stats.select(id, "stats"), work, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id), held_out("id").alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality", **options) -> DataFrame:
    """Rows of docs that score CUT or more, columns as they are."""
    stats = staged(add_stats(docs.select(id, text), text).drop(text), "quality")
    shared = docs.sparkSession.sparkContext.broadcast(train(stats, labels, id=id, label=label, **options))
    return keep_rows(docs, text, lambda rows, buf, at: shared.value.score(text_stats(buf, at)) >= CUT)
