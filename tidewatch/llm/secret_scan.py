"""Secret scan: formats by rule, other random strings by a battery of randomness tests.

Base spans come from three formats (FORMATS). Beyond them every run of token characters of
at least SHORTEST is a candidate. Its encoding is the smallest alphabet that holds it. Three
statistics say how far it is from uniform random text in that alphabet: chi-squared of
the character counts, the runs test around the alphabet's middle, and the lag-1 serial
correlation; Fisher's sum joins their p-values.

A candidate's own p-value is the share of ordinary strings of its encoding and length
class that look at least as random. Ordinary strings are drawn from the character pairs of
the shorter runs of all documents (one distributed count), also from flattened versions of
that chain, each weighted by its true over its drawing probability: shares far below one over
the number of draws are measured so, and a rare secret is not lost among many ordinary strings. Within each length class the Benjamini-Hochberg
rule at level FDR chooses the candidates to report, so that short strings, which any text
can produce, need stronger evidence.

Null and empty texts have no spans. Result columns replace columns of the same name. Repeated rows are each scanned and each count once in
the false-discovery rule. With an empty table the pair counts are empty and nothing is reported.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .arrays import FOLD, add_columns, in_workers, map_slices, ranges, slices, without, words

SHORTEST = 16
FDR = 0.05
DRAWS = 4000
#: Powers of the chain's probabilities that strings are drawn from; the least ones look almost random.
FLATTENED = (1.0, 0.75, 0.5, 0.25, 0.0)
#: P-values are rounded up to powers of this, so that few different ones exist.
STEP = 1.02
LENGTHS = (16, 20, 24, 32, 40, 64)

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets from small to large; the first that holds a string is its encoding. Digits alone are no secret.
ENCODINGS = (
    ("hex", DIGITS + "abcdef"),
    ("HEX", DIGITS + "ABCDEF"),
    ("base32", UPPER + "234567"),
    ("lower", LOWER + DIGITS),
    ("upper", UPPER + DIGITS),
    ("base62", DIGITS + UPPER + LOWER),
    ("base64", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", UPPER + LOWER + DIGITS + "+/-_"),
)
KINDS = ("assign", "access", "hex", "random")

# fixed values: the formats of the base spans
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _table(characters: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(characters.encode())] = True
    return t


_HEX, _ACCESS = _table(DIGITS + "abcdef"), _table(UPPER + DIGITS)
_TOKEN = _table(ENCODINGS[-1][1])
_CODES = {name: np.array([letters.encode().find(bytes([b])) for b in range(256)]) for name, letters in ENCODINGS}


def encoding_of(raw: bytes) -> str | None:
    """Smallest alphabet of a string; None for digits alone."""
    if raw.isdigit():
        return None
    letters = np.frombuffer(raw, np.uint8)
    return next((name for name, _ in ENCODINGS if (_CODES[name][letters] >= 0).all()), None)


def _tail(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution."""
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in np.ravel(z)]).reshape(np.shape(z))


def battery(codes: np.ndarray, size: int) -> np.ndarray:
    """Distance from uniform random text of each row of character codes 0..size-1: -2 sum ln p of three tests."""
    rows, n = codes.shape
    counts = np.bincount((np.arange(rows)[:, None] * size + codes).ravel(), minlength=rows * size).reshape(rows, size)
    chi = ((counts - n / size) ** 2).sum(1) * size / n
    free = size - 1
    z_chi = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))  # Wilson-Hilferty

    high = codes >= size / 2
    a = high.sum(1)
    b = n - a
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(1)
    mean = 1 + 2 * a * b / n
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-12))
    z_runs = np.where((a == 0) | (b == 0), np.sqrt(n), np.abs(runs - mean) / spread)

    x = codes - codes.mean(1, keepdims=True)
    power = (x * x).sum(1)
    serial = (x[:, 1:] * x[:, :-1]).sum(1) / np.maximum(power, 1e-12)
    z_serial = np.where(power == 0, np.sqrt(n), np.abs(serial + 1 / n) * math.sqrt(n))

    p = np.stack([_tail(z_chi), 2 * _tail(z_runs), 2 * _tail(z_serial)])
    return -2 * np.log(np.clip(p, 1e-300, 1)).sum(0)


def length_class(n: int) -> int:
    return max(i for i, least in enumerate(LENGTHS) if n >= least)


def pair_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(pair, n) over all texts: pair is 256 * byte + next byte, in runs of token characters too short to judge; at most 65,536 rows."""

    def work(rows, buf, at):
        inside = _TOKEN[buf]
        starts, ends, _ = words(buf, at, _TOKEN)
        long = np.flatnonzero(ends - starts >= SHORTEST)  # these are judged, so they are no evidence
        inside[ranges(starts[long], (ends - starts)[long])] = False
        both = inside[1:] & inside[:-1]
        edges = at[1:-1]
        both[edges[(edges > 0) & (edges < len(buf))] - 1] = False
        pairs = buf[:-1][both].astype(np.int64) * 256 + buf[1:][both]
        counts = np.bincount(pairs, minlength=1)
        pair = np.flatnonzero(counts)
        return [pa.array(pair), pa.array(counts[pair])]

    return map_slices(docs.select(text), text, "pair bigint, n bigint", work).groupBy("pair").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Ordinary:
    """By (encoding, length class): rising battery values, and the p-values below, between and above them; missing where texts hold none."""

    values: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]

    def p_value(self, raw: bytes) -> tuple[str, int, float] | None:
        name = encoding_of(raw)
        if name is None:
            return None
        n = length_class(len(raw))
        drawn = self.values.get((name, n))
        if drawn is None:
            return None
        letters = dict(ENCODINGS)[name]
        value = battery(_CODES[name][np.frombuffer(raw, np.uint8)][None, :], len(letters))[0]
        return name, n, float(drawn[1][np.searchsorted(drawn[0], value, "right")])


def ordinary(pairs: dict[int, int], draws: int = DRAWS, seed: int = 11) -> Ordinary:
    """Strings drawn as a chain of character pairs, each class at its shortest length; `draws` for each of FLATTENED."""
    matrix = np.zeros((256, 256))
    for pair, n in pairs.items():
        matrix[pair >> 8, pair & 255] = n
    values = {}
    for name, letters in ENCODINGS:
        own = list(letters.encode())
        m = matrix[np.ix_(own, own)]
        total = m.sum()
        if not total:
            continue
        first = m.sum(1) / total
        # a letter that nothing follows goes on as any first letter does
        follow = np.where(m.sum(1, keepdims=True) > 0, m / np.maximum(m.sum(1, keepdims=True), 1), first)
        chains = [(_flat(first, power), _flat(follow, power)) for power in FLATTENED]
        rng = np.random.default_rng(seed)
        codes = np.concatenate([_chain(rng, start, step, draws) for start, step in chains])
        # how much likelier each string is drawn, over all chains, than it is ordinary
        logs = [_log_chances(codes, start, step) for start, step in chains]
        ratio = np.logaddexp.reduce([x - logs[0] for x in logs]) - math.log(len(chains))
        for c, n in enumerate(LENGTHS):
            values[name, c] = _shares(battery(codes[:, :n], len(own)), np.exp(-ratio[:, n - 1]))
    return Ordinary(values)


def _flat(chances: np.ndarray, power: float) -> np.ndarray:
    flat = np.where(chances > 0, np.maximum(chances, 1e-300) ** power, 0.0)
    return flat / flat.sum(-1, keepdims=True)


def _chain(rng, start: np.ndarray, step: np.ndarray, draws: int) -> np.ndarray:
    codes = np.empty((draws, LENGTHS[-1]), np.int64)
    # chances that are zero are never drawn, whatever the sums round to
    first, after = _rising(start), _rising(step)
    codes[:, 0] = np.searchsorted(first, rng.random(draws), "right")
    for k in range(1, LENGTHS[-1]):
        codes[:, k] = (after[codes[:, k - 1]] <= rng.random(draws)[:, None]).sum(1)
    return codes


def _rising(chances: np.ndarray) -> np.ndarray:
    sums = np.cumsum(chances, -1)
    return np.where(sums >= sums[..., -1:], 1.0, sums)


def _log_chances(codes: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Logarithm of the chance of each string's first character, first two, and so on."""
    with np.errstate(divide="ignore"):
        first, after = np.log(start), np.log(step)
    return np.cumsum(np.concatenate([first[codes[:, :1]], after[codes[:, :-1], codes[:, 1:]]], 1), 1)


def _shares(drawn: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and p-values: the weight of all strings at most as far from random, twice its standard error, and once more the heaviest of them and the next."""
    order = np.argsort(drawn, kind="stable")
    w = weights[order]
    heaviest = np.maximum.accumulate(np.append(w, 0.0))
    p = np.minimum((np.append(0.0, np.cumsum(w) + 2 * np.sqrt(np.cumsum(w * w))) + heaviest) / (len(w) + 1), 1.0)
    p = np.minimum(STEP ** np.ceil(np.log(np.maximum(p, 1e-300)) / math.log(STEP)), 1.0)
    new = np.flatnonzero(p[1:] != p[:-1])
    return drawn[order][new], np.append(p[:1], p[new + 1])


def _code_points(buf: np.ndarray) -> np.ndarray:
    """Code points before each byte."""
    return np.append(0, np.cumsum((buf & 0xC0) != 0x80))


def _texts_with(low: bytes, at: np.ndarray) -> list[int]:
    """Rows that hold a keyword."""
    found = set()
    for word in _KEYWORDS:
        k = low.find(word)
        while k >= 0:
            row = int(np.searchsorted(at, k, "right")) - 1
            found.add(row)
            k = low.find(word, int(at[row + 1]))
    return sorted(found)


def _scan(buf: np.ndarray, at: np.ndarray, normal: Ordinary):
    """Base spans (row, kind, start, end) and candidates (row, start, end, length class, p)."""
    points = _code_points(buf)
    raw, low = buf.tobytes(), FOLD[buf].tobytes()
    base = []
    for row in _texts_with(low, at):
        text = raw[at[row] : at[row + 1]].decode("utf-8", "replace")
        base += [(row, 0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]

    def spans(table, least):
        starts, ends, row = words(buf, at, table)
        long = ends - starts >= least
        return zip(row[long].tolist(), starts[long].tolist(), ends[long].tolist(), points[at[row[long]]].tolist())

    for row, lo, hi, zero in spans(_ACCESS, ACCESS_LEAST):
        k = raw.find(b"AKIA", lo, hi)
        if k >= 0 and hi - k >= ACCESS_LEAST:
            base.append((row, 1, int(points[k]) - zero, int(points[hi]) - zero))
    for row, lo, hi, zero in spans(_HEX, HEX_LEAST):
        base.append((row, 2, int(points[lo]) - zero, int(points[hi]) - zero))
    candidates = []
    for row, lo, hi, zero in spans(_TOKEN, SHORTEST):
        judged = normal.p_value(raw[lo:hi])
        if judged:
            candidates.append((row, int(points[lo]) - zero, int(points[hi]) - zero, judged[1], judged[2]))
    return sorted(base, key=lambda s: (s[0], s[2], s[1])), candidates


SPAN = "array<struct<kind: string, start: bigint, end: bigint>>"
SCANNED = f"base {SPAN}, candidates array<struct<start: bigint, end: bigint, class: int, p: double>>"


def _nested(found: list[tuple], names: list[str], types: list[pa.DataType], n: int) -> pa.ListArray:
    columns = list(zip(*found)) or [()] * (len(names) + 1)
    rows = np.array(columns[0], np.int64)
    structs = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns[1:], types)], names=names)
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), structs)


def candidates(docs: DataFrame, text: str = "text", draws: int = DRAWS) -> DataFrame:
    """docs with base spans and candidates with their p-values."""
    pairs = {r["pair"]: r["n"] for r in pair_counts(docs, text).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(ordinary(pairs, draws))

    def work(rows, buf, at):
        base, found = _scan(buf, at, shared.value)
        n = len(at) - 1
        named = [(r, KINDS[k], s, e) for r, k, s, e in base]
        return [
            _nested(named, ["kind", "start", "end"], [pa.string(), pa.int64(), pa.int64()], n),
            _nested(found, ["start", "end", "class", "p"], [pa.int64(), pa.int64(), pa.int32(), pa.float64()], n),
        ]

    return add_columns(docs, text, SCANNED, work)


def cutoffs(scanned: DataFrame, fdr: float = FDR) -> dict[int, float]:
    """Largest p-value reported in each length class (Benjamini-Hochberg). At most one value a power of STEP and class is collected."""
    found = scanned.select(F.explode("candidates").alias("c")).groupBy("c.class", "c.p").agg(F.count(F.lit(1)).alias("n"))
    by_class: dict[int, list[tuple[float, int]]] = {}
    for r in found.collect():
        by_class.setdefault(r["class"], []).append((r["p"], r["n"]))
    limits = {}
    for c, values in by_class.items():
        total, rank = sum(n for _, n in values), 0
        for p, n in sorted(values):
            rank += n
            if p <= fdr * rank / total:
                limits[c] = p
    return limits


def reported(scanned: DataFrame, limits: dict[int, float]) -> DataFrame:
    """Adds spans: base spans and the reported candidates outside of them, by start, then kind."""
    def passes(c):
        within = F.lit(-1.0)
        for k, p in limits.items():
            within = F.when(c["class"] == k, F.lit(p)).otherwise(within)
        inside = F.exists("base", lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"]))
        return (c["p"] <= within) & ~inside

    chosen = F.transform(F.filter("candidates", passes), lambda c: F.struct(F.lit(KINDS[3]).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    place = F.transform(F.concat("base", chosen), lambda s: F.struct(s["start"], F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["end"], s["kind"]))
    ordered = F.transform(F.array_sort(place), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.withColumn("spans", ordered).drop("candidates")


def scan(docs: DataFrame, *, text: str = "text", fdr: float = FDR, draws: int = DRAWS) -> DataFrame:
    """docs without their text, with base and spans: (kind, start, end) in code points, end exclusive.

    The scanned rows are written once, without the texts, since the rule needs all p-values first.
    """
    found = staged(candidates(without(docs, ["spans"], text), text, draws).drop(text), "secrets")
    return reported(found, cutoffs(found, fdr))


def listed(spans: str) -> F.Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


MARK = "[SECRET]"


def redact(docs: DataFrame, *, text: str = "text", length: str | None = None, fdr: float = FDR, draws: int = DRAWS) -> DataFrame:
    """docs with every reported span, overlapping ones as one, replaced by MARK; `length` names a column of code points to renew."""
    pairs = {r["pair"]: r["n"] for r in pair_counts(docs, text).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(ordinary(pairs, draws))
    limits = cutoffs(staged(candidates(docs.select(text), text, draws).select("candidates"), "secrets"), fdr)

    def work(batches):
        for batch in batches:
            for rows, buf, at in slices(batch, text):
                base, found = _scan(buf, at, shared.value)
                hits: dict[int, list[tuple[int, int]]] = {}
                for r, _, s, e in base:
                    hits.setdefault(r, []).append((s, e))
                for r, s, e, c, p in found:
                    if p <= limits.get(c, -1.0):
                        hits.setdefault(r, []).append((s, e))
                if not hits:
                    yield rows
                    continue
                place = rows.schema.get_field_index(text)
                values = rows.column(place).to_pylist()
                for r, spans in hits.items():
                    values[r] = _replaced(values[r], spans)
                columns = list(rows.columns)
                columns[place] = pa.array(values, rows.schema.field(place).type)
                if length is not None:
                    k = rows.schema.get_field_index(length)
                    sizes = rows.column(k).to_pylist()
                    for r in hits:
                        sizes[r] = len(values[r])
                    columns[k] = pa.array(sizes, rows.schema.field(k).type)
                yield pa.RecordBatch.from_arrays(columns, schema=rows.schema)

    return in_workers(docs, work, docs.schema)


def _replaced(text: str, spans: list[tuple[int, int]]) -> str:
    out, at, until = [], 0, 0
    for s, e in sorted(spans):
        if s >= until:
            out += [text[at:s], MARK]
        at = until = max(until, e)
    return "".join([*out, text[at:]])
