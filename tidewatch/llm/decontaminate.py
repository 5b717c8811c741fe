"""Benchmark decontamination with suffix arrays of the training texts.

Every slice of the corpus (a shard) gets a suffix array over its words, and every
suffix of every benchmark item is looked up in it by binary search, one word deeper
at a time. The interval at the depth of a window holds all places of that window;
going on until the interval is empty gives the longest verbatim match of each place.

Words not found in the benchmark can begin no match: they are one code, and no
suffix starts there. Shards never span texts, so no rows are shuffled and a hot source or
a huge group of copies changes nothing. The benchmark is broadcast, in blocks of at
most BLOCK bytes of text, each block searched over the whole corpus.

A null or empty text has no words and no hits; items without words or id have no
windows. Repeated items share their windows; repeated rows are each reported. Result columns
replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.staging import staged
from .arrays import FOLD, ODD, WORD_OF_LETTERS, add_columns, binaries, hashed, in_workers, keep_rows, lists, mixed, ranges, without, words

WINDOW = 10
BLOCK = 4 << 20  # bytes of benchmark text; with all working arrays some 400 MB on the driver
SHARD = 2 << 20  # bytes of text under one suffix array


@dataclass(frozen=True)
class Probe:
    """The suffixes of one block of benchmark items."""

    vocabulary: np.ndarray  # sorted word hashes; a word's code is its place + 1
    codes: np.ndarray  # words of all items, one after the other
    start: np.ndarray  # of each suffix, in codes
    length: np.ndarray  # of each suffix, to the end of its item
    begin: np.ndarray  # where the item of each suffix begins in codes
    window: np.ndarray  # words a match needs to count; 0: too short to hold a window
    window_class: np.ndarray  # suffixes with the same window share a class
    item: np.ndarray  # rank of the suffix's item among names
    class_items: tuple[np.ndarray, np.ndarray]  # offsets and item ranks of each class
    names: list[str]  # item ids as text, sorted


def probe(items: list[tuple[str, str]], window: int = WINDOW) -> Probe | None:
    """Suffixes of (id, text) rows; None when no item has a word. Arrays only: some 60 bytes a word of the block."""
    items = [(i, t.encode()) for i, t in items if i is not None and t]
    names = sorted({i for i, _ in items})
    place = {name: k for k, name in enumerate(names)}
    rank = np.array([place[i] for i, _ in items], np.int64)
    buf = FOLD[np.frombuffer(b"".join(t for _, t in items), np.uint8)]
    at = np.cumsum([0, *(len(t) for _, t in items)])
    starts, ends, row = words(buf, at, WORD_OF_LETTERS)
    if not len(starts):
        return None
    vocabulary, codes = np.unique(hashed(buf, starts, ends), return_inverse=True)
    codes = (codes + 1).astype(np.int64)
    cuts = np.searchsorted(row, np.arange(len(items) + 1))
    size = np.diff(cuts)
    # a window begins at every word that has the others behind it; an item of fewer words is one
    n_windows = np.where(size >= window, size - window + 1, (size > 0).astype(np.int64))
    start = ranges(cuts[:-1], n_windows)
    item = np.repeat(np.arange(len(items)), n_windows)
    need = np.minimum(size, window)[item]
    _, klass = np.unique(_window_hashes(codes, start, need), return_inverse=True)
    pairs = np.unique(klass * len(names) + rank[item])
    offsets = np.searchsorted(pairs // len(names), np.arange(int(klass.max()) + 2))
    # the same words as an earlier item: only its name is new
    whole = np.zeros(len(items), np.uint64)
    np.add.at(whole, row, mixed(codes.astype(np.uint64) * ODD + mixed((np.arange(len(codes)) - cuts[row]).astype(np.uint64))))
    _, first = np.unique(whole, return_index=True)
    own = np.isin(item, first)
    start, item, need, klass = start[own], item[own], need[own], klass[own]
    return Probe(vocabulary, codes, start, cuts[item + 1] - start, cuts[item], need, klass, rank[item], (offsets, pairs % len(names)), names)


def _window_hashes(codes: np.ndarray, start: np.ndarray, need: np.ndarray) -> np.ndarray:
    """64-bit hash of the `need` words from each start."""
    h = need.astype(np.uint64)
    for k in range(int(need.max())):
        more = np.minimum(start + k, len(codes) - 1)
        h = np.where(k < need, mixed(h + codes[more].astype(np.uint64) * ODD), h)
    return h


def suffix_array(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes that start with a known word, sorted by their first `depth` words.

    Prefix doubling: ranks by 2, 4, 8 ... words; only ties are sorted again. Token 0
    equals nothing that is searched for, so what follows it is left unordered.
    """
    n = len(tokens)
    at = np.flatnonzero(tokens)
    following = np.append(tokens[1:], 0)
    key = (tokens[at] << 32) | following[at]
    order = np.argsort(key)
    suffixes, key = at[order], key[order]
    if not len(suffixes):
        return suffixes
    head = np.append(True, key[1:] != key[:-1])
    group = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))
    rank = np.zeros(n + 1, np.int64)
    rank[suffixes] = group + 1
    sorted_by = 2
    while sorted_by < depth:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied):
            break
        places = suffixes[tied]
        key = (group[tied] << 32) | rank[np.minimum(places + sorted_by, n)]
        order = np.argsort(key)
        places, key = places[order], key[order]
        fresh = np.append(True, key[1:] != key[:-1])
        begins = np.maximum.accumulate(np.where(fresh, tied, 0))
        suffixes[tied], head[tied], group[tied] = places, fresh, begins
        rank[places] = begins + 1
        sorted_by *= 2
    return suffixes


def _bisect(suffixes, tokens, deep, want, lo, hi, right):
    """First place in each interval [lo, hi) whose word at depth `deep` is not below (or is above) `want`."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        found = tokens[np.minimum(suffixes[mid] + deep, len(tokens) - 1)]
        go = found <= want[open_] if right else found < want[open_]
        lo[open_] = np.where(go, mid + 1, lo[open_])
        hi[open_] = np.where(go, hi[open_], mid)


def search(suffixes: np.ndarray, tokens: np.ndarray, p: Probe) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, place, words) of every match of at least a window: its longest length at that place."""
    head = tokens[suffixes]
    want = p.codes[p.start]
    lo, hi = np.searchsorted(head, want), np.searchsorted(head, want, "right")
    live = np.flatnonzero(lo < hi)
    lo, hi = lo[live], hi[live]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    deep = 1
    while len(live):
        more = p.length[live] > deep
        new_lo, new_hi = lo.copy(), lo.copy()
        go = np.flatnonzero(more)
        want = p.codes[p.start[live[go]] + deep]
        new_lo[go] = _bisect(suffixes, tokens, deep, want, lo[go], hi[go], False)
        new_hi[go] = _bisect(suffixes, tokens, deep, want, new_lo[go], hi[go], True)
        ends = np.flatnonzero(deep >= p.window[live])  # places that match no further
        for a, b in ((lo, new_lo), (new_hi, hi)):
            counts = b[ends] - a[ends]
            found.append((np.repeat(live[ends], counts), suffixes[ranges(a[ends], counts)], np.full(int(counts.sum()), deep)))
        on = new_lo < new_hi
        live, lo, hi = live[on], new_lo[on], new_hi[on]
        deep += 1
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _shard(buf, at, p: Probe):
    """Tokens of a slice, one 0 after each text; per row its words and where its tokens begin."""
    low = FOLD[buf]
    starts, ends, row = words(low, at, WORD_OF_LETTERS)
    counts = np.bincount(row, minlength=len(at) - 1)
    h = hashed(low, starts, ends)
    code = np.searchsorted(p.vocabulary, h)
    code[code == len(p.vocabulary)] = 0
    known = p.vocabulary[code] == h
    tokens = np.zeros(len(starts) + len(at), np.int64)
    tokens[np.arange(len(starts)) + row] = np.where(known, code + 1, 0)
    return tokens, counts, np.append(0, np.cumsum(counts + 1))


def _matches(buf, at, p: Probe):
    tokens, counts, begins = _shard(buf, at, p)
    suffixes = suffix_array(tokens, int(p.length.max()))
    which, place, long = search(suffixes, tokens, p)
    return tokens, counts, begins, which, place, long


def _spans(n_tokens: int, place: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Whether each token lies in [place, place + width) of any match."""
    edge = np.bincount(place, minlength=n_tokens + 1) - np.bincount(place + width, minlength=n_tokens + 1)
    return np.cumsum(edge)[:n_tokens] > 0


MATCH = "array<struct<item_id: string, item_word: bigint, doc_word: bigint, words: bigint>>"
FOUND = f"n_words bigint, n_hit bigint, items array<string>, longest_match bigint, matches {MATCH}, hit_words binary"


def _search_block(docs: DataFrame, p: Probe | None, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(p)

    def work(rows, buf, at):
        p, n = shared.value, len(at) - 1
        if p is None:
            _, _, row = words(FOLD[buf], at, WORD_OF_LETTERS)
            none = np.zeros(n, np.int64)
            empty = lists(np.zeros(0, np.int64), pa.array([], pa.string()), n)
            no_match = lists(np.zeros(0, np.int64), _match_structs([], [], [], []), n)
            return [pa.array(np.bincount(row, minlength=n)), pa.array(none), empty, pa.array(none), no_match, binaries(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64))]
        tokens, counts, begins, which, place, long = _matches(buf, at, p)
        hit = _spans(len(tokens), place, p.window[which])
        n_hit = np.add.reduceat(np.append(hit, False).astype(np.int64), begins[:-1]) if n else np.zeros(0, np.int64)
        row = np.searchsorted(begins, place, "right") - 1

        pairs = np.unique((row << 32) | p.window_class[which])
        offsets, flat = p.class_items
        sizes = np.diff(offsets)[pairs & 0xFFFFFFFF]
        owners = np.unique((np.repeat(pairs >> 32, sizes) << 32) | flat[ranges(offsets[pairs & 0xFFFFFFFF], sizes)])
        names = pa.array(p.names, pa.string()).take(pa.array(owners & 0xFFFFFFFF))

        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, row, long)
        # a match that can be grown to the left is part of another
        s, first = p.start[which], p.begin[which]
        inner = (s > first) & (place > 0) & (p.codes[np.maximum(s - 1, 0)] == tokens[np.maximum(place - 1, 0)])
        keep = np.flatnonzero(~inner)
        keep = keep[np.lexsort((which[keep], place[keep]))]
        item_word = s - first
        structs = _match_structs([p.names[i] for i in p.item[which[keep]]], item_word[keep], (place - begins[row])[keep], long[keep])
        bits, at_bytes = _hit_bits(hit, begins, n_hit)
        return [pa.array(counts.astype(np.int64)), pa.array(n_hit), lists(owners >> 32, names, n), pa.array(longest), lists(row[keep], structs, n), binaries(bits, at_bytes)]

    return add_columns(docs, text, FOUND, work, SHARD)


def _hit_bits(hit, begins, n_hit):
    """Places of the hit words of each row, as unsigned 32-bit integers."""
    at = np.flatnonzero(hit)
    row = np.searchsorted(begins, at, "right") - 1
    return (at - begins[row]).astype("<u4"), np.append(0, np.cumsum(n_hit * 4))


def _match_structs(ids, item_word, doc_word, n):
    return pa.StructArray.from_arrays(
        [pa.array(ids, pa.string()), *(pa.array(np.asarray(x, np.int64)) for x in (item_word, doc_word, n))],
        names=["item_id", "item_word", "doc_word", "words"],
    )


def blocks(benchmark: DataFrame, item: str, text: str, block: int = BLOCK) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's (id, text) rows in blocks of about `block` bytes, read one block at a time."""
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    total = rows.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    parts = max(1, -(-total // block))
    if parts == 1:
        yield [tuple(r) for r in rows.collect()]
        return
    for k in range(parts):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k).collect()]


def find(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """docs with n_words, n_hit, items (sorted ids), longest_match, matches and contaminated.

    `matches` lists the verbatim matches that cannot be grown to the left: item, word in
    the item, word in the text, words. With more than one block the corpus is searched
    once per block, and the findings so far are written between two searches.
    """
    docs = without(docs, [*StructType.fromDDL(FOUND).names, "contaminated"], text)
    found = None
    for rows in blocks(benchmark, item, item_text, block):
        p = probe(rows, window)
        if found is None:
            found = _search_block(docs, p, text)
            continue
        before = {c: f"_before_{c}" for c in ("n_hit", "items", "longest_match", "matches", "hit_words")}
        earlier = staged(found, "decontaminate").withColumnsRenamed(before).drop("n_words")
        found = _merged(_search_block(earlier, p, text), docs.columns)
    return found.drop("hit_words").withColumn("contaminated", F.col("n_hit") > 0)


def _merged(df: DataFrame, columns: list[str]) -> DataFrame:
    schema = StructType.fromDDL(FOUND)
    out = df.select(*columns, "n_words").schema
    both = df.select(
        *columns,
        "n_words",
        F.array_sort(F.array_union("_before_items", "items")).alias("items"),
        F.greatest("_before_longest_match", "longest_match").alias("longest_match"),
        F.concat("_before_matches", "matches").alias("matches"),
        "_before_hit_words",
        "hit_words",
    )
    result = StructType([*out.fields, *(schema[c] for c in ("items", "longest_match", "matches", "n_hit", "hit_words"))])

    def run(batches):
        for batch in batches:
            a, b = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_before_hit_words", "hit_words"))
            places = [np.union1d(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")).astype("<u4") for x, y in zip(a, b)]
            made = [pa.array([len(x) for x in places], pa.int64()), pa.array([x.tobytes() for x in places], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], names=result.names)

    joined = in_workers(both, run, result)
    return joined.select(*columns, *schema.names)


def remove(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The rows of docs that hold no window of the benchmark, columns as they are."""
    parts = blocks(benchmark, options.pop("item", "item_id"), options.pop("item_text", "text"), options.pop("block", BLOCK))
    for k, rows in enumerate(parts):
        docs = _without(staged(docs, "decontaminate") if k else docs, probe(rows, options.get("window", WINDOW)), text)
    return docs


def _without(docs: DataFrame, p: Probe | None, text: str) -> DataFrame:
    if p is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(p)

    def keep(rows, buf, at):
        _, _, begins, _, place, _ = _matches(buf, at, shared.value)
        clean = np.ones(len(at) - 1, bool)
        clean[np.searchsorted(begins, place, "right") - 1] = False
        return clean

    return keep_rows(docs, text, keep, SHARD)
