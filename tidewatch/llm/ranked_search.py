"""Ranked lexical search by scanning the documents with an automaton of all items' terms.

No index of the documents is built. The terms of all items are one Aho-Corasick automaton whose
patterns have a guard, a space, on both sides; every byte that belongs to no term is read as that
guard, so a pattern is found where a whole term stands and nowhere else. One scan gives every
document's length and the counts of the items' terms in it. That narrow table is written; it
gives document frequencies, and from it every task scores its documents: a term's output is the list of
the items that hold it, and a task passes on its best k documents of each item.

The items are broadcast in blocks of about BLOCK bytes of text, the documents scanned once a block.
Texts are scanned in pieces of PIECE bytes, with the automaton's state carried on, so a very
long text needs no more memory than itself. Texts are not shuffled; many copies of one text tie and are
told apart by id in every task, k a task.

A null or empty text has no terms and is never found; a null id is ranked after the others; rows
that repeat an id are documents of their own. Items without id or text are left out, equal items are
one, and two texts under one id are two items. Only the id and text columns are read. Empty
tables give an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.staging import staged
from .arrays import FOLD, WORD_OF_LETTERS, in_workers, lists, map_slices, ranges, words
from .decontaminate import blocks

BEST = 10
BLOCK = 1 << 20  # bytes of item text in one automaton
PIECE = 1 << 19
CELLS = 1 << 21  # scores worked on at once
SALTS = 64
GUARD = 0x20
#: every byte of a term in lower case, every other byte as the guard
GUARDED = np.where(WORD_OF_LETTERS, FOLD, GUARD).astype(np.uint8)
FOUND = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
SCORED = "number int, item_id string, doc_id bigint, score bigint"


@dataclass(frozen=True)
class Terms:
    """The terms of one block of items and, for each term, the items that hold it with their repeats."""

    names: list[str]  # id of each item
    terms: list[str]  # distinct, each byte one character
    offsets: np.ndarray  # of each term's list
    items: np.ndarray  # number of the item
    repeats: np.ndarray


def item_terms(items: list[tuple[str, str]]) -> Terms:
    """The terms of (id, text) rows."""
    items = sorted(set(items))
    held: dict[str, list[tuple[int, int]]] = {}
    for k, (_, text) in enumerate(items):
        buf = FOLD[np.frombuffer(text.encode(), np.uint8)]
        whole = buf.tobytes().decode("latin-1")
        starts, ends, _ = words(buf, np.array([0, len(buf)]), WORD_OF_LETTERS)
        for term, n in Counter(whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())).items():
            held.setdefault(term, []).append((k, n))
    terms = sorted(held)
    pairs = np.array([p for t in terms for p in held[t]], np.int64).reshape(-1, 2)
    offsets = np.cumsum([0, *(len(held[t]) for t in terms)])
    return Terms([i for i, _ in items], terms, offsets, pairs[:, 0].copy(), pairs[:, 1].copy())


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Finds guard, term, guard; what it puts out is the term's number."""
    machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, term in enumerate(terms):
        machine.add_word(f" {term} ", k)
    machine.make_automaton()
    return machine


def count_terms(machine: ahocorasick.Automaton, buf: np.ndarray, at: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each row; and of each row and found term: row, term, count) of texts lying one after the other."""
    rows = len(at) - 1
    if rows == 1 and len(buf) > piece:
        n, terms, counts = _count_long(machine, buf, piece)
        return np.array([n]), np.zeros(len(terms), np.int64), terms, counts
    begins = at[:-1] + np.arange(rows)  # of each row: a guard, then its text
    text = np.full(len(buf) + rows + 1, GUARD, np.uint8)
    text[np.arange(len(buf)) + np.repeat(np.arange(1, rows + 1), np.diff(at))] = GUARDED[buf]
    starts = np.flatnonzero((text[1:] != GUARD) & (text[:-1] == GUARD))
    n = np.bincount(np.searchsorted(begins, starts, "right") - 1, minlength=rows)
    ends, terms = _outputs(machine.iter(text.tobytes().decode("latin-1")))
    keys, counts = np.unique((np.searchsorted(begins, ends, "left") - 1) << 32 | terms, return_counts=True)
    return n, keys >> 32, keys & 0xFFFFFFFF, counts


def _outputs(found) -> tuple[np.ndarray, np.ndarray]:
    flat = np.fromiter(chain.from_iterable(found), np.int64)
    return flat[0::2], flat[1::2]


def _count_long(machine, buf: np.ndarray, piece: int) -> tuple[int, np.ndarray, np.ndarray]:
    """One text by pieces: the automaton goes on in the state in which the piece before left it."""
    search = machine.iter(" ")
    n, before, totals = 0, True, Counter()
    for lo in range(0, len(buf) + 1, piece):
        text = GUARDED[buf[lo : lo + piece]]
        if lo + piece > len(buf):
            text = np.append(text, np.uint8(GUARD))
        outside = text == GUARD
        n += int(np.count_nonzero(~outside[1:] & outside[:-1])) + int(before and not outside[0])
        before = bool(outside[-1])
        for _ in search:  # what is left of the piece before
            pass
        search.set(text.tobytes().decode("latin-1"))
        terms, counts = np.unique(_outputs(search)[1], return_counts=True)
        totals.update(dict(zip(terms.tolist(), counts.tolist())))
    terms = np.array(sorted(totals), np.int64)
    return n, terms, np.array([totals[t] for t in terms.tolist()], np.int64)


_machines: dict[int, ahocorasick.Automaton] = {}


def _machine(shared) -> ahocorasick.Automaton:
    """One automaton a worker, of the block in hand."""
    key = hash(tuple(shared.value.terms))
    if key not in _machines:
        _machines.clear()
        _machines[key] = automaton(shared.value.terms)
    return _machines[key]


def scan(docs: DataFrame, block: Terms, *, text: str = "text", order: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n (its terms), terms (numbers of the block's terms in it) and counts."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    own = docs.select(F.col(order).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    machine: list = []

    def work(rows, buf, at):
        if not machine:
            machine.append(_machine(shared))
        n, row, terms, counts = count_terms(machine[0], buf, at)
        size = len(at) - 1
        ids = rows.column(rows.schema.get_field_index("doc_id"))
        return [ids, pa.array(n.astype(np.int64)), lists(row, pa.array(terms, pa.int32()), size), lists(row, pa.array(counts, pa.int64()), size)]

    return map_slices(own, "text", FOUND, work)


def norms(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """25 + 75 * n * N div L, also where the product exceeds 64 bits."""
    if int(n.max(initial=0)) * 75 * documents >= 1 << 63:
        return np.array([25 + 75 * x * documents // length for x in n.tolist()], np.int64)
    return 25 + 75 * n * documents // length


class Best:
    """The k best documents of each item, of all that were added."""

    def __init__(self, items: int, k: int):
        self.k, self.items = k, items
        self.rows = [np.zeros(0, np.int64)] * 4  # item, -score, no id, id
        self.floor = np.zeros(items, np.int64)  # score and id that a document must beat
        self.floor_id = np.zeros(items, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        """scores: a row a document, a column an item."""
        doc, item = np.nonzero((scores > self.floor) | ((scores == self.floor) & (scores > 0) & (ids[:, None] < self.floor_id)))
        if not len(doc):
            return
        new = item, -scores[doc, item], no_id[doc], ids[doc]
        rows = [np.concatenate(p) for p in zip(self.rows, new)]
        sort = np.lexsort(rows[::-1])
        rows = [r[sort] for r in rows]
        place = np.arange(len(sort)) - np.searchsorted(rows[0], rows[0])
        self.rows = [r[place < self.k] for r in rows]
        last = place[place < self.k] == self.k - 1
        full = self.rows[0][last]
        self.floor[full] = -self.rows[1][last]
        self.floor_id[full] = self.rows[3][last]


def _score(found: DataFrame, block: Terms, frequency: dict[int, int], documents: int, length: int, k: int, first: int) -> DataFrame:
    """The best k documents of each item and task."""
    weight = np.zeros(len(block.terms), np.int64)
    for term, n in frequency.items():
        weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    shared = found.sparkSession.sparkContext.broadcast((block.offsets, block.items, block.repeats * np.repeat(weight, np.diff(block.offsets)), block.names))
    schema = StructType.fromDDL(SCORED)

    def run(batches):
        offsets, items, worth, names = shared.value
        best = Best(len(names), k)
        for batch in batches:
            for part in _parts(batch, offsets, len(names)):
                best.add(*_scores(part, offsets, items, worth, len(names), documents, length))
        item, score, no_id, ids = best.rows
        for lo in range(0, len(item), 1 << 16):
            cut = slice(lo, lo + (1 << 16))
            doc = pa.array(ids[cut], pa.int64(), mask=no_id[cut].astype(bool))
            made = [pa.array((item[cut] + first).astype(np.int32)), pa.array([names[i] for i in item[cut].tolist()], pa.string()), doc, pa.array(-score[cut])]
            yield pa.RecordBatch.from_arrays(made, names=schema.names)

    return in_workers(found, run, schema)


def _parts(batch: pa.RecordBatch, offsets: np.ndarray, items: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most CELLS scores and as many outputs, one row at least."""
    lengths = np.diff(offsets)
    terms = batch.column("terms")
    each = np.append(0, np.cumsum(lengths[np.asarray(terms.flatten(), np.int64)]))
    at = np.asarray(terms.offsets, np.int64) - (terms.offsets[0].as_py() if len(terms) else 0)
    work = each[at]
    row, most = 0, max(1, CELLS // max(items, 1))
    while row < len(batch):
        stop = max(row + 1, min(row + most, int(np.searchsorted(work, work[row] + CELLS, "right")) - 1, len(batch)))
        yield batch.slice(row, stop - row)
        row = stop


def _scores(part: pa.RecordBatch, offsets, items, worth, n_items: int, documents: int, length: int):
    """Scores of the rows (documents by items), their ids, and which have none."""
    lists_ = part.column("terms")
    term = np.asarray(lists_.flatten(), np.int64)
    count = np.asarray(part.column("counts").flatten(), np.int64)
    doc = np.repeat(np.arange(len(part)), np.asarray(pc.list_value_length(lists_), np.int64))
    m = norms(np.asarray(part.column("n"), np.int64), documents, length)
    level = 1_000_000_000 * count // (1000 * count + 8 * m[doc])
    reach = offsets[term + 1] - offsets[term]
    out = ranges(offsets[term], reach)
    scores = np.zeros(len(part) * n_items, np.int64)
    np.add.at(scores, np.repeat(doc * n_items, reach) + items[out], worth[out] * np.repeat(level, reach))
    ids = part.column("doc_id")
    no_id = np.asarray(ids.is_null()).astype(np.int64)
    return scores.reshape(len(part), n_items), np.asarray(pc.fill_null(ids, (1 << 63) - 1), np.int64), no_id


def search(
    docs: DataFrame, items: DataFrame, *, k: int = BEST, text: str = "text", order: str = "doc_id", item: str = "item_id", item_text: str = "text", block: int = BLOCK
) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest score above 0 of each item."""
    parts, first, totals = [], 0, None
    for rows in blocks(items, item, item_text, block):
        terms = item_terms(rows)
        if not terms.terms:
            continue
        found = staged(scan(docs, terms, text=text, order=order), "search")
        totals = totals or found.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        frequency = {r[0]: r[1] for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # at most the block's terms
        parts.append(_score(found.where("size(terms) > 0"), terms, frequency, totals[0], totals[1], k, first))
        first += len(terms.names)
    none = docs.sparkSession.createDataFrame([], SCORED)
    best = reduce(DataFrame.unionByName, parts, none) if len(parts) != 1 else parts[0]
    # in two steps, so that one task ranks no more than SALTS * k rows of an item
    for keys in (["number", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))], ["number"]):
        order_by = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = best.withColumn("rank", F.row_number().over(order_by)).where(F.col("rank") <= k)
    kind = items.schema[item].dataType if item in items.columns else "string"
    return best.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")
