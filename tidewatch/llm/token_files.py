"""Token ids of a corpus in files, Huffman coded.

Texts are encoded with the tokenizers library (a byte-level BPE with its own split pattern)
and the end id is appended to each. Ids are
counted over the whole corpus; package-merge gives the best code lengths of at most
LONGEST bits, and canonical codes follow from the lengths alone. A file set is

    folder/codes    one row per used id: id, bits
    folder/ids      one row per document, in ascending id order within and between buckets, which are
                    ranges of document ids: bucket, id, start (ids before it in its bucket), n_tokens, payload

A payload is a row of independent blocks of up to BLOCK ids, in little-endian 32-bit words:
ids in the block, words of code, bit offset of every CHECK-th id, then the code, most
significant bit first. Decoding peeks LONGEST bits into one table and runs from all
checkpoints of a batch of documents side by side.

A null text is empty and has the end id alone. Rows with the same id follow each other, in
order of their code's checksum; null ids come first. An empty table gives files without rows.
"""

from __future__ import annotations

import bisect
import os
import uuid
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType
from tokenizers import Tokenizer

from ..sources.staging import shared_folder
from .arrays import SPACES, binaries, hashed, in_workers, ranges, slices
from .byte_bpe import safe_pieces

LONGEST = 20
BLOCK = 1 << 16
CHECK = 256
PER_FILE = 16 << 20
PER_EDGE = 64  # rows drawn for each bound between files
DRAWN = 1 << 20  # rows drawn for all of them at most: beyond 16,384 files fewer for each
SLOTS = 1 << 22  # of the table of known pieces, half of which are used: 48 MB and the ids
LINES = 2000

#: Texts of characters below this code point, without the separators named in _plain_rows, are split
#: here; no Unicode version changes what is a letter or a number among them.
SETTLED = 0x500
LETTER, NUMBER, WHITE, OTHER = range(4)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kind of each code point below SETTLED, by the classes of the split pattern."""
    tests = [regex.compile(c) for c in (r"\p{L}", r"\p{N}", r"\s")]
    return np.array([next((k for k, t in enumerate(tests) if t.match(chr(c))), OTHER) for c in range(SETTLED)], np.uint8)


def _plain_rows(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows whose bytes are all of settled characters; 1C-1F, U+0085 and U+00A0 are not white space to every library."""
    odd = (buf >= 0xC0 + (SETTLED >> 6)) | ((buf >= 0x1C) & (buf <= 0x1F))
    if len(buf) > 1:
        odd[:-1] |= (buf[:-1] == 0xC2) & ((buf[1:] == 0x85) | (buf[1:] == 0xA0))
    seen = np.append(0, np.cumsum(odd))
    return seen[at[1:]] == seen[at[:-1]]


def piece_starts(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places where matches of the byte-level split pattern begin, in rows of settled characters.

    Letters, numbers and other characters each form runs, with one space before them; white space
    forms runs without the last character before another kind; and an apostrophe that
    begins a match takes s, t, m, d, re, ve or ll along.
    """
    n = len(buf)
    kinds = _kinds()
    kind = kinds[np.minimum(buf, 0x7F)]
    lead = np.flatnonzero(buf >= 0xC0)
    wide = kinds[np.minimum(((buf[lead].astype(np.int64) & 0x1F) << 6) | (buf[lead + 1] & 0x3F), SETTLED - 1)]
    kind[lead] = wide
    kind[lead + 1] = wide
    first = np.zeros(n + 1, bool)  # first byte of a row
    first[at[:-1]] = True
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 9, kind[:-1]
    before[first[:n]] = 9
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = 9, kind[1:]
    after[first[1:]] = 9
    white = kind == WHITE
    glued = white & (buf == 32) & (after != 9) & (after != WHITE)  # a space that goes with what follows
    start = kind != before
    start |= white & (after != WHITE) & (after != 9)  # the last white character before another kind stands alone
    start[1:] &= ~(glued[:-1] & ~first[1:n])

    marks = np.flatnonzero((buf == 39) & start)
    if len(marks):
        padded = np.append(buf, [0, 0])
        one, two = padded[marks + 1], padded[marks + 2]
        same = ~first[np.minimum(marks + 1, n)]
        short = same & np.isin(one, list(b"stmd"))
        long = same & ~first[np.minimum(marks + 2, n)] & ((((one == 114) | (one == 118)) & (two == 101)) | ((one == 108) & (two == 108)))
        for found, size in ((marks[short], 2), (marks[long], 3)):
            start[found + 1] = False
            stop = found + size
            stop = stop[stop < n]
            start[stop] = True  # what follows begins a match, be it another letter
    return np.flatnonzero(start)


class Known:
    """Ids of pieces by the 64-bit hash of their bytes: an open table that lookups probe side by side."""

    def __init__(self, slots: int):
        self.reset(slots)

    def reset(self, slots: int) -> None:
        """Forget all; slots is a power of two."""
        self.slots, self.mask = slots, np.uint64(slots - 1)
        self.keys = np.zeros(self.slots, np.uint64)
        self.place = np.zeros(self.slots, np.int32)
        self.held = 0
        self.ids = np.zeros(0, np.uint32)
        self.begin = np.zeros(1, np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is not held."""
        out = np.full(len(h), -1, np.int64)
        left, slot = np.arange(len(h)), h & self.mask
        while len(left):
            key = self.keys[slot]
            hit = key == h[left]
            out[left[hit]] = self.place[slot[hit]]
            on = ~hit & (key != 0)
            left, slot = left[on], (slot[on] + np.uint64(1)) & self.mask
        return out

    def add(self, h: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Distinct hashes that are not held, with their ids one after the other."""
        place = np.arange(len(self.begin) - 1, len(self.begin) - 1 + len(h))
        self.ids = np.append(self.ids, ids)
        self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(counts))
        left, slot = np.arange(len(h)), h & self.mask
        while len(left):
            free = self.keys[slot] == 0
            _, pick = np.unique(slot[free], return_index=True)  # one newcomer to a slot
            won = left[free][pick]
            at = slot[free][pick]
            self.keys[at], self.place[at] = h[won], place[won]
            lost = np.ones(len(left), bool)
            lost[np.flatnonzero(free)[pick]] = False
            left, slot = left[lost], (slot[lost] + np.uint64(1)) & self.mask
        self.held += len(h)


class Encoder:
    """A tokenizer that remembers the ids of the pieces its split pattern makes.

    Byte-level BPE never joins two matches of the pattern, so a text's ids are those of
    its matches. Each new match is encoded by the library; texts with characters
    that are not settled are given to it whole, in safe pieces.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        self.library = Tokenizer.from_file(file)
        self.library.encode_special_tokens = True
        alone = self.library.encode("\n", add_special_tokens=False).ids
        self.break_id = alone[0] if len(alone) == 1 else None
        self.known = Known(SLOTS)

    def _learn(self, h: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Pieces are encoded in lines together: a line break ends any match but white space."""
        white = np.isin(buf[ends - 1], list(SPACES)) | (self.break_id is None)
        for k in np.flatnonzero(white).tolist():
            ids = self.library.encode(buf[starts[k] : ends[k]].tobytes().decode(), add_special_tokens=False).ids
            self.known.add(h[k : k + 1], np.array(ids, np.uint32), np.array([len(ids)]))
        h, starts, sizes = h[~white], starts[~white], (ends - starts)[~white]
        if not len(h):
            return
        cuts = np.append(0, np.cumsum(sizes + 1))
        lines = np.full(cuts[-1], 10, np.uint8)
        lines[ranges(cuts[:-1], sizes)] = buf[ranges(starts, sizes)]
        texts = [lines[cuts[a] : cuts[min(a + LINES, len(h))] - 1].tobytes().decode() for a in range(0, len(h), LINES)]
        made = self.library.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array([*line.ids, self.break_id], np.uint32) for line in made])
        breaks = ids == self.break_id
        self.known.add(h, ids[~breaks], np.diff(np.append(-1, np.flatnonzero(breaks))) - 1)

    def _whole(self, text: str) -> np.ndarray:
        return np.concatenate([np.array(self.library.encode(p, add_special_tokens=False).ids, np.uint32) for p in safe_pieces(text)])

    def encode(self, buf: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """ids of each row of a slice."""
        plain = _plain_rows(buf, at)
        rows = np.arange(len(plain))
        if not plain.all():
            keep = np.repeat(plain, np.diff(at))
            own, sizes = buf[keep], np.diff(at)[plain]
        else:
            own, sizes = buf, np.diff(at)
        begin = np.append(0, np.cumsum(sizes))
        starts = piece_starts(own, begin) if len(own) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(own)) if len(starts) else starts
        h = hashed(own, starts, ends) | np.uint64(1)
        which = self.known.find(h)
        new = np.flatnonzero(which < 0)
        if len(new):
            fresh, at_ = np.unique(h[new], return_index=True)
            if self.known.held + len(fresh) > self.known.slots // 2:
                # full: start again with this slice's pieces, in more room where one long text needs it
                fresh, at_ = np.unique(h, return_index=True)
                new = np.arange(len(h))
                self.known.reset(max(SLOTS, 1 << (4 * len(fresh)).bit_length()))
            self._learn(fresh, own, starts[new[at_]], ends[new[at_]])
            which[new] = self.known.find(h[new])
        lo, counts = self.known.begin[which], np.diff(self.known.begin)[which]
        flat = self.known.ids[ranges(lo, counts)]
        cuts = np.append(0, np.cumsum(counts))[np.searchsorted(starts, begin)]
        made = {r: flat[a:b] for r, a, b in zip(rows[plain].tolist(), cuts, cuts[1:])}
        for r in np.flatnonzero(~plain).tolist():
            made[r] = self._whole(buf[at[r] : at[r + 1]].tobytes().decode())
        return [made[r] for r in rows.tolist()]


@lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    return Encoder(file)


def encode(docs: DataFrame, file: str, end: int, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids): ids with the end id, as the low bytes of all ids, then the next bytes, and so on.

    Each task adds one row of counts: n_tokens -1 and, in ids, the ids it met and how often.
    """
    kind = docs.schema[id].dataType
    names = [id, "n_tokens", "ids"]
    schema = StructType().add(id, kind).add("n_tokens", LongType()).add("ids", BinaryType())

    def run(batches):
        total, arrow = np.zeros(1 << 16, np.int64), None
        for batch in batches:
            for rows, buf, at in slices(batch, text):
                parts = [np.append(p, np.uint32(end)) for p in encoder(file).encode(buf, at)]
                sizes = np.array([len(p) for p in parts], np.int64)
                counts = np.bincount(np.concatenate(parts))
                if len(counts) > len(total):
                    total = np.append(total, np.zeros(len(counts) - len(total), np.int64))
                total[: len(counts)] += counts
                planes = np.concatenate([p.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T.ravel() for p in parts])
                own = rows.column(rows.schema.get_field_index(id))
                arrow = own.type
                yield pa.RecordBatch.from_arrays([own, pa.array(sizes), binaries(planes, np.append(0, np.cumsum(sizes * 3)))], names=names)
        if arrow is not None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, arrow), pa.array([-1], pa.int64()), pa.array([np.stack([used, total[used]]).astype("<i8").tobytes()], pa.binary())], names=names)

    return in_workers(docs.select(id, text), run, schema)


def _from_planes(raw: np.ndarray) -> np.ndarray:
    low, mid, high = raw.reshape(3, -1).astype(np.int64)
    return low | mid << 8 | high << 16


def id_counts(encoded: DataFrame) -> DataFrame:
    """(id, n) over all documents, from the rows of counts."""

    def run(batches):
        for batch in batches:
            for x in batch.column(0):
                ids, n = np.frombuffer(x.as_buffer(), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

    return in_workers(encoded.where("n_tokens < 0").select("ids"), run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of each symbol in a best prefix code of at most `longest` bits (package-merge)."""
    n = len(counts)
    if n > 1 << longest:
        raise ValueError(f"{n} symbols need more than {longest} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    is_leaf, row = [], np.zeros(0, np.int64)
    for _ in range(longest):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, packages])
        place = np.argsort(both, kind="stable")
        is_leaf.append(place < n)
        row = both[place]
    bits = np.zeros(n, np.int64)
    taken = 2 * n - 2
    for level in reversed(is_leaf):
        own = int(level[:taken].sum())
        bits[:own] += 1
        taken = 2 * (taken - own)
    out = np.empty(n, np.int64)
    out[order] = bits
    return out


@dataclass(frozen=True)
class Code:
    """Canonical code: symbols by (bits, id)."""

    ids: np.ndarray
    bits: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Code and bits of each id."""
        size = int(self.ids.max(initial=0)) + 1
        codes, bits = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        order = np.lexsort((self.ids, self.bits))
        ids, lengths = self.ids[order], self.bits[order]
        # each code is the sum of the room the codes before it take, cut to its own bits
        room = np.append(0, np.cumsum(np.int64(1) << (LONGEST - lengths)))[:-1]
        codes[ids] = (room >> (LONGEST - lengths)).astype(np.uint64)
        bits[ids] = lengths
        return codes, bits

    def peek_table(self) -> tuple[np.ndarray, np.ndarray]:
        """id and bits for every value of the next LONGEST bits."""
        order = np.lexsort((self.ids, self.bits))
        ids, lengths = self.ids[order], self.bits[order]
        room = np.int64(1) << (LONGEST - lengths)
        fill = (1 << LONGEST) - int(room.sum())
        return np.append(np.repeat(ids, room), np.zeros(fill, np.int64)).astype(np.uint32), np.append(np.repeat(lengths, room), np.ones(fill, np.int64)).astype(np.uint8)


def pack(parts: list[np.ndarray], codes: np.ndarray, bits: np.ndarray) -> list[bytes]:
    """Payload of each array of ids."""
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    sizes = np.array([len(p) for p in parts], np.int64)
    per_doc = -(-sizes // BLOCK)
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(parts)), per_doc)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    begin = first[owner] + nth * BLOCK
    n_ids = np.minimum(BLOCK, first[owner] + sizes[owner] - begin)

    lengths = bits[flat]
    sums = np.append(0, np.cumsum(lengths))
    n_words = -(-(sums[begin + n_ids] - sums[begin]) // 32)
    word = np.cumsum(n_words) - n_words
    within = sums[:-1] - np.repeat(sums[begin], n_ids)
    at = within + np.repeat(word * 32, n_ids)
    out = np.zeros(int(n_words.sum()) + 1, np.uint64)
    if len(flat):
        value = codes[flat] << (64 - (at & 31) - lengths).astype(np.uint64)
        w = at >> 5
        heads = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
        out[w[heads]] += np.add.reduceat(value >> np.uint64(32), heads)
        out[w[heads] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), heads)
    out = out.astype("<u4")
    payloads = [[] for _ in parts]
    for k, d in enumerate(owner.tolist()):
        marks = within[begin[k] : begin[k] + n_ids[k] : CHECK]
        payloads[d] += [np.array([n_ids[k], n_words[k], *marks], "<u4").tobytes(), out[word[k] : word[k] + n_words[k]].tobytes()]
    return [b"".join(p) for p in payloads]


def unpack(payloads: list[np.ndarray], table: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """ids of each payload (little-endian 32-bit words)."""
    starts, counts, n_tokens, base = [], [], [], 0
    for p in payloads:
        at = total = 0
        while at < len(p):
            n, size = int(p[at]), int(p[at + 1])
            marks = -(-n // CHECK)
            code = at + 2 + marks
            starts.append(p[at + 2 : code].astype(np.int64) + (base + code) * 32)
            counts.append(np.minimum(CHECK, n - CHECK * np.arange(marks)))
            total += n
            at = code + size
        n_tokens.append(total)
        base += len(p)
    words = np.append(np.concatenate(payloads), [0, 0]).astype(np.uint64) if payloads else np.zeros(2, np.uint64)
    position = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    many = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    to = np.cumsum(many) - many
    order = np.argsort(-many, kind="stable")
    position, many, to = position[order], many[order], to[order]
    ids = np.zeros(int(sum(n_tokens)), np.uint32)
    symbols, lengths = table
    mask = np.uint64((1 << LONGEST) - 1)
    for step in range(int(many.max(initial=0))):
        live = int(np.searchsorted(-many, -step))
        p = position[:live]
        w = p >> 5
        seen = ((words[w] << np.uint64(32)) | words[w + 1]) >> (64 - LONGEST - (p & 31)).astype(np.uint64) & mask
        ids[to[:live] + step] = symbols[seen]
        position[:live] += lengths[seen]
    return np.split(ids, np.cumsum(n_tokens)[:-1]) if n_tokens else []


def _batches_of(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Rows of a batch with about `limit` bytes in a binary column."""
    sizes = np.array([len(x.as_buffer()) for x in batch.column(batch.schema.get_field_index(column))], np.int64)
    group = (np.cumsum(sizes) - sizes) // limit
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else group
    for a, b in zip(cuts, [*cuts[1:], len(sizes)]):
        yield batch.slice(a, b - a)


def _edges(encoded: DataFrame, id: str, files: int, each: int = PER_EDGE) -> list:
    """Ids between the buckets, in order: steps through a sample of `each` rows a bucket, those whose hashes are least.

    Rows are hashed by id and size, so an id that many rows share is drawn as often as its share. At most
    DRAWN rows; nulls are no edges.
    """
    if files < 2:
        return []
    rows = encoded.select(F.col(id).alias("id"), F.xxhash64(F.col(id), F.crc32("ids")).alias("h")).where("id is not null")
    n, wanted = rows.count(), min(each * files, DRAWN)
    if n > 2 * wanted:
        rows = rows.where(F.col("h") <= int(-(2**63) + 2 * wanted / n * 2**64))
    drawn = sorted(r["id"] for r in rows.orderBy("h").limit(wanted).collect())
    return [drawn[k * len(drawn) // files] for k in range(1, files)] if drawn else []


def _buckets(ids: pa.Array, ties: np.ndarray, edges: list) -> np.ndarray:
    """Bucket of each row by binary search. An id that is several edges shares its buckets by the tie; nulls come first."""
    if not edges:
        return np.zeros(len(ids), np.int32)
    known = pc.fill_null(ids, edges[0])
    if pa.types.is_integer(ids.type):
        bounds, values = np.array(edges, np.int64), known.to_numpy(zero_copy_only=False)
        low, high = np.searchsorted(bounds, values, "left"), np.searchsorted(bounds, values, "right")
    else:
        values = known.to_pylist()
        low, high = (np.array([side(edges, v) for v in values], np.int64) for side in (bisect.bisect_left, bisect.bisect_right))
    bucket = low + ties * (high - low + 1) // (1 << 32)
    return np.where(np.asarray(ids.is_null()), 0, bucket).astype(np.int32)


def write(encoded: DataFrame, folder: str, id: str = "doc_id", per_file: int = PER_FILE) -> None:
    """Writes the file set of an encoded corpus. `encoded` is read three times: give a stored table."""
    spark = encoded.sparkSession
    counts = sorted((r["id"], r["n"]) for r in id_counts(encoded).collect())
    ids, n = (np.array(x, np.int64) for x in (zip(*counts) if counts else ([], [])))
    code = Code(ids, code_lengths(n))
    spark.createDataFrame(pa.table({"id": pa.array(ids), "bits": pa.array(code.bits)}).to_pandas(), "id bigint, bits bigint").coalesce(1).write.parquet(f"{folder}/codes")

    files = max(1, -(-int(n.sum()) // per_file))
    edges = _edges(encoded.where("n_tokens >= 0"), id, files)
    shared, bounds = spark.sparkContext.broadcast(code), spark.sparkContext.broadcast(edges)
    kind = encoded.schema[id].dataType.simpleString()

    def coded(batches):
        codes, bits = shared.value.tables()
        for batch in batches:
            for rows in _batches_of(batch, "ids"):
                parts = [_from_planes(np.frombuffer(x.as_buffer(), np.uint8)) for x in rows.column(2)]
                payloads = pack(parts, codes, bits)
                checks = np.array([zlib.crc32(p) for p in payloads], np.int64)
                bucket = _buckets(rows.column(0), checks, bounds.value)
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), rows.column(0), rows.column(1), pa.array(payloads, pa.binary()), pa.array(checks)], names=["bucket", "id", "n_tokens", "payload", "tie"])

    payloads = in_workers(encoded.where("n_tokens >= 0").select(id, "n_tokens", "ids"), coded, f"bucket int, id {kind}, n_tokens bigint, payload binary, tie bigint")

    def numbered(batches):
        now, before = None, 0
        for batch in batches:
            buckets, sizes = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            starts = np.empty(len(sizes), np.int64)
            for k, (b, size) in enumerate(zip(buckets.tolist(), sizes.tolist())):
                if b != now:
                    now, before = b, 0
                starts[k] = before
                before += size
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts), batch.column(2), batch.column(3)], names=["bucket", "id", "start", "n_tokens", "payload"])

    # every bucket is a task of its own
    ordered = payloads.repartitionById(len(edges) + 1, F.col("bucket")).sortWithinPartitions("bucket", "id", "tie").select("bucket", "id", "n_tokens", "payload")
    rows = in_workers(ordered, numbered, f"bucket int, id {kind}, start bigint, n_tokens bigint, payload binary")
    rows.write.option("compression", "uncompressed").parquet(f"{folder}/ids")


def read(spark: SparkSession, folder: str, id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) of each document; ids are little-endian unsigned 32-bit integers."""
    codes = spark.read.schema("id bigint, bits bigint").parquet(f"{folder}/codes").collect()
    code = Code(*(np.array([r[k] for r in codes], np.int64) for k in ("id", "bits")))
    shared = spark.sparkContext.broadcast(code)
    files = spark.read.parquet(f"{folder}/ids")
    kind = files.schema["id"].dataType.simpleString()
    # ids before each bucket: one row per bucket
    sizes = {r["bucket"]: r["n"] for r in files.groupBy("bucket").agg(F.sum("n_tokens").alias("n")).collect()}
    before, total = {}, 0
    for b in sorted(sizes):
        before[b] = total
        total += sizes[b]
    starts = spark.sparkContext.broadcast(before)

    def run(batches):
        table = shared.value.peek_table()
        for batch in batches:
            for rows in _batches_of(batch, "payload"):
                parts = unpack([np.frombuffer(x.as_buffer(), "<u4") for x in rows.column(4)], table)
                base = np.array([starts.value[b] for b in rows.column(0).to_pylist()], np.int64)
                ids = [p.astype("<u4").tobytes() for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(1), pa.array(base + rows.column(2).to_numpy()), pa.array([len(p) for p in parts], pa.int64()), pa.array(ids, pa.binary())],
                    names=["id", "start", "n_tokens", "ids"],
                )

    return in_workers(files.select("bucket", "id", "start", "n_tokens", "payload"), run, f"id {kind}, start bigint, n_tokens bigint, ids binary").withColumnRenamed("id", id)


def store(docs: DataFrame, file: str, end: int, *, id: str = "doc_id", text: str = "text", folder: str | None = None, per_file: int = PER_FILE) -> str:
    """Encodes docs and writes their file set; returns its folder (by default a new one in the shared folder)."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/token_files/{uuid.uuid4().hex}"
    held = f"{folder}/encoded"
    encode(docs, file, end, id=id, text=text).write.option("compression", "zstd").parquet(held)
    write(spark.read.parquet(held), folder, id, per_file)
    return folder
