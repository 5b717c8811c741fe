"""Jaccard self-join of word shingles with token-combination prefixes.

A document's set is its distinct shingles of WIDTH words. Equal sets are one class, found by
grouping; only classes are joined.

*Order.* Tokens (shingles) in fewer than RARE classes and copies are rare and come first, by hash;
frequent tokens follow, rarer ones first. Any fixed order and any choice of frequent tokens gives
the same links; they only decide how much is compared.

*Prefix.* Two sets of sizes m <= n with similarity s share at least g + 1 tokens within their
prefixes of size - ceil(s * size) + 1 + g. Here g grows with n: one token class per 16 tokens,
by powers of two. A set whose partner may lie in the next power of two takes both prefixes.

*Combinations.* Rare prefix tokens are indexed one by one; fewer than RARE sets hold each.
Frequent prefix tokens are dealt by hash into g classes and indexed in pairs of one class. If
no rare token is shared, g + 1 shared frequent tokens put two into one class, so the pair
is found; and then all shared tokens are frequent, so sets less than s frequent need no pairs.

*Verification, rare.* Sets that meet at rare tokens are counted per pair; the count bounds the
overlap, and the pairs that stay are compared exactly. *Frequent.* Sets that meet at
combinations form families. A family is dealt into blocks of about BLOCK sets; in a block, a
central set is compared with all, then those it did not reach, by counting common
frequent tokens along their posting lists. Families of several blocks are then compared across
blocks, for the sets outside the prevailing component only. No list of pairs is built there.

A null text, an empty one or one of white space has the empty set and links with nothing;
rows that repeat an id are separate documents. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .arrays import FOLD, WORD_BETWEEN_SPACES, add_columns, binaries, hashed, in_workers, map_slices, mixed, ranges, slices, words
from .components import components

WIDTH = 5
SIMILARITY = (4, 5)  # as a fraction
RARE = 8
FREQUENT_LIMIT = 4 << 20  # frequent tokens broadcast; beyond it the commonest are taken
KEYS_LIMIT = 2 << 20  # set keys broadcast as a filter; beyond it a join alone decides
BLOCK = 4096
BLOCK_TOKENS = 2 << 20
PER_BUCKET = 1 << 20
BATCH = 2 << 20


def shingles(buf: np.ndarray, at: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, token): the distinct shingles of each text, by row and token. Shorter texts are one shingle."""
    low = FOLD[buf]
    starts, ends, row = words(low, at, WORD_BETWEEN_SPACES)
    h = hashed(low, starts, ends)
    n = np.bincount(row, minlength=len(at) - 1)
    first = np.cumsum(n) - n
    last = max(len(h) - width + 1, 0)
    token = np.zeros(last, np.uint64)
    for k in range(width):
        token = mixed(token + h[k : last + k])
    whole = row[:last] == row[width - 1 :] if last else np.zeros(0, bool)
    rows, tokens = row[:last][whole], token[whole]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        few = np.full(len(short), 77, np.uint64) + n[short].astype(np.uint64)
        for k in range(width - 1):
            here = n[short] > k
            few[here] = mixed(few[here] + h[first[short[here]] + k])
        rows, tokens = np.append(rows, short), np.append(tokens, few)
    order = np.lexsort((tokens, rows))
    rows, tokens = rows[order], tokens[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (tokens[1:] != tokens[:-1])) if len(rows) else np.zeros(0, bool)
    return rows[new], tokens[new]


def set_keys(rows: np.ndarray, tokens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit key of each row's set; the same set has the same key."""
    sizes = np.bincount(rows, minlength=n)
    sums = np.append(np.uint64(0), np.cumsum(mixed(tokens + np.uint64(0x51ED270B))))
    ends = np.cumsum(sizes)
    return sizes, mixed(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64))


def band(size: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(size, 1).astype(float))[1] - 1


def token_classes(b: np.ndarray) -> np.ndarray:
    """g of a band: one class for 16 tokens of its smallest size."""
    return np.maximum(1, np.left_shift(1, np.maximum(b - 4, 0)))


def least_overlap(size: np.ndarray) -> np.ndarray:
    """ceil(s * size)."""
    p, q = SIMILARITY
    return -(-p * size // q)


def top_band(size: np.ndarray) -> np.ndarray:
    """Band of the largest partner a set can have."""
    p, q = SIMILARITY
    return band(q * size // p)


def prefix(size: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(size, size - least_overlap(size) + 1 + token_classes(b))


class Frequent:
    """Frequent tokens, known by their first `bits` bits; a class is the power of two of the count."""

    def __init__(self, tokens: np.ndarray, classes: np.ndarray, bits: int):
        order = np.argsort(tokens)
        self.tokens, self.classes, self.shift = tokens[order], classes[order], np.uint64(64 - bits)
        self.screen = np.zeros(1 << 22, bool)
        self.screen[self._place(self.tokens)] = True

    @staticmethod
    def _place(top: np.ndarray) -> np.ndarray:
        return (top & np.uint64((1 << 22) - 1)).astype(np.int64)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """Class of each token; 0: rare."""
        top = tokens >> self.shift
        found = np.zeros(len(tokens), np.uint8)
        maybe = np.flatnonzero(self.screen[self._place(top)])
        if len(maybe) and len(self.tokens):
            k = np.minimum(np.searchsorted(self.tokens, top[maybe]), len(self.tokens) - 1)
            found[maybe] = np.where(self.tokens[k] == top[maybe], self.classes[k], 0)
        return found


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


# ---- classes of equal sets


def classes(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, n_shingles, key); the key is null for the empty set."""
    kind = docs.schema[id].dataType.simpleString()

    def work(rows, buf, at):
        row, token = shingles(buf, at)
        sizes, keys = set_keys(row, token, len(at) - 1)
        own = rows.column(rows.schema.get_field_index(id))
        return [own, pa.array(sizes.astype(np.int64)), pa.array(keys.view(np.int64), mask=sizes == 0)]

    return map_slices(docs.select(id, text), text, f"`{id}` {kind}, n_shingles bigint, `key` bigint", work)


# ---- frequent tokens


def _dealt(tokens: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (the first bits - 32 bits) and the 32 bits after it."""
    return (tokens >> np.uint64(96 - bits)).astype(np.int64), ((tokens >> np.uint64(64 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")


def least_class(by_class: dict[int, int], limit: int) -> int:
    """The lowest class down to which all classes together hold at most `limit` tokens."""
    held, least = 0, max(by_class, default=0) + 1
    for c in sorted(by_class, reverse=True):
        held += by_class[c]
        if held > limit:
            break
        least = c
    return least


def frequent_tokens(docs: DataFrame, text: str, bits: int, rare: int = RARE, limit: int = FREQUENT_LIMIT) -> Frequent:
    """Counts all tokens: sorted and added up per task first, so a hot token is one entry a task."""

    def flush(parts):
        tokens, counts = np.unique(np.concatenate(parts) >> np.uint64(64 - bits), return_counts=True)
        bucket, low = (tokens >> np.uint64(32)).astype(np.int64), (tokens & np.uint64(0xFFFFFFFF)).astype("<u4")
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        few = np.minimum(counts, 65535).astype("<u2")
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), binaries(low, cuts * 4), binaries(few, cuts * 2)], names=["bucket", "low", "n"])

    def deal(batches):
        parts, held = [], 0
        for batch in batches:
            for _, buf, at in slices(batch, text):
                _, token = shingles(buf, at)
                parts.append(token)
                held += len(token)
                if held >= BATCH:
                    yield flush(parts)
                    parts, held = [], 0
        if held:
            yield flush(parts)

    def add(table):
        low = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for c in table.column("low").chunks for x in c])
        n = np.concatenate([np.frombuffer(x.as_buffer(), "<u2") for c in table.column("n").chunks for x in c]).astype(np.int64)
        order = np.argsort(low)
        low, n = low[order], n[order]
        heads = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        total = np.add.reduceat(n, heads)
        many = total >= rare
        bucket = int(table.column("bucket")[0].as_py())
        kept = low[heads][many].astype(np.int64) | (bucket << 32)
        return pa.table({"token": pa.array(kept), "class": pa.array(np.frexp(total[many].astype(float))[1].astype(np.int32))})

    dealt = in_workers(docs.select(text), deal, "bucket int, low binary, n binary")
    counted = staged(dealt.groupBy("bucket").applyInArrow(add, "token bigint, class int"), "frequent")
    by_class = {r["class"]: r["n"] for r in counted.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = counted.where(F.col("class") >= least_class(by_class, limit)).toArrow()
    return Frequent(kept["token"].to_numpy().astype(np.uint64), kept["class"].to_numpy().astype(np.uint8), bits)


# ---- prefixes


def _first_time(seen: set, keys: np.ndarray) -> np.ndarray:
    """Rows whose set did not occur before in this task."""
    new = np.zeros(len(keys), bool)
    for k, key in enumerate(keys.tolist()):
        if key not in seen:
            seen.add(key)
            new[k] = True
    if len(seen) > 1 << 20:
        seen.clear()
    return new


def _prefixes(buf, at, frequent: Frequent, seen: set):
    """Per set of a slice: row, token, class, rank among the row's rare tokens; sizes, keys, wanted rows, prefix lengths."""
    n = len(at) - 1
    row, token = shingles(buf, at)
    sizes, keys = set_keys(row, token, n)
    wanted = (sizes >= 4) & _first_time(seen, keys)  # smaller sets link with equal ones only
    kind = frequent.of(token)
    rare = kind == 0
    n_rare = np.bincount(row, rare, minlength=n).astype(np.int64)
    counted = np.cumsum(rare)
    before = np.append(0, np.cumsum(n_rare))[:-1]
    rank = counted - 1 - before[row]
    return row, token, kind, rank, sizes, keys, wanted, n_rare, prefix(sizes, top_band(sizes))


def rare_tokens(docs: DataFrame, text: str, frequent, bits: int) -> DataFrame:
    """(bucket, low, key): rare prefix tokens with their sets, packed by bucket."""

    def flush(parts):
        tokens, keys = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(tokens)
        bucket, low = _dealt(tokens[order], bits)
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int32)), binaries(low, cuts * 4), binaries(keys[order], cuts * 8)], names=["bucket", "low", "key"])

    def deal(batches):
        parts, held, seen = [], 0, set()
        for batch in batches:
            for _, buf, at in slices(batch, text):
                row, token, kind, rank, _, keys, wanted, _, p = _prefixes(buf, at, frequent.value, seen)
                chosen = (kind == 0) & wanted[row] & (rank < p[row])
                if chosen.any():
                    parts.append((token[chosen], keys[row[chosen]]))
                    held += int(chosen.sum())
                if held >= BATCH:
                    yield flush(parts)
                    parts, held = [], 0
        if held:
            yield flush(parts)

    return in_workers(docs.select(text), deal, "bucket int, low binary, key binary")


def meetings(rare: DataFrame) -> DataFrame:
    """(a, b, shared): pairs of sets that meet at rare tokens, and at how many."""

    def pair(table):
        low = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for c in table.column("low").chunks for x in c])
        key = np.concatenate([np.frombuffer(x.as_buffer(), "<i8") for c in table.column("key").chunks for x in c])
        order = np.lexsort((key, low))
        low, key = low[order], key[order]
        new = np.append(True, (low[1:] != low[:-1]) | (key[1:] != key[:-1]))
        low, key = low[new], key[new]
        heads = np.append(np.flatnonzero(np.append(True, low[1:] != low[:-1])), len(low))
        sizes, heads = np.diff(heads), heads[:-1]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size in np.unique(sizes[sizes > 1]).tolist():
            i, j = np.triu_indices(size, 1)
            begin = heads[sizes == size][:, None]
            a.append(key[(begin + i).ravel()])
            b.append(key[(begin + j).ravel()])
        a, b = np.concatenate(a), np.concatenate(b)
        # the same pair again and again: one row a bucket
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
        return pa.table({"a": pa.array(a[first]), "b": pa.array(b[first]), "shared": pa.array(np.diff(np.append(first, len(a))))})

    found = rare.groupBy("bucket").applyInArrow(pair, "a bigint, b bigint, shared bigint")
    return found.groupBy("a", "b").agg(F.sum("shared").alias("shared"))


# ---- sets with few rare tokens


SET = "`key` bigint, n bigint, n_rare bigint, frequent binary, sigs array<bigint>"


def common_sets(docs: DataFrame, text: str, frequent) -> DataFrame:
    """Sets that are at least s frequent: their frequent tokens and their pair signatures."""
    p_, q_ = SIMILARITY

    def work(batches):
        seen: set = set()
        for batch in batches:
            for _, buf, at in slices(batch, text):
                row, token, kind, _, sizes, keys, wanted, n_rare, _ = _prefixes(buf, at, frequent.value, seen)
                chosen = np.flatnonzero(wanted & (q_ * (sizes - n_rare) >= p_ * sizes))
                if not len(chosen):
                    continue
                cuts = np.searchsorted(row, np.append(chosen, chosen + 1))
                blobs, sigs = [], []
                for r, lo, hi in zip(chosen.tolist(), cuts[: len(chosen)].tolist(), cuts[len(chosen) :].tolist()):
                    own, cls = token[lo:hi], kind[lo:hi]
                    often = own[cls > 0][np.argsort(cls[cls > 0], kind="stable")]
                    blobs.append(often.tobytes())
                    sigs.append(pair_signatures(often, int(sizes[r]), int(n_rare[r])))
                yield pa.RecordBatch.from_arrays(
                    [_signed(keys[chosen]), pa.array(sizes[chosen].astype(np.int64)), pa.array(n_rare[chosen]), pa.array(blobs, pa.binary()), pa.array(sigs, pa.list_(pa.int64()))],
                    names=["key", "n", "n_rare", "frequent", "sigs"],
                )

    found = in_workers(docs.select(text), work, SET)
    return found.groupBy("key").agg(*(F.first(c).alias(c) for c in ("n", "n_rare", "frequent", "sigs")))


def pair_signatures(often: np.ndarray, size: int, n_rare: int) -> np.ndarray:
    """Hashes of the pairs of frequent prefix tokens that share a token class, in each band a partner may have."""
    made = []
    own, top = int(band(np.array([size]))[0]), int(top_band(np.array([size]))[0])
    for b in range(own, top + 1):
        g = int(token_classes(np.array([b]))[0])
        room = int(prefix(np.array([size]), np.array([b]))[0]) - n_rare
        held = often[: max(room, 0)]
        dealt = mixed(held + np.uint64(0xC1A55)) % np.uint64(g)
        order = np.lexsort((held, dealt))
        held, dealt = held[order], dealt[order]
        heads = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1])) if len(held) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(heads, len(held)))
        for n in np.unique(sizes[sizes > 1]).tolist():
            i, j = np.triu_indices(n, 1)
            begin = heads[sizes == n][:, None]
            made.append(mixed(mixed(held[(begin + i).ravel()] + np.uint64(b)) + held[(begin + j).ravel()]))
    return np.unique(np.concatenate(made)).view(np.int64) if made else np.zeros(0, np.int64)


def links_between(index: list[np.ndarray], n: np.ndarray, probes: Iterator[tuple[int, np.ndarray, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """For each probe (name, frequent tokens, size): places in the index whose sets link with it."""
    p_, q_ = SIMILARITY
    flat = np.concatenate(index) if index else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(index)), [len(x) for x in index])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for name, tokens, size in probes:
        lo, hi = np.searchsorted(flat, tokens), np.searchsorted(flat, tokens, "right")
        common = np.bincount(owner[ranges(lo, hi - lo)], minlength=len(index))
        yield name, np.flatnonzero((common > 0) & (q_ * common >= p_ * (size + n - common)))


def spanning_links(index: list[np.ndarray], n: np.ndarray, centrality: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect every component of a block: the most central set first, then those not yet reached.

    A probe is compared with all sets of the block. A set that is in the first one's component
    when its turn comes needs no probe: any set outside of it makes its own.
    """
    joined = np.arange(len(index))

    def root(x: int) -> int:
        while joined[x] != x:
            joined[x] = joined[joined[x]]
            x = joined[x]
        return x

    order = np.argsort(centrality, kind="stable").tolist()

    def probes():
        for k in order:
            if k == order[0] or root(k) != root(order[0]):
                yield k, index[k], int(n[k])

    found = []
    for k, near in links_between(index, n, probes()):
        for other in near.tolist():
            a, b = root(k), root(other)
            if a != b:
                joined[max(a, b)] = min(a, b)
                found.append((k, other))
    return found


def _sets_of(table: pa.Table):
    blobs = [np.frombuffer(x.as_buffer(), np.uint64) for c in table.column("frequent").chunks for x in c]
    return blobs, table.column("n").to_numpy(), table.column("n_rare").to_numpy(), table.column("key").to_numpy()


LINK = "a bigint, b bigint"


def _link_table(pairs: list[tuple[int, int]]) -> pa.Table:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _block_links(table: pa.Table) -> pa.Table:
    index, n, n_rare, keys = _sets_of(table)
    found = spanning_links(index, n, n_rare / n)
    return _link_table([(int(keys[a]), int(keys[b])) for a, b in found])


def _probe_links(left: pa.Table, right: pa.Table) -> pa.Table:
    """left: a block's sets; right: probes from elsewhere."""
    if not left.num_rows or not right.num_rows:
        return _link_table([])
    index, n, _, keys = _sets_of(left)
    blobs, sizes, _, names = _sets_of(right)
    found = []
    for name, near in links_between(index, n, zip(names.tolist(), blobs, sizes.tolist())):
        found += [(name, int(keys[k])) for k in near.tolist() if keys[k] != name]
    return _link_table(found)


def _meetings_at_combinations(sets: DataFrame) -> DataFrame:
    """(a, b): links each set to the smallest that shares a signature, over one of its own batch.

    Within a batch every set points to the smallest that holds the signature; only that one
    goes on to the shuffle, so a signature held by a large share of all sets is a row per batch there.
    """

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            held = batch.column(1)
            sig = held.flatten().to_numpy()
            key = np.repeat(keys, np.diff(held.offsets.to_numpy()))
            order = np.lexsort((key, sig))
            sig, key = sig[order], key[order]
            heads = np.append(True, sig[1:] != sig[:-1]) if len(sig) else np.zeros(0, bool)
            least = key[heads][np.cumsum(heads) - 1] if len(sig) else key
            # the smallest set once per signature, and each other set once per smallest one
            pairs = np.unique(np.stack([key[~heads], least[~heads]], 1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(np.zeros(len(pairs), np.int64), sig[heads])), pa.array(np.append(pairs[:, 0], key[heads])), pa.array(np.append(pairs[:, 1], key[heads]))],
                names=["sig", "a", "b"],
            )

    local = staged(in_workers(sets.select("key", "sigs"), run, "sig bigint, a bigint, b bigint"), "meetings")
    heads = local.where("a = b").select("sig", "a")
    pivots = heads.groupBy("sig").agg(F.min("a").alias("b"))
    return local.where("a <> b").select("a", "b").union(heads.join(pivots, "sig").where("a <> b").select("a", "b")).distinct()


def common_links(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links that connect the sets that meet at combinations of frequent tokens. `sets` is a stored table."""
    meet = _meetings_at_combinations(sets)
    families = components(meet).select(F.col("node").alias("key"), F.col("label").alias("family"))
    sizes = families.join(sets.select("key", "n"), "key").groupBy("family").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens"))
    # within a large family sets with the same smallest signature go together
    full = F.greatest(F.col("members") / block, F.col("tokens") / BLOCK_TOKENS)
    parts = F.when(full <= 1, 1).otherwise(F.ceil(full * 2))
    home = sets.join(families, "key").join(sizes, "family").withColumn("block", F.pmod(F.xxhash64(F.element_at("sigs", 1)), parts))
    home = staged(home.select("key", "n", "n_rare", "frequent", "sigs", "family", "block", F.lit(0).alias("piece")), "families")
    home = _cut(home, block)
    inside = staged(home.groupBy("family", "block", "piece").applyInArrow(_block_links, LINK), "links")
    if home.groupBy("family").agg(F.count_distinct("block", "piece").alias("n")).where("n > 1").isEmpty():
        return inside
    # across blocks: first the most central set of each component of a block, then all that lie apart
    place = home.select("key", "family", "block", "piece", F.explode("sigs").alias("sig"))
    for central_only in (True, False):
        labels = components(inside)
        named = home.select("key", "n", "n_rare", "block", "piece").join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
        if central_only:
            chosen = named.groupBy("block", "piece", "label").agg(F.min_by("key", F.struct(F.col("n_rare") / F.col("n"), "key")).alias("key")).select("key").distinct()
            probing = place.join(chosen, "key", "left_semi")
            known = None
        else:
            weight = named.groupBy("label").agg(F.count(F.lit(1)).alias("weight"))
            known = staged(named.select("key", "label").join(weight, "label"), "labels")
            marked = place.join(known, "key")
            main = marked.groupBy("sig").agg(F.max(F.struct("weight", "label")).alias("main"))
            probing = marked.join(main, "sig").where("label <> main.label").select(*place.columns)
        spots = place.select("sig", "family", "block", "piece").distinct().withColumnsRenamed({c: f"to_{c}" for c in ("family", "block", "piece")})
        probes = probing.select("key", "sig", "family", "block", "piece").join(spots, "sig").where("block <> to_block or piece <> to_piece")
        probes = probes.select("key", F.col("to_family").alias("family"), F.col("to_block").alias("block"), F.col("to_piece").alias("piece")).distinct()
        sent = staged(probes.join(home.select("key", "n", "n_rare", "frequent"), "key"), "probes")
        across = _probed(home, sent)
        inside = staged(inside.union(across), "links")
    return inside


def _probed(home: DataFrame, sent: DataFrame, tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Links between blocks and the sets sent to them; a task compares one block with sets of about `tokens` tokens."""
    spot = ["family", "block", "piece"]
    deals = staged(sent.groupBy(*spot).agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / tokens)).cast("int").alias("deals")), "deals")
    dealt = sent.join(deals, spot).withColumn("deal", F.pmod(F.xxhash64("key"), F.col("deals")).cast("int")).drop("deals")
    blocks = home.join(deals, spot).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
    return blocks.groupBy(*spot, "deal").cogroup(dealt.groupBy(*spot, "deal")).applyInArrow(_probe_links, LINK)


def _cut(home: DataFrame, block: int) -> DataFrame:
    """Blocks that many sets share a smallest signature in are cut into pieces by key."""
    sizes = home.groupBy("family", "block").agg(F.greatest(F.count(F.lit(1)) / block, F.sum("n") / BLOCK_TOKENS).alias("full"))
    if sizes.where("full > 1").isEmpty():
        return home
    pieces = F.ceil("full")
    return staged(home.drop("piece").join(sizes, ["family", "block"]).withColumn("piece", F.pmod(F.xxhash64("key"), pieces)).drop("full"), "families")


# ---- exact comparison of pairs


def verified(docs: DataFrame, text: str, pairs: DataFrame) -> DataFrame:
    """The (a, b) pairs that link, by their whole sets. `pairs` is a stored table."""
    p_, q_ = SIMILARITY
    keys = staged(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "keys")
    few = keys.count()
    wanted = None
    if few <= KEYS_LIMIT:
        wanted = docs.sparkSession.sparkContext.broadcast(np.sort(keys.toArrow()["key"].to_numpy()))

    def sets(batches):
        seen: set = set()
        for batch in batches:
            for _, buf, at in slices(batch, text):
                row, token = shingles(buf, at)
                sizes, found = set_keys(row, token, len(at) - 1)
                found = found.view(np.int64)
                take = (sizes > 0) & _first_time(seen, found)
                if wanted is not None and len(wanted.value):
                    k = np.minimum(np.searchsorted(wanted.value, found), len(wanted.value) - 1)
                    take &= wanted.value[k] == found
                elif wanted is not None:
                    take[:] = False
                inside = take[row]
                if take.any():
                    ends = np.append(0, np.cumsum(sizes[take] * 8))
                    yield pa.RecordBatch.from_arrays([pa.array(found[take]), binaries(token[inside], ends)], names=["key", "tokens"])

    own = in_workers(docs.select(text), sets, "`key` bigint, tokens binary")
    if wanted is None:
        own = own.join(keys, "key", "left_semi")
    own = staged(own.groupBy("key").agg(F.first("tokens").alias("tokens")), "sets")

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(q_ * common >= p_ * (len(x) + len(y) - common))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    both = pairs.join(own.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a").join(own.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b")
    return in_workers(both.select("a", "b", "x", "y"), compare, LINK)


def promising(meeting: DataFrame, sets: DataFrame, common: DataFrame) -> DataFrame:
    """Meetings whose shared rare tokens leave room for enough overlap.

    Prefix tokens shared are the rare ones counted and at most the frequent ones of the shorter
    frequent part; beyond the prefix at most size - prefix tokens follow. `sets` holds (key, n).
    """
    p_, q_ = SIMILARITY
    size = sets.select("key", F.col("n_shingles").alias("n"))
    rare = common.select("key", "n_rare")
    both = meeting
    for end in ("a", "b"):
        both = both.join(size.select(F.col("key").alias(end), F.col("n").alias(f"n_{end}")), end)
        both = both.join(rare.select(F.col("key").alias(end), F.col("n_rare").alias(f"rare_{end}")), end, "left")

    def head(n):
        top = F.floor(F.log2(F.floor(n * q_ / p_) + F.lit(0.5))).cast("long")
        g = F.greatest(F.lit(1), F.pow(F.lit(2.0), F.greatest(top - 4, F.lit(0))).cast("long"))
        return F.least(n, n - F.ceil(n * p_ / q_) + 1 + g)

    def often(end):
        # frequent prefix tokens: none is known of sets that hold many rare ones but what the prefix leaves
        n, r = F.col(f"n_{end}"), F.col(f"rare_{end}")
        return F.greatest(F.lit(0), head(n) - F.coalesce(r, F.ceil(n * (q_ - p_) / q_)))

    beyond = F.greatest(F.col("n_a") - head(F.col("n_a")), F.col("n_b") - head(F.col("n_b")))
    most = F.col("shared") + F.least(often("a"), often("b")) + beyond
    fits = (F.col("n_a") * p_ <= F.col("n_b") * q_) & (F.col("n_b") * p_ <= F.col("n_a") * q_)
    return both.where(fits & (most * (p_ + q_) >= (F.col("n_a") + F.col("n_b")) * p_)).select("a", "b")


# ---- the join


def _bits(n_tokens: int) -> int:
    return 32 + max(6, math.ceil(math.log2(max(n_tokens, 1) / PER_BUCKET)) if n_tokens > PER_BUCKET else 6)


def grouped(docs: DataFrame, *, id: str = "doc_id", text: str = "text", rare: int = RARE, block: int = BLOCK) -> DataFrame:
    """id, n_shingles, key (of the set; null for none), component_id (smallest id of the documents reachable by links) and label (the component's own; null for none)."""
    spark = docs.sparkSession
    docs = docs.select(id, text)
    nodes = staged(classes(docs, id, text), "classes")
    bits = _bits(nodes.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0)
    frequent = spark.sparkContext.broadcast(frequent_tokens(docs, text, bits, rare))
    common = staged(common_sets(docs, text, frequent), "common")
    unique = staged(nodes.where("key is not null").groupBy("key").agg(F.min(id).alias("first_id"), F.first("n_shingles").alias("n_shingles")), "sets")
    meeting = meetings(rare_tokens(docs, text, frequent, bits))
    pairs = staged(promising(meeting, unique, common), "pairs")
    links = verified(docs, text, pairs).union(common_links(common, block))
    labels = components(links)
    joined = unique.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    smallest = joined.groupBy("label").agg(F.min("first_id").alias("component_id"))
    reached = staged(joined.select("key", "label").join(smallest, "label").select("key", "component_id", "label"), "components")
    linked = nodes.where("key is not null").join(reached, "key")
    alone = nodes.where("key is null").withColumn("component_id", F.col(id)).withColumn("label", F.lit(None).cast("bigint"))
    columns = [id, "n_shingles", "key", "component_id", "label"]
    return linked.select(*columns).unionByName(alone.select(*columns))


def distinct_documents(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs with one row of each component, one with the smallest id (null after all others); columns as they are.

    Rows without words all stay. Rows that repeat an id, or have none, are documents of their own: they are told
    apart by their set key, read again for these rows only. Of several sets under the smallest id the smallest key stays.
    """
    found = staged(grouped(docs, id=id, text=text, **options), "grouped")
    again = staged(found.where(F.col(id).isNotNull()).groupBy(id).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id), "repeated")
    dropped = found.where(F.col("component_id") != F.col(id)).select(id).distinct()
    if again.isEmpty() and found.where(F.col(id).isNull() & F.col("key").isNotNull()).isEmpty():
        return docs.join(dropped, id, "left_anti").select(*docs.columns)
    single = docs.where(F.col(id).isNotNull()).join(dropped, id, "left_anti").join(again, id, "left_anti").select(*docs.columns)
    several = docs.join(again, id, "left_semi").select(*docs.columns).unionByName(docs.where(F.col(id).isNull()))
    key = "_set"
    while key in {c.lower() for c in docs.columns}:
        key = "_" + key

    def work(rows, buf, at):
        row, token = shingles(buf, at)
        sizes, keys = set_keys(row, token, len(at) - 1)
        return [pa.array(keys.view(np.int64), mask=sizes == 0)]

    keyed = add_columns(several, text, f"`{key}` bigint", work)
    least = F.min(F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("own"), F.col("key").alias("set")))
    first = found.where("key is not null").groupBy("label").agg(least.alias("r")).select(F.col("r.own").alias("_own"), F.col("r.set").alias("_first"))
    chosen = keyed.join(first, keyed[id].eqNullSafe(first["_own"]) & (keyed[key] == first["_first"]), "left_semi").dropDuplicates([id, key])
    return single.unionByName(chosen.select(*docs.columns)).unionByName(keyed.where(F.col(key).isNull()).select(*docs.columns))
