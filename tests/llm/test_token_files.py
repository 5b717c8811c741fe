from __future__ import annotations

import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from tidewatch.llm import token_files
from tidewatch.llm.token_files import _buckets, BLOCK, Code, code_lengths, encode, pack, piece_starts, read, store, unpack

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return t


def odd_texts():
    rng = random.Random(5)
    parts = ["a", "b", "é", "ж", "s", "t", "l", "re", "ve", "ll", "'", "'", " ", " ", "\n", "\t", "1", "½", "!", "-", "漢", "\xa0", "\x1c", "԰", "🙂", "d", "m", "<|endoftext|>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(2000)]


def test_splits_like_the_pattern():
    pattern = regex.compile(public_tokenizers.PATTERN)
    settled = [t for t in odd_texts() if all(c < "Ԁ" and c not in "\x1c\xa0\x85" for c in t)]
    raw = [t.encode() for t in settled]
    at = np.cumsum([0, *map(len, raw)])
    starts = piece_starts(np.frombuffer(b"".join(raw), np.uint8), at)
    for t, lo, hi in zip(settled, at, at[1:]):
        want = np.cumsum([0, *(len(p.encode()) for p in pattern.findall(t))])[:-1].tolist() if t else []
        assert (starts[(starts >= lo) & (starts < hi)] - lo).tolist() == want, t


def test_a_full_table_of_pieces_starts_again(library, monkeypatch):
    monkeypatch.setattr(token_files, "SLOTS", 64)
    encoder = token_files.Encoder(FILE)
    rng = random.Random(6)
    for size in (10, 40, 400, 5, 3000):
        texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(size)), "w1 w2", ""]
        raw = [t.encode() for t in texts]
        got = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def huffman_cost(counts):
    heap = list(counts)
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        total += x
        heapq.heappush(heap, x)
    return total


def test_code_lengths_are_best():
    rng = np.random.default_rng(0)
    for n in (2, 3, 10, 300):
        counts = rng.integers(1, 1000, n)
        bits = code_lengths(counts, 20)
        assert (counts * bits).sum() == huffman_cost(counts.tolist())
        assert (0.5 ** bits.astype(float)).sum() == 1
    steep = np.array([2**k for k in range(30)])
    bits = code_lengths(steep, 8)
    assert bits.max() == 8 and (0.5 ** bits.astype(float)).sum() <= 1
    assert code_lengths(np.array([5])).tolist() == [1] and code_lengths(np.array([], np.int64)).tolist() == []
    with pytest.raises(ValueError):
        code_lengths(np.ones(5, np.int64), 2)


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    parts = [rng.zipf(1.3, n) % 50_000 for n in (0, 1, 255, 256, 257, 5000, BLOCK, BLOCK + 1, 2 * BLOCK + 300)]
    ids, counts = np.unique(np.concatenate(parts), return_counts=True)
    code = Code(ids, code_lengths(counts))
    payloads = pack(parts, *code.tables())
    back = unpack([np.frombuffer(p, "<u4") for p in payloads], code.peek_table())
    assert [x.tolist() for x in back] == [p.tolist() for p in parts]


def test_files(spark, docs, library, tmp_path):
    texts = [*odd_texts()[:500], None, "", "same", "same", "long word " * 30_000, "a" * 20_000]
    ids = [*range(3, 503), 900, 901, None, 0, 2, 903]
    source = docs(texts, ids).union(docs(["tie", "tie", "other tie"], [901, 901, 901]))
    for per_file in (1 << 20, 700):
        folder = store(source, FILE, 2, folder=str(tmp_path / str(per_file)), per_file=per_file)
        rows = sorted(read(spark, folder).collect(), key=lambda r: r["start"])
        assert len(rows) == 509
        keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
        assert keys == sorted(keys)
        before = 0
        for r in rows:
            assert r["start"] == before
            before += r["n_tokens"]
        want = {}
        for i, t in [*zip(ids, texts), (901, "tie"), (901, "tie"), (901, "other tie")]:
            want.setdefault(i, []).append(zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()))
        got = {}
        for r in rows:
            got.setdefault(r["doc_id"], []).append(zlib.crc32(r["ids"]))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_empty_table(spark, docs, tmp_path):
    assert encode(docs([]), FILE, 2).count() == 0
    folder = store(docs([]), FILE, 2, folder=str(tmp_path / "none"))
    assert read(spark, folder).count() == 0


def test_ids_that_are_text(spark, docs, tmp_path):
    """Any type with an order: names sort as Spark sorts them; a hot id shares its buckets."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    names = [f"{'é' if k % 7 == 0 else 'n'}{int(x)}" for k, x in enumerate(rng.integers(0, 500, 300))] + ["hot"] * 300 + [None] * 5
    source = docs([f"text {k} of some words" for k in range(605)]).withColumn("doc_id", F.element_at(F.array(*[F.lit(x) for x in names]), F.col("doc_id").cast("int") + 1))
    folder = store(source, FILE, 2, folder=str(tmp_path / "named"), per_file=150)
    rows = sorted(read(spark, folder).collect(), key=lambda r: r["start"])
    keys = [(r["doc_id"] is not None, (r["doc_id"] or "").encode()) for r in rows]
    assert len(rows) == 605 and keys == sorted(keys)
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    sizes = [r["n"] for r in spark.read.parquet(f"{folder}/ids").groupBy("bucket").agg(F.sum("n_tokens").alias("n")).collect()]
    assert len(sizes) > 20 and max(sizes) < 600


def test_buckets_by_binary_search():
    import pyarrow as pa

    edges = [3, 7, 7, 7, 9]
    ids, ties = pa.array([None, 0, 3, 4, 7, 7, 7, 8, 100], pa.int64()), np.array([0, 5, 0, 2**31, 0, 2**31, 2**32 - 1, 1, 1])
    assert _buckets(ids, ties, edges).tolist() == [0, 0, 0, 1, 1, 3, 4, 4, 5]
    text = pa.array([None if x is None else f"{x:03}" for x in ids.to_pylist()])
    assert _buckets(text, ties, [f"{x:03}" for x in edges]).tolist() == [0, 0, 0, 1, 1, 3, 4, 4, 5]
    assert _buckets(ids, ties, []).tolist() == [0] * 9
