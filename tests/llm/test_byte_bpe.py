from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from tidewatch.llm.byte_bpe import _decodes_to, decode, encode, encode_checked, encode_text, encoding, safe_pieces

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def bpe():
    return encoding(RANKS, PATTERN)


def odd_texts():
    rng = random.Random(4)
    parts = ["a", "be", "é", "ж", "'s", "'", " ", "  ", "\n", "\t", "12", "½", "!", "--", "漢字", "\x1c", "🙂", "<|endoftext|>", "　", "\x85", "x1", "\r\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(400)]


def test_pieces_have_the_ids_of_the_text(bpe):
    for text in odd_texts():
        for size in (1, 3, 8):
            pieces = list(safe_pieces(text, size))
            assert "".join(pieces) == text
            assert sum((bpe.encode_ordinary(p) for p in pieces), []) == bpe.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 200_000, "word " * 50_000, "a1" * 60_000, "x" + " " * 90_000 + "y", " " * 70_000, "漢" * 70_000])
def test_long_texts(bpe, text):
    assert encode_text(bpe, text).tolist() == bpe.encode_ordinary(text)


def test_a_run_of_spaces_the_library_cannot_match(bpe):
    text = "a" + " " * 1_500_000 + "b"
    ids = encode_text(bpe, text)
    assert bpe.decode_bytes(ids.tolist()) == text.encode()


def test_round_trip(docs, bpe):
    texts = [*odd_texts(), None, "", "same", "same", "long " * 40_000]
    out = decode(encode(docs(texts), RANKS, PATTERN), RANKS, PATTERN)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score_note", "n_tokens", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["n_tokens"] and r["decoded"] == text.encode()
        assert ids.tolist() == bpe.encode_ordinary(text)


def test_empty_table(docs):
    assert decode(encode(docs([]), RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_one_worker_encodes_and_checks(docs, bpe):
    texts = [*odd_texts()[:100], None, "", "same", "same", "long é " * 40_000]
    out = encode_checked(docs(texts), RANKS, PATTERN)
    plain = {r["doc_id"]: r for r in encode(docs(texts), RANKS, PATTERN).collect()}
    for r in out.collect():
        assert r["round_trip"] and (r["n_tokens"], r["ids"]) == (plain[r["doc_id"]]["n_tokens"], plain[r["doc_id"]]["ids"])
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_a_wrong_id_is_noticed(bpe):
    text = "some words to encode " * 9000
    ids = encode_text(bpe, text)
    assert _decodes_to(bpe, ids, text.encode())
    for k in (0, len(ids) // 2, len(ids) - 1):
        other = ids.copy()
        other[k] += 1
        assert not _decodes_to(bpe, other, text.encode())
    assert not _decodes_to(bpe, ids[:-1], text.encode()) and not _decodes_to(bpe, ids, text.encode()[:-1])
