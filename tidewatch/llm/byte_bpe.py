"""Byte-level BPE with the tiktoken library and a local rank file.

A long text is cut where the split pattern always ends a match, so that the ids of
the pieces are the ids of the text: between a non-space and a space, and between an
ASCII letter and a digit, as no match of the pattern holds either. Decoding joins
the raw bytes of the tokens; a token may hold part of a character.

Empty and null texts have no ids. Repeated rows are encoded one by one. Result columns replace columns of the same name. Rows of an
empty table give an empty table with the same columns.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructType

from .arrays import add_columns, binaries, in_workers, without

PIECE = 1 << 16
LONG_SPACE = 1 << 12
# fixed value: the white space of the split pattern's \s
SPACE_CLASS = "[" + "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]"
_SAFE = regex.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_LONG_SPACE = regex.compile(SPACE_CLASS + "{" + str(LONG_SPACE) + ",}")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """One encoding per worker process."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Pieces whose ids, joined, are the ids of the text: as a rule up to `size` characters each."""
    at = 0
    while len(text) - at > size:
        cut = _last_safe(text, at + 1, at + size)
        if cut is None:
            later = _SAFE.search(text, at + size)
            cut = later.start() if later else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def _last_safe(text: str, lo: int, hi: int) -> int | None:
    for p in range(hi, lo - 1, -1):
        a, b = text[p - 1], text[p]
        if (b in " \t\n\r" and not a.isspace()) or (a.isascii() and b.isascii() and a.isalnum() and b.isalnum() and a.isdigit() != b.isdigit()):
            return p
    return None


def encode_text(bpe: tiktoken.Encoding, text: str) -> np.ndarray:
    """ids of one text, each match of the pattern encoded separately, no special tokens."""
    if len(text) <= PIECE:
        return _ids(bpe, text)
    parts = []
    at = 0
    # a run of spaces is one match but for its last character, when something follows;
    # very long runs are given to the merges directly, for the pattern matcher's stack is small
    for run in _LONG_SPACE.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        parts += [_ids(bpe, piece) for piece in safe_pieces(text[at : run.start()])]
        parts.append(np.array(bpe._encode_single_piece(text[run.start() : stop]), np.uint32))
        at = stop
    parts += [_ids(bpe, piece) for piece in safe_pieces(text[at:])]
    return np.concatenate(parts)


def _ids(bpe: tiktoken.Encoding, text: str) -> np.ndarray:
    return np.array(bpe.encode_ordinary(text), np.uint32)


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds n_tokens (long) and ids (binary: little-endian unsigned 32-bit integers)."""

    def work(rows, buf, at):
        bpe = encoding(rank_file, pattern)
        column = rows.column(rows.schema.get_field_index(text))
        ids = [encode_text(bpe, t.as_py() or "") for t in column]
        counts = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids).astype("<u4")
        return [pa.array(counts), binaries(flat, np.append(0, np.cumsum(counts * 4)))]

    return add_columns(docs, text, "n_tokens bigint, ids binary", work)


def encode_checked(docs: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """encode() that also decodes, in the same worker: adds round_trip, whether the ids' bytes are the text's.

    Texts and ids pass through one worker a task, and no decoded text leaves it.
    """

    def work(rows, buf, at):
        bpe = encoding(rank_file, pattern)
        column = rows.column(rows.schema.get_field_index(text))
        counts, same, parts = [], [], []
        for t in column:
            t = t.as_py() or ""
            ids = encode_text(bpe, t)
            counts.append(len(ids))
            same.append(_decodes_to(bpe, ids, t.encode()))
            parts.append(ids)
        counts = np.array(counts, np.int64)
        flat = np.concatenate(parts).astype("<u4")
        return [pa.array(counts), binaries(flat, np.append(0, np.cumsum(counts * 4))), pa.array(same)]

    return add_columns(docs, text, "n_tokens bigint, ids binary, round_trip boolean", work)


def _decodes_to(bpe: tiktoken.Encoding, ids: np.ndarray, raw: bytes) -> bool:
    """Whether the joined bytes of the tokens are `raw`, compared run by run."""
    at = 0
    for lo in range(0, len(ids), PIECE):
        part = bpe.decode_bytes(ids[lo : lo + PIECE].tolist())
        if raw[at : at + len(part)] != part:
            return False
        at += len(part)
    return at == len(raw)


def decode(encoded: DataFrame, rank_file: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Adds decoded (binary): the joined raw bytes of the tokens; null ids decode to nothing. A column of that name is replaced."""
    encoded = without(encoded, ["decoded"], ids)
    schema = StructType([*encoded.schema.fields]).add("decoded", BinaryType())

    def run(batches):
        for batch in batches:
            bpe = encoding(rank_file, pattern)
            column = batch.column(batch.schema.get_field_index(ids))
            raw = [bpe.decode_bytes(np.frombuffer(x.as_buffer(), "<u4").tolist()) if x.is_valid else b"" for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=schema.names)

    return in_workers(encoded, run, schema)
