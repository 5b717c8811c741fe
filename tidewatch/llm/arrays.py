"""Texts as numpy byte arrays: slicing Arrow batches, finding words, hashing them.

Everything here works on one slice of a batch: a few megabytes of UTF-8 with the
offsets of its rows. A row is never cut, so one slice holds one very long text alone.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SLICE = 1 << 19  # what a slice's working arrays need is about 40 times as much
ODD = np.uint64(0x9E3779B97F4A7C15 ^ 0b1000)  # 5 mod 8: a full period of its powers
MASK = (1 << 64) - 1

SPACES = b" \t\n\v\f\r"

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
WORD_OF_LETTERS = np.zeros(256, bool)  # 0-9, A-Z, a-z and every byte of a non-ASCII character
WORD_OF_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
WORD_BETWEEN_SPACES = np.ones(256, bool)
WORD_BETWEEN_SPACES[list(SPACES)] = False

_BYTE_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", int(ODD)), ("down", pow(int(ODD), -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; the same bytes give the same value anywhere."""
    if not len(buf):
        return np.zeros(len(starts), np.uint64)
    up, down = _powers_to(len(buf) + 1)
    sums = np.empty(len(buf) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_CODES[buf] * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of each run of table bytes; runs end with their row."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = table[buf]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(buf))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def ranges(lo: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """lo[0], lo[0]+1, ..., one run of counts[i] numbers from each lo[i]."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.repeat(lo - ends + counts, counts) + np.arange(total)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of rows of about `limit` bytes; a null is an empty text."""
    texts = batch.column(batch.schema.get_field_index(column))
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield batch.slice(row, stop - row), whole[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def lists(rows: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    """One list per row 0..n-1 from values in order of their row."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), values)


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values from one buffer cut at offsets (in bytes)."""
    data = np.ascontiguousarray(values).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def in_workers(df: DataFrame, run: Callable, schema) -> DataFrame:
    """mapInArrow whose workers find this package also where it is not installed but on the driver's path."""
    environment = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    return df.mapInArrow(run, schema)


def without(df: DataFrame, names: Iterable[str], *needed: str) -> DataFrame:
    """df without the columns that a result of the same name, in any case, will replace."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken and c not in needed])


def add_columns(df: DataFrame, text: str, schema: str, work: Callable, limit: int = SLICE) -> DataFrame:
    """df with the columns of `schema` (DDL), computed slice by slice; they replace columns of the same name.

    work(rows, bytes, offsets) returns the new columns' Arrow arrays in order; one
    call of `work` sees whole rows only, and no row waits for another slice.
    """
    df = without(df, StructType.fromDDL(schema).names, text)
    return map_slices(df, text, f"{_ddl(df)}, {schema}" if df.columns else schema, lambda rows, buf, at: [*rows.columns, *work(rows, buf, at)], limit)


def map_slices(df: DataFrame, text: str, schema: str, work: Callable, limit: int = SLICE) -> DataFrame:
    """mapInArrow where work(rows, bytes, offsets) returns the arrays of one output batch, or None."""
    parsed = StructType.fromDDL(schema)
    names = parsed.names
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"column names repeat: {names}; select or rename before")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, at in slices(batch, text, limit):
                made = work(rows, buf, at)
                if made is not None:
                    yield pa.RecordBatch.from_arrays(made, names=names)

    return in_workers(df, run, parsed)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def keep_rows(df: DataFrame, text: str, keep: Callable, limit: int = SLICE) -> DataFrame:
    """The rows of df for which keep(rows, bytes, offsets), a boolean array, is true; columns as they are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, at in slices(batch, text, limit):
                yield rows.filter(pa.array(keep(rows, buf, at)))

    return in_workers(df, run, df.schema)
