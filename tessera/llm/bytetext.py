"""Whole texts of an Arrow batch as flat byte arrays: word borders, word hashes, window hashes, all by NumPy.

Every class of word separators used here is ASCII, and no byte of a multi-byte UTF-8 character is; so words can be
found on bytes. Hashes are 64-bit: polynomials over a fixed random table, finished by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Batches are cut so that flat arrays stay at this many text bytes, or one text.
SLICE_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
# after lower-casing: digits, letters and every byte of a character beyond ASCII
ALNUM = np.ones(256, bool)
ALNUM[:0x80] = False
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def small_batches(spark) -> None:
    """Whole texts are long rows: hand them to Python in batches of a few megabytes, so that workers stay small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)``; tables of usual length are made once."""
    if len(_POWERS.get(int(base), ())) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        np.cumprod(out, dtype=np.uint64, out=out)
        if n > 2 * SLICE_BYTES:
            return out[:n]
        _POWERS[int(base)] = out
    return _POWERS[int(base)][:n]


@dataclass
class Texts:
    """``data[start[i]:end[i]]`` are the bytes of text ``i``; a null text is empty and ``null[i]`` is set."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    null: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def texts(column: pa.Array) -> Texts:
    null = np.asarray(column.is_null())
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if column.buffers()[2] else np.zeros(0, np.uint8)
    return Texts(data, offsets[:-1] - offsets[0], offsets[1:] - offsets[0], null)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``limit`` text bytes (a longer text is a batch of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        part = (np.cumsum(lengths) - lengths) // limit
        borders = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *borders], [*borders, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def word_borders(inside: np.ndarray, t: Texts, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words before each text and in all) of the maximal runs of bytes with ``inside`` set, in each text.

    ``cuts`` are further places inside runs where one word ends and the next begins.
    """
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    more = t.start[(t.start > 0) & (t.start < len(inside))]
    if cuts is not None:
        more = np.concatenate([more, cuts])
    if len(more):
        more = more[inside[more] & inside[more - 1]]
        opens[more] = True
        closes[more - 1] = True
    first = np.flatnonzero(opens)
    return first, np.flatnonzero(closes) + 1, np.searchsorted(first, np.append(t.start, len(inside)))


def per_text(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Sum of the words' ``values`` in each text."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "iub" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[before[1:]] - total[before[:-1]]


def string_column(kept: np.ndarray, lengths: np.ndarray) -> pa.StringArray:
    """Words that lie end to end in ``kept`` as an Arrow column."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(kept))


class Prefix:
    """Hashes of any stretch of bytes in O(1)."""

    def __init__(self, data: np.ndarray):
        self.power = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * self.power[:-1], dtype=np.uint64, out=self.sums[1:])
        self.inverse = powers(len(data) + 1, _INVERSE)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64))


def tuple_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = mix(out) + words[k : len(words) - n + 1 + k]
    return mix(out)
