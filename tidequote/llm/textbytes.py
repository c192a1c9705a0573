"""Byte-level views of Arrow text columns, shared by the operators of this subpackage.

Texts are handled as one array of UTF-8 bytes with offsets, in chunks of bounded size, so a
task's memory depends on the chunk and on its longest single text. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
WORD_BYTES = 1 << 19  # hashing words takes some 40 bytes of memory a byte of text

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = np.random.Generator(np.random.PCG64(20240131)).integers(1, 1 << 63, 256, np.uint64)
_powers: dict[int, np.ndarray] = {}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of ``batch`` with at most ``limit`` bytes of text each, or one longer text."""
    data, offsets = text_bytes(batch.column(column))
    first, n = 0, batch.num_rows
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1]
        yield batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0]
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of every run of bytes that are not 0x20 or 0x09-0x0D."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    _, _, owner = word_spans(data, offsets)
    return np.bincount(owner, minlength=len(offsets) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every other."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(which: int, base: int, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        made = np.full(max(WORD_BYTES, 1 << (n - 1).bit_length()), base, np.uint64)
        made[0] = 1
        have = _powers[which] = np.multiply.accumulate(made)
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, from sums of powers over all of ``data``."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _power(0, _BASE, len(data)), out=sums[1:])
    own = (sums[ends] - sums[starts]) * _power(1, _BASE_INVERSE, len(data))[starts]
    return mixed(own + (ends - starts).astype(np.uint64))


def words(batch: pa.RecordBatch, limit: int = CHUNK_BYTES):
    """For each chunk: its rows, and (64-bit word hash, text number) of its lower-cased words."""
    for rows, data, offsets in chunks(batch, limit=limit):
        data = lower_ascii(data)
        starts, ends, owner = word_spans(data, offsets)
        yield rows, span_hashes(data, starts, ends), owner
