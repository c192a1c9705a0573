"""Word shingles of texts as 64-bit hashes, and min-max signatures of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidequote.llm.textbytes import WORD_BYTES, mixed, words

_PLACE = np.random.Generator(np.random.PCG64(811)).integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


def shingle_sets(batch: pa.RecordBatch, size: int):
    """For each chunk: its rows, the sorted distinct shingle hashes of its texts, and offsets.

    A text with fewer words than ``size`` has its whole sequence as the one shingle; one
    without words has none.
    """
    for rows, word, owner in words(batch, WORD_BYTES):
        n = rows.num_rows
        count = np.bincount(owner, minlength=n)
        first = np.cumsum(count) - count
        if len(word) >= size:
            span = len(word) - size + 1
            mix = sum(((word[k : k + span] * _PLACE[k]) for k in range(size)), np.zeros(span, np.uint64))
            mix = mixed(mix)
        else:
            mix = np.empty(0, np.uint64)
        sets = []
        for a, c in zip(first.tolist(), count.tolist(), strict=True):
            if c >= size:
                sets.append(np.unique(mix[a : a + c - size + 1]))
            elif c:
                short = (word[a : a + c] * _PLACE[size : size + c]).sum(dtype=np.uint64) + np.uint64(c)
                sets.append(mixed(np.array([short], np.uint64)))
            else:
                sets.append(np.empty(0, np.uint64))
        sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        yield rows, flat, np.concatenate([[0], np.cumsum(sizes)])


def min_max_signatures(flat: np.ndarray, offsets: np.ndarray, hashes: int) -> np.ndarray:
    """(texts, 2 * hashes) of uint32: for each hash function the least and the greatest value.

    Two sets agree in either with the probability of their similarity, so one evaluation gives
    two places of the signature. Texts without shingles get zeros.
    """
    n = len(offsets) - 1
    out = np.zeros((n, 2 * hashes), np.uint32)
    filled = np.flatnonzero(np.diff(offsets))
    if not len(filled):
        return out
    starts = offsets[:-1][filled]
    rng = np.random.Generator(np.random.PCG64(977))
    odd = rng.integers(1, 1 << 63, hashes, np.uint64) | np.uint64(1)
    plus = rng.integers(1, 1 << 63, hashes, np.uint64)
    for k in range(hashes):
        value = ((flat * odd[k] + plus[k]) >> np.uint64(32)).astype(np.uint32)
        out[filled, 2 * k] = np.minimum.reduceat(value, starts)
        out[filled, 2 * k + 1] = np.maximum.reduceat(value, starts)
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """(texts, bands) of uint64, one key for each ``rows`` places of the signature."""
    n, width = signatures.shape
    parts = signatures[:, : width // rows * rows].reshape(n, -1, rows).astype(np.uint64)
    keys = np.zeros(parts.shape[:2], np.uint64)
    for k in range(rows):
        keys = mixed(keys + (parts[:, :, k] + np.uint64(1)) * _PLACE[k])
    return mixed(keys + np.arange(parts.shape[1], dtype=np.uint64) * _PLACE[63])
