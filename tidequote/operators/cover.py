"""Best live level after each message, range by range: the Python step of the full book."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Executors get these functions with the task, so they need numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def best_cover(start: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """For each t < length the greatest i with start[i] <= t < end[i], or -1.

    Two overlapping power-of-two blocks cover a span; blocks are then halved level by level.
    """
    best = np.full(length, -1, dtype=np.int64)
    rank = np.arange(len(start))
    height = np.frexp((end - start).astype(np.float64))[1] - 1
    for h in range(int(height.max(initial=0)), -1, -1):
        here = height == h
        np.maximum.at(best, start[here], rank[here])
        np.maximum.at(best, end[here] - (1 << h), rank[here])
        if h:
            half = 1 << (h - 1)
            best[half:] = np.maximum(best[half:], best[:-half])
    return best


def top_cover(start: np.ndarray, end: np.ndarray, length: int, depth: int) -> np.ndarray:
    """For each t < length the ``depth`` greatest i with start[i] <= t < end[i], falling, or -1.

    As ``best_cover``, with that many candidates a block; a span's two blocks may both offer it.
    """
    best = np.full((depth, length), -1, dtype=np.int64)
    rank = np.arange(len(start))
    height = np.frexp((end - start).astype(np.float64))[1] - 1
    for h in range(int(height.max(initial=0)), -1, -1):
        here = np.flatnonzero(height == h)
        if len(here):
            at = np.concatenate([start[here], end[here] - (1 << h)])
            ranks = np.concatenate([rank[here], rank[here]])
            order = np.lexsort((-ranks, at))
            at, ranks = at[order], ranks[order]
            new = np.concatenate([[True], (at[1:] != at[:-1]) | (ranks[1:] != ranks[:-1])])
            at, ranks = at[new], ranks[new]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            own = np.full((depth, length), -1, dtype=np.int64)
            own[place[place < depth], at[place < depth]] = ranks[place < depth]
            best = _greatest(best, own)
        if h:
            half = 1 << (h - 1)
            moved = np.full_like(best, -1)
            moved[:, half:] = best[:, :-half]
            best = _greatest(best, moved)
    return best


def _greatest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The greatest of both columns' values, each once, falling."""
    both = -np.sort(-np.concatenate([a, b]), axis=0)
    both[1:][both[1:] == both[:-1]] = -1
    return -np.sort(-both, axis=0)[: len(a)]


CHUNK_ROWS = 1 << 18


def _chunk_quotes(rows: pd.DataFrame, depth: int = 1) -> pd.DataFrame:
    """The quotes of the asking rows of a chunk, whose first rows open its levels."""
    asked = rows[rows["side"] == 0]
    at = np.unique(asked["at"].to_numpy())
    where = np.searchsorted(at, asked["at"].to_numpy())
    out = pd.DataFrame(index=asked.index)
    out["at"], out["micros"] = asked["at"], asked["micros"]
    for prefix, sign in (("bid", 1), ("ask", -1)):
        moves = rows[rows["side"] == sign]
        worth, when = moves["price"].to_numpy() * sign, moves["at"].to_numpy()
        order = np.lexsort((when, worth))
        worth, start = worth[order], np.searchsorted(at, when[order])
        size = moves["amount"].iloc[order].groupby(worth).cumsum().to_numpy()
        last = np.append(worth[1:] != worth[:-1], True)[: len(worth)]
        end = np.where(last, len(at), np.append(start[1:], 0)[: len(start)])
        live = (size > 0) & (start < end)
        price, left = np.append(worth[live] * sign, np.nan), np.append(size[live], 0)
        if depth == 1:
            best = best_cover(start[live], end[live], len(at))[where]
            out[f"{prefix}_price"], out[f"{prefix}_size"] = price[best], left[best]
            continue
        for i, best in enumerate(top_cover(start[live], end[live], len(at), depth)):
            out[f"{prefix}_price_{i + 1}"], out[f"{prefix}_size_{i + 1}"] = price[best[where]], left[best[where]]
    return out


def _closing(rows: pd.DataFrame, opening_at: int) -> pd.DataFrame:
    """The levels that a chunk leaves, as the opening rows of the next."""
    moves = rows[rows["side"] != 0]
    left = moves.groupby(["side", "price"], as_index=False)["amount"].sum()
    left = left[left["amount"] != 0]
    return left.assign(at=opening_at, micros=0)


def partition_quotes(
    group: list[str], names: list[str], opening_at: int, chunk_rows: int = CHUNK_ROWS, depth: int = 1
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Quotes of a partition whose rows are in order of (group, at), moves before asking rows.

    Rows are worked on in chunks of at most ``chunk_rows``; between the chunks of a group only
    its levels are kept, so memory depends on the depth of the book and not on the group.
    """

    def quotes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, levels = None, None
        for batch in batches:
            for first in range(0, len(batch), chunk_rows):
                part = batch.iloc[first : first + chunk_rows]
                keys = list(part[group].astype(object).where(part[group].notna(), None).itertuples(index=False, name=None))
                cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
                for a, b in zip(cuts, cuts[1:]):
                    own = part.iloc[a:b]
                    if keys[a] != of:
                        of, levels = keys[a], None
                    if levels is not None and len(levels):
                        own = pd.concat([levels[own.columns.intersection(levels.columns)], own], ignore_index=True)
                    if (own["side"] == 0).any():
                        out = _chunk_quotes(own, depth) if depth > 1 else _chunk_quotes(own)
                        for name, value in zip(names, of):
                            out.insert(0, name, value)
                        yield out[[*names, *[c for c in out.columns if c not in names]]]
                    levels = _closing(own, opening_at)

    return quotes
