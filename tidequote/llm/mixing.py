"""Mixing sources to target weights by the cube method (operator 7).

A source's target over its size says how often each of its documents is taken: the whole part
by all, the fraction as an inclusion probability. The flight phase moves the probabilities of
three documents at a time along the null space of the constraints (documents, tokens) until one
of them is 0 or 1. It runs in blocks of a source; a block leaves at most two documents undecided,
and those fly on in blocks of the next level, until one block of the source is left, whatever the size of
the other sources. There the last two are landed: without the document constraint, then by rounding, and the tokens that rounding
adds or takes are made good by exchanging documents taken for documents left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidequote.llm.columns import free_names
from tidequote.llm.textbytes import chunks, word_counts
from tidequote.sources.landing import land

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK_ROWS = 1000
_EPS = 1e-9


def with_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of each text; null texts have none."""

    def count(batches):
        for batch in batches:
            for rows, data, offsets in chunks(batch, "t"):
                size = pa.array(word_counts(data, offsets).astype(np.int64))
                yield pa.record_batch([rows.column("i"), rows.column("s"), size], names=["doc_id", "source", "size"])

    own = docs.select(F.col("doc_id").cast("long").alias("i"), F.col("source").cast("string").alias("s"), F.col("text").alias("t"))
    return own.mapInArrow(count, "doc_id long, source string, size long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target), one row per source.

    Sharing again what is cut off by weight, until no target is above its bound, ends at
    ``min(bound, level * weight)`` with one common level; it is found from running sums over the
    sources in the order in which they reach their bounds. Both windows run over one row per
    source, not over documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int"))
    own = totals.withColumn("weight", weight).withColumn("bound", F.lit(most) * F.col("source_size"))
    by_bound = W.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_bound.rowsBetween(W.unboundedPreceding, -1)
    since = by_bound.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    level = (
        F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    ) / F.sum("weight").over(since)
    own = own.withColumn("level", level)
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("bound"), F.col("level"))
    level = F.max(open_level).over(everything)  # levels only fall after the first open one
    target = F.when(level.isNull(), F.col("bound")).otherwise(F.least("bound", level * F.col("weight")))
    return own.select("source", "source_size", target.alias("target"))


def fly(chance: np.ndarray, size: np.ndarray, rng: np.random.Generator, last: bool) -> np.ndarray:
    """Chances moved to 0 or 1 while their sum and their sum weighted by size stay.

    At most two stay between 0 and 1; with ``last`` none does.
    """
    out = chance.astype(float).copy()
    z = size.astype(float)
    waiting = [i for i in range(len(out)) if _EPS < out[i] < 1 - _EPS]
    out[out <= _EPS] = 0.0
    out[out >= 1 - _EPS] = 1.0
    draws = rng.random(len(waiting) + 4).tolist()
    place, p, z = 0, out.tolist(), z.tolist()
    held = waiting[:2]
    for i in waiting[2:]:
        held.append(i)
        while len(held) == 3:
            a, b, c = held
            move = (z[b] - z[c], z[c] - z[a], z[a] - z[b])
            if not any(move):
                move = (1.0, -1.0, 0.0)
            _step(p, held, move, draws[place])
            place += 1
            held = [k for k in held if 0.0 < p[k] < 1.0]
    if last:
        if len(held) == 2:  # tokens only
            a, b = held
            move = (z[b], -z[a]) if z[a] or z[b] else (1.0, -1.0)
            _step(p, held, move, draws[place])
            held = [k for k in held if 0.0 < p[k] < 1.0]
        for k in held:
            p[k] = 1.0 if p[k] >= 0.5 else 0.0
        _exchange(p, waiting, z, sum(z[k] * (p[k] - chance[k]) for k in waiting))
    return np.array(p, float)


def _exchange(p: list[float], units: list[int], z: list[float], excess: float) -> None:
    """Swaps a taken and a left-out document while that brings ``excess`` nearer to 0.

    Either side of a swap may be empty; of equal swaps the first is made.
    """
    while True:
        taken = [k for k in units if p[k] == 1]
        left = sorted((k for k in units if p[k] == 0), key=lambda k: z[k])
        own = np.array([*(z[k] for k in taken), 0.0])
        sizes = np.array([0.0, *(z[k] for k in left)])
        at = np.searchsorted(sizes, own - excess)
        best, pair = abs(excess) - _EPS, None
        for shift in (-1, 0):
            j = np.clip(at + shift, 0, len(left))
            off = np.abs(excess + sizes[j] - own)
            i = int(off.argmin())
            if off[i] < best:
                best, pair = off[i], (i, int(j[i]))
        if pair is None:
            return
        out, into = pair
        excess += sizes[into] - own[out]
        if out < len(taken):
            p[taken[out]] = 0.0
        if into:
            p[left[into - 1]] = 1.0


def _step(p: list[float], at: list[int], move: tuple[float, ...], draw: float) -> None:
    """Moves as far as the cube lets, forward or back, the expectation staying as it is."""
    ahead = min((((1 - p[k]) if m > 0 else p[k]) / abs(m) for k, m in zip(at, move, strict=True) if m), default=0)
    back = min(((p[k] if m > 0 else (1 - p[k])) / abs(m) for k, m in zip(at, move, strict=True) if m), default=0)
    way = ahead if draw * (ahead + back) < back else -back
    for k, m in zip(at, move, strict=True):
        x = p[k] + way * m
        p[k] = 0.0 if x <= _EPS else 1.0 if x >= 1 - _EPS else x


def _fly_level(units: DataFrame, level: int, counts: DataFrame) -> DataFrame:
    """One level of flight; a source of at most ``BLOCK_ROWS`` (``counts``) is one block, and lands."""

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["turn", "doc_id", "size"], kind="stable")
        seed = [level, int(key[1]), int(rows["turn"].iloc[0]) & (2**63 - 1)]
        last = bool(rows["blocks"].iloc[0] == 1)
        rows["chance"] = fly(rows["chance"].to_numpy(), rows["size"].to_numpy(), np.random.default_rng(seed), last)
        return rows[names]

    names = units.columns
    blocks = counts.select(F.col("source").alias("of_source"), F.ceil(F.col("count") / BLOCK_ROWS).alias("blocks"))
    own = units.join(blocks, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    block = F.pmod(F.xxhash64("turn", F.lit(level)), F.col("blocks"))
    return own.withColumn("block", block).groupBy("source", "block").applyInPandas(one, units.schema)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies and taken (= size * copies).

    Needs ``doc_id``, ``source`` and ``text``; other columns are not read. A null text has size
    0; null is a source of its own, after the others; repeated rows are sampled one by one; an
    empty table gives an empty result. All draws depend on ids and levels only, so reruns agree.
    """
    sizes = land(with_sizes(docs), "sizes")
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "of_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = sizes.join(targets, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    units = units.withColumn("whole", F.floor(ratio)).withColumn("chance", ratio - F.col("whole"))
    units = units.withColumn("turn", F.xxhash64("doc_id", "size"))
    done: list[DataFrame] = []
    level = 0
    while True:
        counts = (sizes if level == 0 else units).groupBy("source").count()
        largest = counts.agg(F.max("count")).first()[0] or 0
        flown = _fly_level(units, level, counts)
        if largest <= BLOCK_ROWS:
            done.append(flown)
            break
        flown = land(flown, "flight")
        undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(flown.where(~undecided))
        units = flown.where(undecided)
        level += 1
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    copies = F.col("whole") + F.col("chance").cast("long")
    return every.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
    )


def taken(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns as they are.

    Equal rows are interchangeable: together they appear as often as all of them are taken.
    """
    unit, copies, turn, time = free_names(docs, "unit", "copies", "turn", "time")
    own = docs.withColumn(unit, F.xxhash64("doc_id", "source", "text"))
    chosen = mix(own.select(F.col(unit).alias("doc_id"), "source", "text"), weights, share, most)
    chosen = chosen.groupBy(F.col("doc_id").alias(unit)).agg(F.sum("copies").alias(copies)).where(F.col(copies) > 0)
    first = F.row_number().over(W.partitionBy(unit).orderBy(F.lit(0)))
    rows = own.join(chosen, unit).withColumn(turn, first).where(F.col(turn) == 1)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(time)
    return rows.select(*docs.columns, times).drop(time)
