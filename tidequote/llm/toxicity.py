"""Toxicity scores by FTRL-proximal logistic regression over hashed word features (operator 13).

A text is the set of its features: words, pairs and triples of neighbouring words, pairs with one
word between them (skip-grams), and the beginnings of words, which stand for the stem of an
inflected word. Each is hashed to one of ``DIMENSIONS`` places. Every place has its own learning
rate, which falls with the gradients it has seen, and the L1 term keeps a weight at zero until the
evidence for it is strong. The few weights that are left are broadcast, and texts are scored
whole in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidequote.llm.textbytes import chunks, mixed, span_hashes

BITS = 22
DIMENSIONS = 1 << BITS
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
SAMPLE_PER_LABEL = {1: 3000, 0: 5000}
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1.5, 0.0
THRESHOLD = 0.3
DRAW = 1 << 31

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x5F, *range(0x80, 0x100)]] = True


@dataclass
class Weights:
    """The places with a weight, in order, and the weight of every text."""

    places: np.ndarray
    values: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        table = np.zeros(DIMENSIONS, np.float32)
        table[self.places] = self.values
        return table


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of every run of letters, digits and bytes beyond ASCII."""
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets[:-1]] = True
    first = inside[1:-1] & (~inside[:-2] | edge[:-1])
    edge[offsets[1:]] = True
    last = inside[1:-1] & (~inside[2:] | edge[1:])
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def _place(kind: int, *hashes: np.ndarray) -> np.ndarray:
    value = np.full(len(hashes[0]), kind + 1, np.uint64)
    for h in hashes:
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + h)
    return (value >> np.uint64(64 - BITS)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, place) of all features of lower-cased texts, kind by kind, with repeats."""
    starts, ends, owner = _words(data, offsets)
    word = span_hashes(data, starts, ends)
    yield owner, _place(0, word)
    for kind, (n, steps) in enumerate(((1, (0, 1)), (2, (0, 1, 2)), (2, (0, 2))), 1):
        own = owner[: max(0, len(owner) - n)]
        same = own == owner[n:]
        parts = [word[k : len(word) - n + k][same] for k in steps] if len(own) else [word[:0]]
        yield own[same], _place(kind, *parts)
    for kind, size in enumerate(BEGINNINGS, 4):
        long = ends - starts > size
        yield owner[long], _place(kind, span_hashes(data, starts[long], starts[long] + size))


def _lowered(batch: pa.RecordBatch) -> pa.RecordBatch:
    at = batch.schema.get_field_index("t")
    lower = pc.utf8_lower(pc.fill_null(batch.column(at), ""))
    return batch.set_column(at, "t", lower)


def _logits(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """A feature counts once in a text, however often it is there."""
    keys = []
    for owner, place in features(data, offsets):
        known = np.flatnonzero(table[place])
        keys.append(owner[known] << BITS | place[known])
    keys = np.unique(np.concatenate(keys))
    sums = np.bincount(keys >> BITS, table[keys & (DIMENSIONS - 1)].astype(np.float64), len(offsets) - 1)
    return sums + bias


def _probability(logit):
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(rows: list[np.ndarray], toxic: np.ndarray, shift: float = 0.0, epochs: int = EPOCHS, seed: int = 13) -> Weights:
    """FTRL-proximal over texts given as sets of places.

    ``shift`` is added to every logit while learning: the log of how much likelier a toxic row was
    drawn than another one, so that scores are those of the undrawn rows. Places seen in one
    text alone say nothing about others and are left out. Without rows every score is 0; rows of
    one label alone give that label's probability.
    """
    if not len(rows):
        return Weights(np.empty(0, np.int64), np.empty(0, np.float32), -30.0)
    seen = np.zeros(DIMENSIONS, np.int32)
    for row in rows:
        seen[row] += 1
    rows = [row[seen[row] > 1] for row in rows]
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    share = (toxic.mean() * len(toxic) + 0.5) / (len(toxic) + 1)
    bias, bias_n = float(np.log(share / (1 - share)) - shift), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            own, root = z[at], np.sqrt(n[at])
            w = np.where(np.abs(own) > L1, (np.sign(own) * L1 - own) / ((BETA + root) / ALPHA + L2), 0.0)
            g = _probability(w.sum() + bias + shift) - toxic[i]
            grown = np.sqrt(n[at] + g * g)
            z[at] += g - (grown - root) / ALPHA * w
            n[at] += g * g
            bias_n += g * g
            bias -= ALPHA / (BETA + np.sqrt(bias_n)) * g
    kept = np.flatnonzero(np.abs(z) > L1)
    values = (np.sign(z[kept]) * L1 - z[kept]) / ((BETA + np.sqrt(n[kept])) / ALPHA + L2)
    return Weights(kept, values.astype(np.float32), float(bias))


def held_out() -> Column:
    """Rows from which no label is learned: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_label: dict[int, int] | None = None, epochs: int = EPOCHS) -> Weights:
    """Learns from about ``per_label`` distinct texts of each label, drawn by a hash of id and text.

    Only labels 0 and 1 of documents that are not held out count, and no id with both labels. An id
    with several texts has them all in the draw. The rows of each label are counted first, which
    gives the share to draw; so the driver gets the places of that many texts, whatever the
    corpus, and the ids that are broadcast are as few.
    """
    wanted = per_label or SAMPLE_PER_LABEL
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("y"), F.max("toxic").alias("other"))
        .where("y = other")
        .drop("other")
    )
    turn = F.xxhash64("doc_id", "t")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    known = own.select("doc_id", turn.alias("h")).distinct().join(usable, "doc_id")
    counted = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, wanted[y] / n) for y, n in counted.items()}
    if not share:
        return fit([], np.empty(0))
    bound = F.coalesce(*[F.when(F.col("y") == y, F.lit(int(s * DRAW))) for y, s in share.items()])
    drawn = known.where(F.pmod("h", F.lit(DRAW)) < bound)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(_lowered(batch), "t"):
                keys = np.unique(np.concatenate([owner << BITS | place for owner, place in features(data, offsets)]))
                cuts = np.searchsorted(keys, np.arange(1, len(offsets) - 1) << BITS)
                sets = [k.astype("<i4").tobytes() for k in np.split(keys & (DIMENSIONS - 1), cuts)]
                yield pa.record_batch(
                    [rows.column("doc_id"), rows.column("h"), rows.column("y"), pa.array(sets, pa.binary())],
                    names=["doc_id", "h", "y", "places"],
                )

    sample = own.withColumn("h", turn).join(F.broadcast(drawn), ["doc_id", "h"]).select("doc_id", "h", "y", "t")
    found = sample.mapInArrow(places, "doc_id long, h long, y int, places binary").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("h", "ascending")]).to_pydict()
    keys = list(zip(found["doc_id"], found["h"], strict=True))
    fresh = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]  # a text that repeats under its id counts once
    sets = [np.frombuffer(found["places"][i], "<i4") for i in fresh]
    shift = float(np.log(share.get(1, 1.0) / share.get(0, 1.0)))
    return fit(sets, np.array([found["y"][i] for i in fresh], np.float64), shift, epochs)


def score_toxicity(docs: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; one pass over whole texts, no shuffle.

    A null, empty or wordless text gets the score of a text without features; a null id is kept
    and not held out; repeated rows are scored one by one; an empty table gives an empty result;
    only ``doc_id`` and ``text`` are read. Memory follows chunks of 2 MB or the longest text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value.dense(), shared.value.bias
        for batch in batches:
            for rows, data, offsets in chunks(_lowered(batch), "t"):
                value = np.round(_probability(_logits(data, offsets, table, bias)), 6)
                yield pa.record_batch([rows.column("i"), pa.array(value)], names=["doc_id", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("t"))
    scored = own.mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
