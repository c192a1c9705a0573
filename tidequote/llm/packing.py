"""Packing of token sequences by a configuration linear program (operator 2).

Only the histogram of lengths, at most ``capacity`` numbers, reaches the driver. There the linear
program over configurations (multisets of lengths that fit one sequence) is solved by
multiplicative weights: every round prices the lengths by how little of them is covered, finds the
most valuable configurations by knapsack dynamic programming, and gives them fractional weights.
The weights are rounded to whole numbers within the demand; only what rounding leaves over, again a
histogram, goes best-fit into sequences.
The plan names a rank interval of each length per configuration, so its size depends on the
number of lengths and rounds, not on the documents. Spark ranks the pieces of each length and
looks their places up.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidequote.llm import bpe
from tidequote.llm.textbytes import chunks
from tidequote.sources.landing import land

CAPACITY = 2048
ROUNDS = 25
ACCURACY = 0.03
SLACK = 0.01
WIDER = 1.0005
RELEASE = 32
_EPS = 1e-9
ROWS_PER_BUCKET = 100_000
MIN_BUCKETS = 64

Plan = list[tuple[dict[int, int], float]]


def most_values(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(most value within each room, first length that fits it); lengths fall (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    fits = np.searchsorted(-lengths, -np.arange(capacity + 1))
    least = int(lengths[-1])
    worth = np.full(capacity + 1, -np.inf)
    worth[lengths] = prices
    for room in range(least, capacity + 1):
        best[room] = max(best[room - 1], (best[room - least :: -1] + worth[least : room + 1]).max())
    return best, fits


def solve_program(demand: dict[int, int], capacity: int, rounds: int = ROUNDS) -> tuple[Plan, float]:
    """Fractional weights of configurations that cover the demand, and a bound below any such covering.

    Multiplicative weights: every round takes at most one part in ``rounds`` of the demand of a length, by
    the configurations whose value is within ``SLACK`` of the most, and then lowers the prices of what
    it covered, by a factor of at most ``1 + ACCURACY``. The most that a configuration is worth under
    any prices bounds the program from below; the best of these bounds is returned.
    """
    lengths = np.array(sorted(demand, reverse=True))
    wanted = np.array([demand[int(k)] for k in lengths], float)
    left = np.ones(len(lengths))
    rate = rounds * math.log1p(ACCURACY)
    found: dict[tuple, float] = {}
    bound, slack = 0.0, SLACK
    while (left > 0).any():
        own = np.flatnonzero(left > 0)
        size, each_most = lengths[own], wanted[own]
        sizes = size.tolist()
        prices = size * np.exp(rate * (left[own] - left.max()))
        best, fits = most_values(size, prices, capacity)
        bound = max(bound, float(prices @ wanted[own]) / best[capacity])
        quota = np.minimum(1 / rounds, left[own])  # parts of the demand
        priced = prices.copy()  # less than 0 where the quota is used up
        first = True
        choice = [-1] * (capacity + 1)  # the piece to take next by free room, found when asked for
        while True:
            config, room, value = {}, capacity, 0.0
            while (k := fits[room]) < len(size):
                i = choice[room]
                if i < 0 or priced[i] < 0 or config.get(i, 0) == each_most[i]:
                    own_prices = priced[k:].copy()
                    spent = [j - k for j, n in config.items() if j >= k and n == each_most[j]]
                    own_prices[spent] = -np.inf
                    i = k + int((best[room - size[k:]] + own_prices).argmax())
                    if own_prices[i - k] < 0:
                        break
                    if not spent:
                        choice[room] = i
                config[i] = config.get(i, 0) + 1
                value += prices[i]
                room -= sizes[i]
            if not config or (not first and value < (1 - slack) * best[capacity]):
                break
            first = False
            at, each = np.array(list(config)), np.array(list(config.values()))
            parts = each / each_most[at]
            times = float((quota[at] / parts).min())
            quota[at] -= times * parts
            left[own[at]] -= times * parts
            used = at[quota[at] <= _EPS]
            priced[used] = -np.inf
            quota[used] = 0.0
            key = tuple((sizes[i], n) for i, n in config.items())
            found[key] = found.get(key, 0.0) + times
        left[left <= _EPS] = 0.0
        slack *= WIDER  # so that rounds end
    return [(dict(k), x) for k, x in found.items()], bound


def rounded(program: Plan, demand: dict[int, int], capacity: int) -> Plan:
    """Whole numbers of the program's fullest configurations that stay within the demand, few pieces first.

    All are rounded down, then each is taken once more where its pieces are left, those of few pieces
    first. Fullest is what no configuration exceeds: those below it would add to the sequences.
    """
    left = dict(demand)
    most = max(sum(k * n for k, n in config.items()) for config, _ in program)
    full = [(config, x) for config, x in program if sum(k * n for k, n in config.items()) == most]
    full.sort(key=lambda c: (sum(c[0].values()), int(c[1]) - c[1]))
    whole = [int(x + _EPS) for _, x in full]
    for (config, _), times in zip(full, whole, strict=True):
        for k, n in config.items():
            left[k] -= n * times
    for i, (config, _) in enumerate(full):
        if all(left[k] >= n for k, n in config.items()):
            whole[i] += 1
            for k, n in config.items():
                left[k] -= n
    return [(config, times) for (config, _), times in zip(full, whole, strict=True) if times]


def best_fit(demand: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over a histogram; sequences of one content are handled together."""
    groups: dict[int, list[tuple[dict[int, int], int]]] = {}
    rooms: list[int] = []

    def put(config: dict[int, int], free: int, count: int) -> None:
        if free not in groups:
            insort(rooms, free)
            groups[free] = []
        groups[free].append((config, count))

    for length in sorted(demand, reverse=True):
        left = demand[length]
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                free = rooms[i]
                config, count = groups[free].pop()
                if not groups[free]:
                    del groups[free], rooms[i]
            else:
                free, config, count = capacity, {}, left
            each = min(free // length, left)
            filled = min(count, left // each)
            put(config | {length: each}, free - each * length, filled)
            left -= filled * each
            if config and count > filled:
                put(config, free, count - filled)
    return [x for found in groups.values() for x in found]


def pack_histogram(demand: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """Configurations with how often each is used; together they hold exactly the demand.

    The program places what rounding keeps, and best fit what rounding left over. Where that lacks
    small pieces to fill up with, one part in ``RELEASE`` of the rounded sequences, those of the most
    pieces, go to the remainder too, again while that saves sequences.
    """
    left = {k: n for k, n in demand.items() if n}
    if not left:
        return []
    need = -(-sum(k * n for k, n in left.items()) // capacity)
    placed = rounded(solve_program(left, capacity, rounds)[0], left, capacity)
    for config, times in placed:
        for k, n in config.items():
            left[k] -= n * times
    plan: Plan = []
    fewest = math.inf
    while True:
        found = placed + best_fit(left, capacity)
        if (used := sum(n for _, n in found)) >= fewest:
            return plan
        plan, fewest = found, used
        if used == need or not placed:
            return plan
        release = -(-sum(n for _, n in placed) // RELEASE)
        placed = list(placed)
        while release:
            config, times = placed.pop()
            back = min(times, release)
            release -= back
            for k, n in config.items():
                left[k] += n * back
            if times > back:
                placed.append((config, times - back))


def plan_table(plan: Plan) -> np.ndarray:
    """Rows (length, first rank, first sequence, how many a sequence, offset), sorted."""
    ranks: dict[int, int] = {}
    rows, base = [], 0
    for config, times in plan:
        offset = 0
        for length, each in sorted(config.items(), reverse=True):
            rows.append((length, ranks.get(length, 0), base, each, offset))
            ranks[length] = ranks.get(length, 0) + each * times
            offset += each * length
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and the id 0, cut to ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(path)
        for batch in batches:
            for rows, data, offsets in chunks(batch, "t"):
                ids, counts = model.token_ids(data, offsets)
                ends = np.cumsum(counts + 1)
                flat = np.zeros(int(ends[-1]), "<u4")
                flat[bpe.ragged(ends - counts - 1, counts)] = ids
                total = counts + 1
                pieces = -(-total // capacity)
                owner = np.repeat(np.arange(len(total)), pieces)
                number = bpe.ragged(np.zeros(len(total), np.int64), pieces)
                first = total - capacity * (pieces - 1)
                start = np.where(number == 0, 0, first[owner] + capacity * (number - 1))
                length = np.where(number == 0, first[owner], capacity)
                at = (ends - total)[owner] + start
                raw = memoryview(flat.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                yield pa.record_batch(
                    [
                        rows.column("i").take(pa.array(owner)),
                        pa.array(number.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    own = docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("t"))
    return own.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """Adds ``rank``, counted from 0 within each length.

    Each length is split over buckets, so that a length with much of the pieces is shared by
    many tasks; a bucket's ranks begin after those of the buckets before it.
    """
    buckets = max(MIN_BUCKETS, -(-rows // ROWS_PER_BUCKET))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "bucket").count()
    starts = starts.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    own = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.join(starts, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.row_number().over(own) - 1)
        .drop("bucket", "before")
    )


def pack(docs: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS, path: str | None = None) -> DataFrame:
    """Places every document (``doc_id``, ``text``) in sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document
    is its token ids and the id 0; only one longer than ``capacity`` is cut, its first piece
    taking the remainder. A null or empty text is the id 0 alone; a null ``doc_id`` is kept;
    repeated rows are packed one by one; an empty table gives an empty result; other columns are
    not read. Token pieces, without texts, are written once to the shared folder.
    """
    spark = docs.sparkSession
    pieces = land(token_pieces(docs, capacity, path), "pieces")
    demand = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = plan_table(pack_histogram(demand, capacity, rounds))
    shared = spark.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        wide = 1 << 44
        keys = plan[:, 0] * wide + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = plan[np.searchsorted(keys, length * wide + rank, "right") - 1]
            since = rank - row[:, 1]
            sequence = row[:, 2] + since // row[:, 3]
            offset = row[:, 4] + since % row[:, 3] * length
            own = [batch.column(c) for c in names]
            yield pa.record_batch([*own, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked(pieces, sum(demand.values())).mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
