"""Balanced ranges of an integer order column.

A running value over a whole feed has no partition key, and a keyed one may have a key that
holds much of the feed. Both are cut into ranges of the order column. The cut points come
from a bounded sample: they decide how even the work is, never what the result is.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RANGE = "_range"
NULL_RANGE = -1
ROWS_PER_RANGE = 1 << 20
RANGES_PER_PARTITION = 4
MAX_RANGES = 1 << 18
# With keys every split key may have a carry row in every range, so there are fewer of them.
MAX_KEYED_RANGES = 1 << 14
MAX_PARTITIONS = 1 << 15
MIN_ROWS_TO_CUT = 1024
SAMPLES_PER_RANGE = 32
# Keys are split that hold more than one in so many of the rows and more than one range's
# worth; that is also about how many keys the plan may have to name.
MAX_HOT_KEYS = 1 << 16
HOT_KEY_SAMPLE = 16 * MAX_HOT_KEYS
MAX_COMPARES = 4
LONG_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class SeqRanges:
    """Range ``i`` holds ``cuts[i-1] <= seq < cuts[i]``; null order values have their own."""

    cuts: tuple[int, ...] = ()
    hot_seqs: tuple[int, ...] = ()
    hot_nulls: bool = False
    key_cols: tuple[str, ...] = ()
    hot_keys: tuple[int, ...] = ()
    partitions: int = 1

    @property
    def is_split(self) -> bool:
        return bool(self.cuts) and (not self.key_cols or bool(self.hot_keys))

    @property
    def count(self) -> int:
        return len(self.cuts) + 1

    @property
    def hot_ranges(self) -> list[int]:
        """Ranges filled by one order value."""
        if not self.is_split:
            return []
        found = [bisect_right(self.cuts, v) for v in self.hot_seqs]
        return found + [NULL_RANGE] if self.hot_nulls else found

    def key_is_split(self) -> Column:
        if not self.is_split:
            return F.lit(False)
        if not self.key_cols:
            return F.lit(True)
        hashes = ", ".join(map(str, self.hot_keys))
        return F.expr(f"{_key_hash(self.key_cols)} in ({hashes})")

    def range_of(self, order_col: str) -> Column:
        """Index of the row's range: how many cut points are at or below its order value.

        A directory of equal-width cells leads to the few cut points that need comparing.
        """
        if not self.is_split:
            return F.lit(0)
        seq, cuts = F.col(order_col), _literal(self.cuts, "bigint")
        low, high = self.cuts[0], self.cuts[-1]
        shift = max(0, (high - low).bit_length() - self.count.bit_length())
        if high - low <= LONG_MAX:
            starts = range(low, high + 1, 1 << shift)
            skipped = [bisect_left(self.cuts, s) for s in starts]
            cell = F.shiftright(F.greatest(F.least(seq, F.lit(high)), F.lit(low)) - low, shift)
            first = F.get(_literal(skipped, "int"), cell.cast("int"))
            longest = max(b - a for a, b in pairwise([*skipped, len(self.cuts)]))
        else:
            first, longest = F.lit(0), len(self.cuts)
        if longest <= MAX_COMPARES:
            at = first
            for i in range(longest):
                at = at + F.when(F.get(cuts, first + i) <= seq, 1).otherwise(0)
        else:
            steps = [1 << i for i in reversed(range(longest.bit_length()))]
            at = F.aggregate(
                F.array(*[F.lit(s) for s in steps]),
                first,
                lambda at, step: F.when(F.get(cuts, at + step - 1) <= seq, at + step).otherwise(at),
            )
        at = F.when(seq.isNull(), F.lit(NULL_RANGE)).otherwise(at)
        return F.when(self.key_is_split(), at).otherwise(F.lit(0)) if self.key_cols else at

    def place(self, df: DataFrame) -> DataFrame:
        """Shuffle rows that carry ``RANGE`` so that each (keys, range) is in one partition."""
        if self.key_cols:
            return df.repartition(self.partitions, *self.key_cols, RANGE)
        return df.repartitionById(self.partitions, RANGE)


def _literal(values: Sequence[float], kind: str) -> Column:
    """A constant array; one string literal instead of one expression per element."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def _key_hash(key_cols: Sequence[str]) -> str:
    return f"xxhash64({', '.join(f'`{k}`' for k in key_cols)})"


def _hot_keys(df: DataFrame, key_cols: Sequence[str], rows: int, rows_per_range: int) -> tuple:
    """Hashes of keys with more than a range's worth of rows; a false hit is harmless."""
    share = min(1.0, HOT_KEY_SAMPLE / rows)
    seen = max(rows_per_range, rows / MAX_HOT_KEYS) * share
    hot = (
        df.select(F.expr(_key_hash(key_cols)).alias("key"))
        .sample(share, seed=7)
        .groupBy("key")
        .count()
        .where(F.col("count") > seen)
    )
    return tuple(sorted(r["key"] for r in hot.collect()))


def _cuts(df: DataFrame, order_col: str, ranges: int, rows: int) -> tuple[list[int], list[int], bool]:
    """(cut points, hot values, whether nulls alone would fill a range), from a sample.

    Sampled values are counted as exact longs, so a frequent value travels as one row and none
    passes through a double. The running count over the ordered sample, at most ``MAX_RANGES``
    times ``SAMPLES_PER_RANGE`` pairs of longs whatever the input's partitions, tells the rest: a
    value at which it passes a multiple of a range's worth is a cut point; one that passes
    several is hot.
    """
    share = min(1.0, SAMPLES_PER_RANGE * ranges / rows)
    sample = df.select(F.col(order_col).cast("long").alias("seq")).sample(share, seed=7)
    counted = sample.groupBy("seq").agg(F.count("*").alias("n"))
    numbered = F.when(F.col("seq").isNotNull(), F.col("n")).otherwise(0)
    upto, everything = Window.orderBy(F.col("seq").asc_nulls_first()), Window.partitionBy()

    def passed(count: Column) -> Column:
        return F.least(F.floor(count * ranges / F.greatest(F.col("total"), F.lit(1))), F.lit(ranges - 1))

    crossed = (
        counted.withColumn("numbered", numbered)
        .select(
            "seq",
            "n",
            "numbered",
            F.sum("numbered").over(upto).alias("upto"),
            F.sum("numbered").over(everything).alias("total"),
        )
        .withColumn("crossed", passed(F.col("upto")) - passed(F.col("upto") - F.col("numbered")))
        .where("crossed > 0 or seq is null")
        .collect()
    )
    values = sorted((r["seq"], r["crossed"]) for r in crossed if r["seq"] is not None)
    nulls = [(r["n"], r["total"]) for r in crossed if r["seq"] is None]
    hot_nulls = any(n * ranges > n + total for n, total in nulls)
    return [v for v, _ in values], [v for v, k in values if k > 1], hot_nulls


def plan_ranges(
    df: DataFrame,
    order_col: str = "seq_num",
    key_cols: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
    min_rows: int = MIN_ROWS_TO_CUT,
) -> SeqRanges:
    """Choose ranges for ``df``: a count, then at most two sampled one-column passes.

    The caps on ranges and keys bound the plan, which names them. Beyond them a range holds more
    than ``rows_per_range`` rows; windows spill then, and the book works in chunks.

    Small tables are cut into a range per ``min_rows``, up to one per shuffle partition.

    Without keys the whole table is cut. With keys only those holding more than
    ``rows_per_range`` rows are, so that ordinary keys need one plain keyed window.
    """
    spark = df.sparkSession
    rows = df.count()
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    floor = min(shuffle, rows // min_rows + 1)
    keys = tuple(key_cols)
    ranges = max(floor, math.ceil(rows / rows_per_range))
    partitions = min(
        MAX_PARTITIONS, max(min(shuffle, ranges), math.ceil(ranges / RANGES_PER_PARTITION))
    )
    ranges = min(ranges, MAX_KEYED_RANGES if keys else MAX_RANGES)
    if not keys:
        # The same number of ranges for every partition.
        ranges = math.ceil(ranges / partitions) * partitions
    hot_keys = ()
    if keys and rows > rows_per_range:
        hot_keys = _hot_keys(df, keys, rows, rows_per_range)
    if ranges == 1 or (keys and not hot_keys):
        return SeqRanges(key_cols=keys, partitions=partitions)
    found, hot_seqs, hot_nulls = _cuts(df, order_col, ranges, rows)
    cuts = sorted(set(found) | {v + 1 for v in hot_seqs if v < LONG_MAX})
    return SeqRanges(
        cuts=tuple(cuts),
        hot_seqs=tuple(v for v in hot_seqs if v < LONG_MAX),
        hot_nulls=hot_nulls,
        key_cols=keys,
        hot_keys=hot_keys,
        partitions=partitions,
    )
