"""Running aggregates over an order column, in parallel over its ranges.

Every range is folded to one row on the map side. Those few rows give each range what came
before it, and that carry travels to the range as one more row of the same shuffle. A
window inside the range then finishes the job: one shuffle of the data, no join, no
broadcast, and no task that sees more than its ranges.

Rows that share an order value are peers: each sees the effect of all of them, so the
result does not depend on how the input happens to be laid out.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidequote.operators.ranges import RANGE, SeqRanges

CARRIED = "_carried"
OPENING_RANGE = -2


@dataclass(frozen=True)
class Running:
    """``fold`` (max, min or sum) of ``value`` up to each row; ``before`` leaves peers out."""

    name: str
    fold: Callable[[Column], Column]
    value: Column
    before: bool = False


Reduce = Callable[[DataFrame, Sequence[str]], DataFrame]


def summarise(
    df: DataFrame,
    running: Sequence[Running],
    by: Sequence[str],
    moves: Column | None = None,
    reduce: Reduce | None = None,
) -> DataFrame:
    """One row per group, combined on the map side; rows that do not pass ``moves`` add nothing.

    ``reduce`` leaves fewer rows of a group with the same folds.
    """
    rows = df if moves is None else df.where(moves)
    if reduce is not None:
        rows = reduce(rows, by)
    return rows.groupBy(*by).agg(*[r.fold(r.value).alias(r.name) for r in running])


def _frame(window: WindowSpec, before: bool) -> WindowSpec:
    return window.rangeBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)


def _carried(name: str) -> str:
    return f"_carried_{name}"


def _as_carry(states: DataFrame, running: Sequence[Running], by: Sequence[str]) -> DataFrame:
    held = states.select(*by, *[F.col(r.name).alias(_carried(r.name)) for r in running])
    return held.withColumn(CARRIED, F.lit(True))


def _spread(states: DataFrame, first: Column, last: Column) -> DataFrame:
    """Repeat each state over the ranges ``first`` to ``last``, none if they are reversed."""
    spans = states.withColumn("_first", first).withColumn("_last", last)
    return (
        spans.where(F.col("_first") <= F.col("_last"))
        .withColumn(RANGE, F.explode(F.sequence("_first", "_last")))
        .drop("_first", "_last", "_next")
    )


def scan(
    df: DataFrame,
    running: Sequence[Running],
    ranges: SeqRanges,
    order_col: str = "seq_num",
    key_cols: Sequence[str] = (),
    opening: DataFrame | None = None,
    moves: Column | None = None,
    placed: bool = False,
    reduce: Reduce | None = None,
) -> DataFrame:
    """``df`` plus one column per running aggregate.

    ``opening`` (keys and one column per aggregate) is the state before the first row.
    ``moves`` is false only for rows on which every value is null. ``placed`` says that
    ``df`` is already partitioned by its keys.
    """
    keys = list(key_cols)
    group = [*keys, RANGE]
    rows = df.withColumn(RANGE, ranges.range_of(order_col))
    carries, hot_rows = [], None

    if ranges.is_split:
        parts = summarise(rows.where(ranges.key_is_split()), running, group, moves, reduce)
        if opening is not None:
            held = opening.where(ranges.key_is_split()).withColumn(RANGE, F.lit(OPENING_RANGE))
            parts = parts.unionByName(held)
        in_order = Window.partitionBy(*keys).orderBy(RANGE)
        upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        states = parts.select(
            *group,
            *[r.fold(r.name).over(upto).alias(r.name) for r in running],
            F.lead(RANGE).over(in_order).alias("_next"),
        )
        last, here, after = F.lit(ranges.count - 1), F.col(RANGE), F.col("_next")
        carries.append(_spread(states, here + 1, F.coalesce(after, last)))
        # Rows of a one-value range all see its closing state: they need no shuffle.
        hot = [] if any(r.before for r in running) else ranges.hot_ranges
        if hot:
            closing = _spread(states, here, F.coalesce(after - 1, last))
            is_hot = here.isin(hot)
            hot_rows = join_states(rows.where(is_hot), closing.where(is_hot), group, not keys)
            rows = rows.where(~is_hot)
    if opening is not None:
        carries.append(opening.where(~ranges.key_is_split()).withColumn(RANGE, F.lit(0)))

    rows = rows.withColumn(CARRIED, F.lit(False))
    for carry in carries:
        rows = rows.unionByName(_as_carry(carry, running, group), allowMissingColumns=True)
    if ranges.is_split:
        # One long column sorts by radix; the window's own sort, which has to put the range
        # in front, then finds the rows in order.
        rows = ranges.place(rows).sortWithinPartitions(order_col)
    elif keys and (carries or not placed):
        rows = rows.repartition(ranges.partitions, *keys)
    # Chosen after the shuffle, so that only plain columns and the few carries travel.
    inputs = [
        F.when(F.col(CARRIED), F.col(_carried(r.name))).otherwise(r.value) if carries else r.value
        for r in running
    ]
    in_range = Window.partitionBy(*(group if ranges.is_split or not keys else keys))
    in_range = in_range.orderBy(order_col)
    done = (
        rows.select(
            "*",
            *[
                r.fold(x).over(_frame(in_range, r.before)).alias(r.name)
                for r, x in zip(running, inputs, strict=True)
            ],
        )
        .where(~F.col(CARRIED))
        .select(*df.columns, *[r.name for r in running])
    )
    return done if hot_rows is None else done.unionByName(hot_rows.select(*done.columns))


def join_states(rows: DataFrame, states: DataFrame, on: list[str], one_per_range: bool) -> DataFrame:
    """Add the state columns to ``rows``, null-safe on ``on``.

    With ``one_per_range`` there are at most as many states as ranges, so they are
    broadcast; otherwise Spark chooses, and adaptive execution splits a skewed left side.
    """
    right = states.withColumnsRenamed({c: f"_right_{c}" for c in on})
    match = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return rows.join(F.broadcast(right) if one_per_range else right, match, "left").drop(
        *[f"_right_{c}" for c in on]
    )
