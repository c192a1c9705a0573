"""As-of lookup: for every row of one feed the latest row of another at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidequote.operators.ranges import ROWS_PER_RANGE, SeqRanges, plan_ranges
from tidequote.operators.scan import Running, scan
from tidequote.operators.windows import micros

ON, IS_LEFT, LEFT, RIGHT, FOUND = "_on", "_is_left", "_left", "_right", "_found"


def _order_value(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(column, "UTC"))
    return F.col(column).cast("long")


def both_feeds(left: DataFrame, right: DataFrame, on: str, by: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """The rows of both feeds in one narrow table: keys, order value, and a struct of either."""
    known = _order_value(right, on).isNotNull()
    for k in by:
        known = known & F.col(k).isNotNull()
    own = [c for c in left.columns if c not in by]
    other = [c for c in right.columns if c not in by and c not in ties]
    lefts = left.select(
        *by, _order_value(left, on).alias(ON), F.lit(True).alias(IS_LEFT), F.struct(*own).alias(LEFT)
    )
    # the struct begins with what orders the rows, so its maximum is the latest row
    rights = right.where(known).select(
        *by,
        _order_value(right, on).alias(ON),
        F.lit(False).alias(IS_LEFT),
        F.struct(_order_value(right, on).alias(ON), *ties, *other).alias(RIGHT),
    )
    return lefts.unionByName(rights, allowMissingColumns=True)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str = "time",
    by: Sequence[str] = (),
    ties: Sequence[str] = ("seq_num",),
    prefix: str = "quote_",
    tolerance: str | int | None = None,
    strict: bool = False,
    ranges: SeqRanges | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Every row of ``left`` with the columns of the last row of ``right`` up to its ``on``.

    ``by`` are keys that both feeds share, ``ties`` order rows of ``right`` with one ``on`` (the greatest
    counts), ``strict`` leaves out rows of just the same ``on``. A row found more than
    ``tolerance`` back (a duration, or a number where ``on`` is one) does not count. Columns of
    ``right`` but for the keys get ``prefix`` and are null where nothing is found; so are those of
    rows whose ``on`` or key is null, as null equals nothing.

    Both feeds are merged by ranges of ``on``: the last row of the other feed is carried from range to
    range, and only keys with more than a range's rows are cut. No row meets another but
    through that running maximum, so a busy key, or a feed without keys, is spread over tasks.
    The columns of ``right`` must have an order; both feeds are read several times.
    """
    rows = both_feeds(left, right, on, by, ties)
    ranges = ranges or plan_ranges(rows, ON, by, rows_per_range)
    last = Running(FOUND, F.max, F.col(RIGHT), before=strict)
    done = scan(rows, [last], ranges, ON, by, moves=~F.col(IS_LEFT)).where(IS_LEFT)
    found = F.col(FOUND).isNotNull()
    if tolerance is not None:
        most = micros(tolerance) if isinstance(tolerance, str) else tolerance
        found = found & (F.col(ON) - F.col(f"{FOUND}.{ON}") <= most)
    others = [c for c in right.columns if c not in by]
    return done.select(
        *by,
        *[F.col(f"{LEFT}.{c}").alias(c) for c in left.columns if c not in by],
        *[F.when(found, F.col(f"{FOUND}.{c}")).alias(f"{prefix}{c}") for c in others],
    )
