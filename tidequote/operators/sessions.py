"""Level-1 quotes per session: messages with no pause longer than a gap between them.

Messages are first folded into panes as wide as the gap. Two messages of one pane are always in one
session, so only panes have to be put together, and there are few of them however busy the feed.
Panes are merged over ranges of time: a range hands on how far the messages before it reach and where the
session that is open began, so a feed without keys, or one busy key, is not one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidequote.functions.messages import quote_messages
from tidequote.operators.ranges import ROWS_PER_RANGE, SeqRanges, plan_ranges
from tidequote.operators.scan import Running, scan
from tidequote.operators.windows import merged_totals, micros, pane_totals, shape_windows
from tidequote.sources.landing import land

PANE, FIRST, LAST, SESSION = "pane", "first_at", "last_at", "session"


def session_panes(l3: DataFrame, gap: str, key_cols: Sequence[str] = ()) -> DataFrame:
    """(keys, pane, first_at, last_at, bid, ask, n): messages folded by panes of one gap."""
    width = micros(gap)
    messages = quote_messages(l3, key_cols).where(F.col("time").isNotNull())
    # whole numbers, as a quotient of doubles would be off for times far from the epoch
    messages = messages.withColumn("_at", F.unix_micros("time")).withColumn(PANE, F.expr(f"(_at - pmod(_at, {width}L)) div {width}L"))
    by = [*key_cols, PANE]
    return messages.groupBy(*by).agg(
        F.min("_at").alias(FIRST), F.max("_at").alias(LAST), *pane_totals(), F.count("*").alias("n")
    )


def with_sessions(
    panes: DataFrame, gap: str, key_cols: Sequence[str] = (), ranges: SeqRanges | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``panes`` with ``session``, the time at which the session of each began."""
    keys = list(key_cols)
    ranges = ranges or plan_ranges(panes, FIRST, keys, rows_per_range)
    reach = Running("_reach", F.max, F.col(LAST), before=True)
    seen = scan(panes, [reach], ranges, FIRST, keys)
    begins = F.col("_reach").isNull() | (F.col(FIRST) - F.col("_reach") > micros(gap))
    start = Running(SESSION, F.max, F.when(begins, F.col(FIRST)))
    return scan(seen, [start], ranges, FIRST, keys).drop("_reach")


def sessions_of(panes: DataFrame, gap: str, key_cols: Sequence[str] = ()) -> DataFrame:
    """(keys, session, last_at, window, folds, n) from panes with sessions."""
    end = F.timestamp_micros(F.col(LAST) + micros(gap))
    window = F.struct(F.timestamp_micros(SESSION).alias("start"), end.alias("end"))
    merged = panes.groupBy(*key_cols, SESSION).agg(F.max(LAST).alias(LAST), *merged_totals())
    return merged.withColumn("window", window)


def l1_sessions(
    l3: DataFrame, gap: str, key_cols: Sequence[str] = (), both_sides: bool = False, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Best bid, best ask, their sizes and the message count of each session.

    A session ends ``gap`` after its last message; a message just then still belongs to it. Rows
    without a time are in no session.
    """
    panes = land(session_panes(l3, gap, key_cols), "session-panes")
    merged = with_sessions(panes, gap, key_cols, rows_per_range=rows_per_range)
    return shape_windows(sessions_of(merged, gap, key_cols), key_cols, both_sides)
