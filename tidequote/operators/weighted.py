"""Time-weighted quotes per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidequote.operators.ranges import ROWS_PER_RANGE, SeqRanges, plan_ranges
from tidequote.operators.scan import Running, scan
from tidequote.operators.windows import micros
from tidequote.sources.landing import land

AT, BACK, UNTIL = "_at", "_back", "_until"


def quote_lifetimes(
    l1: DataFrame,
    key_cols: Sequence[str] = (),
    until: int | None = None,
    ranges: SeqRanges | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(keys, _at, _until, bid_price, ask_price): each quote with the microseconds from which and to which it holds.

    Of the quotes of one time the last by ``seq_num`` holds. The last quote of a key holds up to
    ``until``, by default the latest time of all quotes. The next time of a quote is a running
    minimum over the feed read backwards, by ranges.
    """
    keys = list(key_cols)
    timed = l1.where(F.col("time").isNotNull()).withColumn(AT, F.unix_micros("time"))
    last = F.max(F.struct("seq_num", "bid_price", "ask_price")).alias("q")
    quotes = timed.groupBy(*keys, AT).agg(last).select(*keys, AT, "q.bid_price", "q.ask_price", (-F.col(AT)).alias(BACK))
    quotes = land(quotes, "timed-quotes")
    if until is None:
        until = quotes.agg(F.max(AT).alias("latest")).first()["latest"]
    ranges = ranges or plan_ranges(quotes, BACK, keys, rows_per_range)
    done = scan(quotes, [Running(UNTIL, F.min, F.col(AT), before=True)], ranges, BACK, keys)
    end = F.coalesce(F.col(UNTIL), F.lit(until).cast("long"))
    return done.withColumn(UNTIL, end).drop(BACK).where(F.col(UNTIL) > F.col(AT))


def time_weighted(
    l1: DataFrame,
    width: str,
    key_cols: Sequence[str] = (),
    until: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Bid, ask and spread of each window, averaged over the time for which quotes held.

    A quote counts in every window that its lifetime touches, with the part that lies in it, so windows
    without messages carry the quote of before. ``quoted_micros`` is the time with a quote; windows
    before the first quote are not there. ``l1`` holds quotes as ``l3_to_l1`` gives them; rows without a
    time are left out.
    """
    size = micros(width)
    lives = quote_lifetimes(l1, key_cols, until, rows_per_range=rows_per_range)
    first, last = (F.expr(f"({c} - pmod({c}, {size}L)) div {size}L") for c in (AT, f"({UNTIL} - 1)"))
    parts = lives.withColumn("number", F.explode(F.sequence(first, last)))
    start, end = F.col("number") * size, (F.col("number") + 1) * size
    part = F.least(F.col(UNTIL), end) - F.greatest(F.col(AT), start)
    total = F.sum("part")
    return (
        parts.withColumn("part", part)
        .groupBy(*key_cols, "number")
        .agg(
            (F.sum(F.col("bid_price") * F.col("part")) / total).alias("bid_price"),
            (F.sum(F.col("ask_price") * F.col("part")) / total).alias("ask_price"),
            (F.sum((F.col("ask_price") - F.col("bid_price")) * F.col("part")) / total).alias("spread"),
            total.alias("quoted_micros"),
        )
        .select(
            *key_cols,
            F.timestamp_micros(start).alias("window_start"),
            F.timestamp_micros(end).alias("window_end"),
            "bid_price", "ask_price", "spread", "quoted_micros",
        )
    )
