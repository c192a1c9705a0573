"""Level-1 quotes per event-time window."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidequote.functions.messages import quote_messages, two_sided
from tidequote.operators.quotes import quote_state


def micros(duration: str) -> int:
    return pd.Timedelta(duration) // pd.Timedelta(microseconds=1)


def pane_totals() -> list[Column]:
    return [r.fold(r.value).alias(r.name) for r in quote_state()]


def shape_windows(windows: DataFrame, key_cols: Sequence[str], both_sides: bool = False) -> DataFrame:
    out = windows.select(
        *key_cols,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("bid.price").alias("bid_price"),
        F.col("ask.price").alias("ask_price"),
        F.col("bid.qty").alias("bid_size"),
        F.col("ask.qty").alias("ask_size"),
        "n",
    )
    return out.where(two_sided()) if both_sides else out


def l1_windows(
    l3: DataFrame,
    width: str,
    slide: str | None = None,
    key_cols: Sequence[str] = (),
    both_sides: bool = False,
) -> DataFrame:
    """Best bid, best ask, their sizes and the message count of each window.

    Rows without a time are in no window.
    """
    return shape_windows(fold_windows(l3, width, slide, key_cols), key_cols, both_sides)


def fold_windows(l3: DataFrame, width: str, slide: str | None = None, key_cols: Sequence[str] = ()) -> DataFrame:
    """(keys, window, the folds of ``quote_state``, n) of each window.

    A batch sliding window is built from panes of one slide each, so a row is folded once
    instead of once per window it falls in; only panes are repeated. A batch is folded by price
    first, without a sort of its messages.
    """
    messages = quote_messages(l3, key_cols)
    by = [*key_cols, "window"]
    panes = slide and not l3.isStreaming and micros(width) % micros(slide) == 0
    bounds = F.window("time", slide) if panes else F.window("time", width, slide or width)
    folded = messages.groupBy(*key_cols, bounds.alias("window")).agg(*pane_totals(), F.count("*").alias("n"))
    if not panes:
        return folded
    step, per_window = micros(slide), micros(width) // micros(slide)
    start = F.unix_micros("window.start") - F.col("back") * F.lit(step).cast("long")
    spread = folded.withColumn(
        "back", F.explode(F.sequence(F.lit(0), F.lit(per_window - 1)))
    ).withColumn(
        "window",
        F.struct(
            F.timestamp_micros(start).alias("start"),
            F.timestamp_micros(start + micros(width)).alias("end"),
        ),
    )
    return spread.groupBy(*by).agg(*merged_totals())


def merged_totals() -> list[Column]:
    """The folds of several parts of a window."""
    return [*[r.fold(F.col(r.name)).alias(r.name) for r in quote_state()], F.sum("n").alias("n")]
