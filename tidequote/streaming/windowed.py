"""Windowed Level-1 over a stream, with late rows dropped behind the watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidequote.operators.windows import l1_windows


def watermarked(stream: DataFrame, lateness: str = "30 minutes") -> DataFrame:
    """Event-time watermark on ``time``, which must be a TIMESTAMP with zone."""
    return stream.withWatermark("time", lateness)


def windowed_stream(
    stream: DataFrame,
    width: str,
    slide: str | None = None,
    lateness: str = "30 minutes",
    key_cols: Sequence[str] = (),
) -> DataFrame:
    """Windows that an append sink gets once, when the watermark has passed their end."""
    return l1_windows(watermarked(stream, lateness), width, slide, key_cols)
