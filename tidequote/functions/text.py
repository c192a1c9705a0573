"""Text forms of rows and timestamps, and byte arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIB = 1048576


def time_text(time: Column) -> Column:
    """The feed's own form: ``2021-08-02 22:11:21.94404 UTC``, fraction without trailing zeros.

    The same in every session time zone.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (F.unix_micros(time).cast("decimal(20,0)") / 1000000).cast("decimal(18,6)")
    utc = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.concat(utc.cast("string"), F.lit(" UTC"))


def utc_day(time: Column) -> Column:
    """The date in UTC, the same in every session time zone."""
    at, day = F.unix_micros(time), F.lit(86_400_000_000).cast("long")
    return F.date_from_unix_date(F.floor((at - F.pmod(at, day)) / day).cast("int"))


def _as_written(df: DataFrame) -> list[Column]:
    return [
        time_text(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ]


def with_text_times(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that the CSV writer keeps all six fraction digits."""
    return df.select(*_as_written(df))


def row_text(df: DataFrame, delimiter: str = ",") -> Column:
    """The line that the CSV sinks write for each row."""
    return F.to_csv(F.struct(*_as_written(df)), {"sep": delimiter})


def total_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text column, 0 over no rows."""
    return F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0).cast("long"))


def partitions_for(payload: Column, block_size: int) -> Column:
    """Whole blocks of ``block_size`` MiB in ``payload`` bytes, at least one."""
    if block_size <= 0:
        raise ValueError(f"block_size must be positive, got {block_size}")
    blocks = F.floor(F.floor(payload / F.lit(MIB)) / F.lit(block_size))
    return F.greatest(F.lit(1).cast("long"), blocks)
