"""Payload size and the number of output partitions it calls for."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidequote.functions.text import partitions_for, row_text, total_bytes


def payload_bytes(df: DataFrame, text_col: str) -> DataFrame:
    """Total UTF-8 bytes of a text column, as one row."""
    return df.agg(total_bytes(df[text_col]).alias("payload_bytes"))


def output_size(df: DataFrame, block_size: int, delimiter: str = ",") -> DataFrame:
    """Bytes of the rows as CSV lines and the number of ``block_size`` MiB files they fill."""
    size = total_bytes(row_text(df, delimiter))
    return df.agg(
        size.alias("payload_bytes"), partitions_for(size, block_size).alias("partitions")
    )


def output_partitions(df: DataFrame, block_size: int, delimiter: str = ",") -> int:
    return output_size(df, block_size, delimiter).first()["partitions"]


def spread(df: DataFrame, partitions: int, order_col: str | None = None) -> DataFrame:
    """Even partitions; in ``order_col`` order from file to file when it is given."""
    if order_col is None:
        return df.repartition(partitions)
    return df.repartitionByRange(partitions, order_col).sortWithinPartitions(order_col)
