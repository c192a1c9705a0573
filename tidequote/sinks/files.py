"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidequote.functions.text import with_text_times
from tidequote.operators.sizing import spread


def write_csv(
    df: DataFrame,
    path: str,
    partitions: int,
    delimiter: str = ",",
    header: bool | str = True,
    order_col: str | None = None,
) -> None:
    """Overwrite ``path`` with ``partitions`` CSV files; times keep their full fraction."""
    (
        spread(with_text_times(df), partitions, order_col)
        .write.mode("overwrite")
        .option("sep", delimiter)
        .option("header", str(header).lower())
        .csv(path)
    )


def write_batch_csv(
    df: DataFrame,
    batch_id: int,
    path: str,
    partitions: int,
    delimiter: str = ",",
    header: bool | str = True,
) -> None:
    """One directory per micro-batch, overwritten only when that batch is replayed."""
    write_csv(df, f"{path}/batch_id={batch_id}", partitions, delimiter, header)


def write_by_date(
    df: DataFrame,
    path: str,
    partitions: int,
    delimiter: str = ",",
    header: bool | str = True,
) -> None:
    """CSV below ``trade_date=<day>``. Ranges over (day, seq_num) split a busy day over tasks."""
    dated = df.withColumn("trade_date", F.to_date("time"))
    (
        with_text_times(dated.repartitionByRange(partitions, "trade_date", "seq_num"))
        .write.mode("overwrite")
        .option("sep", delimiter)
        .option("header", str(header).lower())
        .partitionBy("trade_date")
        .csv(path)
    )
