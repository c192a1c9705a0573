"""Level-1 per micro-batch: every batch starts with an empty book."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from tidequote.functions.text import with_text_times
from tidequote.operators.quotes import l3_to_l1
from tidequote.operators.ranges import SeqRanges, plan_ranges
from tidequote.operators.sizing import output_partitions
from tidequote.sinks.files import write_batch_csv
from tidequote.sources.landing import landing_area

# A micro-batch of fewer rows is done sooner by one task than after being cut.
ROWS_TO_CUT = 1 << 17


def batch_ranges(batch: DataFrame, key_cols: Sequence[str]) -> SeqRanges:
    return plan_ranges(batch, key_cols=key_cols, min_rows=ROWS_TO_CUT)


def write_sized_batch(
    l1: DataFrame, batch_id: int, path: str, block_size: int, delimiter: str, header: bool | str
) -> None:
    """Measure and write one batch, computing it once."""
    l1 = with_text_times(l1).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        files = output_partitions(l1, block_size, delimiter)
        write_batch_csv(l1, batch_id, path, files, delimiter, header)
    finally:
        l1.unpersist()


def l1_batch_sink(
    path: str,
    mode: str = "best_quote",
    key_cols: Sequence[str] = (),
    block_size: int = 128,
    delimiter: str = ",",
    header: bool | str = True,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: Level-1 of the batch alone, sized, as CSV."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with landing_area(batch.sparkSession):
                l1 = l3_to_l1(batch, mode, key_cols, batch_ranges(batch, key_cols))
                write_sized_batch(l1, batch_id, path, block_size, delimiter, header)
        finally:
            batch.unpersist()

    return write


def window_batch_sink(
    path: str, block_size: int = 128, delimiter: str = ",", header: bool | str = True
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for the windows that a micro-batch closes: sized CSV."""

    def write(windows: DataFrame, batch_id: int) -> None:
        write_sized_batch(windows, batch_id, path, block_size, delimiter, header)

    return write
