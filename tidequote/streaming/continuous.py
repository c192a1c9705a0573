"""Level-1 over an endless feed: the quote state goes on from micro-batch to micro-batch.

The state is a small table (one row per instrument) written next to the output. A batch
reads the state its predecessor left, runs the same parallel scan as the batch job with
that opening, and leaves its own state in the other of two slots. A replayed batch finds
its opening untouched and overwrites what it wrote before, so output and state stay exact.
Unlike a per-key state function this needs no Python and spreads a single busy instrument
over all executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidequote.operators.quotes import CARRIED_MODES, carried_messages, l3_to_l1, quote_state
from tidequote.sources.landing import landing_area
from tidequote.streaming.per_batch import batch_ranges, write_sized_batch

LATE = "_late"


def _slot(state_path: str, batch_id: int) -> str:
    return f"{state_path}/slot={batch_id % 2}"


def late_rows(spark: SparkSession, state_path: str) -> int:
    """Messages dropped as too late so far."""
    state = spark.read.option("recursiveFileLookup", "true").parquet(state_path)
    return state.agg(F.max("late_rows").alias("n")).first()["n"] or 0


def _read_state(
    spark: SparkSession, state_path: str, batch_id: int
) -> tuple[DataFrame | None, int | None, int]:
    """What the previous batch left, the latest time seen and the rows dropped up to it."""
    if batch_id == 0:
        return None, None, 0
    state = spark.read.parquet(_slot(state_path, batch_id - 1))
    left = state.agg(
        F.min("batch_id").alias("first"),
        F.max("batch_id").alias("last"),
        F.max(F.unix_micros("latest")).alias("latest"),
        F.max("late_rows").alias("late_rows"),
    ).first()
    if {left["first"], left["last"]} - {batch_id - 1, None}:
        raise RuntimeError(f"state in {state_path} is not that of batch {batch_id - 1}")
    return state, left["latest"], left["late_rows"] or 0


def continuous_sink(
    path: str,
    state_path: str,
    mode: str = "best_quote",
    key_cols: Sequence[str] = (),
    drop_later_than: str | None = None,
    block_size: int = 128,
    delimiter: str = ",",
    header: bool | str = True,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function carrying the quote state.

    Late messages count when they arrive, unless ``drop_later_than`` bounds the lateness; those
    dropped then are counted in the state, see ``late_rows``.
    """
    if mode not in CARRIED_MODES:
        raise ValueError(f"a continuous stream has mode {' or '.join(CARRIED_MODES)}, not {mode!r}")
    running = quote_state(mode)
    names = [r.name for r in running]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, latest, dropped = _read_state(spark, state_path, batch_id)
        is_late = F.lit(False)
        if drop_later_than is not None and latest is not None:
            # As Spark's watermark: the latest time of earlier batches less the lateness.
            limit = latest - pd.Timedelta(drop_later_than) // pd.Timedelta(microseconds=1)
            is_late = F.coalesce(F.unix_micros("time") < limit, F.lit(False))
        arrived = carried_messages(batch, mode, key_cols).withColumn(LATE, is_late)
        arrived = arrived.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            messages = arrived.where(~F.col(LATE)).drop(LATE)
            opening = None if before is None else before.select(*key_cols, *names)
            with landing_area(spark):
                ranges = batch_ranges(messages, key_cols)
                l1 = l3_to_l1(messages, mode, key_cols, ranges, opening)
                write_sized_batch(l1, batch_id, path, block_size, delimiter, header)
            if drop_later_than is not None:
                dropped += arrived.where(LATE).count()
            states = messages.groupBy(*key_cols).agg(
                *[r.fold(r.value).alias(r.name) for r in running], F.max("time").alias("latest")
            )
            if before is not None:
                states = states.unionByName(before.select(*states.columns))
            merged = states.groupBy(*key_cols).agg(
                *[r.fold(F.col(r.name)).alias(r.name) for r in running],
                F.max("latest").alias("latest"),
            )
            merged.withColumns(
                {"batch_id": F.lit(batch_id).cast("long"), "late_rows": F.lit(dropped).cast("long")}
            ).write.mode("overwrite").parquet(_slot(state_path, batch_id))
        finally:
            arrived.unpersist()

    return write
