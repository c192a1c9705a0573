"""Windows that late messages correct.

A micro-batch is folded into the windows it touches. Their state so far is looked up, merged with the new
part (the folds are associative, so the order of arrival does not matter) and stored as a new version.
The output holds one row a window, the newest: the files of the days that a batch touches are written
anew, all others stay. Nothing is kept open or thrown away by a watermark; a bound on lateness
is an option, and what it drops is counted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from tidequote.functions.messages import quote_messages
from tidequote.functions.text import utc_day, with_text_times
from tidequote.operators.sizing import output_partitions
from tidequote.operators.windows import fold_windows, merged_totals, micros, shape_windows
from tidequote.streaming.versioned import VersionedTable, last_batch, read_progress, write_progress

LATE = "_late"
# What ``quote_state`` folds.
BID = T.StructType(
    [
        T.StructField("price", T.DoubleType()),
        T.StructField("unnumbered", T.BooleanType()),
        T.StructField("first", T.LongType()),
        T.StructField("qty", T.IntegerType()),
    ]
)
ASK = T.StructType(
    [
        T.StructField("price", T.DoubleType()),
        T.StructField("numbered", T.BooleanType()),
        T.StructField("first", T.LongType()),
        T.StructField("less", T.IntegerType()),
        T.StructField("qty", T.IntegerType()),
    ]
)


def window_table(state_path: str, key_fields: Sequence[T.StructField] = (), compact_every: int = 8) -> VersionedTable:
    schema = T.StructType(
        [
            *key_fields,
            T.StructField("window_start", T.TimestampType()),
            T.StructField("window_end", T.TimestampType()),
            T.StructField("bid", BID),
            T.StructField("ask", ASK),
            T.StructField("n", T.LongType()),
        ]
    )
    keys = (*(f.name for f in key_fields), "window_start", "window_end")
    return VersionedTable(f"{state_path}/windows", keys, schema, compact_every)


def _shaped(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    window = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    return shape_windows(rows.withColumn("window", window), keys)


def corrected_window_sink(
    path: str,
    state_path: str,
    width: str,
    slide: str | None = None,
    key_fields: Sequence[T.StructField] = (),
    drop_later_than: str | None = None,
    block_size: int = 128,
    delimiter: str = ",",
    header: bool | str = True,
    compact_every: int = 8,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: CSV below ``day=<date>`` (in UTC) of the window's start, one row a window.

    Rows without a time are in no window.
    """
    keys = [f.name for f in key_fields]
    table = window_table(state_path, key_fields, compact_every)
    progress = f"{state_path}/progress"
    start = F.col("window_start")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest, dropped = read_progress(spark, progress, batch_id)
        is_late = F.lit(False)
        if drop_later_than is not None and latest is not None:
            is_late = F.coalesce(F.unix_micros("time") < latest - micros(drop_later_than), F.lit(False))
        arrived = quote_messages(batch, keys).withColumn(LATE, is_late).persist(StorageLevel.MEMORY_AND_DISK)
        own = fold_windows(arrived.where(~F.col(LATE)).drop(LATE), width, slide, keys)
        own = own.select(*keys, "window.start", "window.end", "bid", "ask", "n")
        own = own.withColumnsRenamed({"start": "window_start", "end": "window_end"}).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = arrived.agg(
                F.max(F.when(~F.col(LATE), F.unix_micros("time"))).alias("latest"), F.count_if(LATE).alias("late")
            ).first()
            # versions are sorted by time, so these bounds leave out most of what they hold
            span = own.agg(*[f(F.unix_micros(start)) for f in (F.min, F.max)]).first()
            lo, hi = (F.timestamp_micros(F.lit(at).cast("long")) for at in span)
            before = table.versions(spark, batch_id).where(start.between(lo, hi))
            known = table.newest(before).select(*own.columns)
            both = own.withColumn("_new", F.lit(True)).unionByName(known.withColumn("_new", F.lit(False)))
            merged = both.groupBy(*table.keys).agg(*merged_totals(), F.max("_new").alias("_new"))
            # only the windows that the batch touches get a version
            merged = merged.where("_new").drop("_new")
            table.write(merged.repartitionByRange(start).sortWithinPartitions(start), batch_id)
            days = own.select(utc_day(start).alias("day")).distinct()
            in_span = utc_day(start).between(utc_day(lo), utc_day(hi))
            rows = table.newest(table.versions_upto(spark, batch_id).where(in_span))
            rows = rows.withColumn("day", utc_day(start)).join(days, "day", "left_semi")
            _write_days(_shaped(rows, keys).withColumn("day", utc_day(start)), path, block_size, delimiter, header)
        finally:
            own.unpersist()
            arrived.unpersist()
        table.compact(spark, batch_id)
        newest = max((t for t in (latest, seen["latest"]) if t is not None), default=None)
        write_progress(spark, progress, batch_id, newest, dropped + seen["late"])

    return write


def _write_days(rows: DataFrame, path: str, block_size: int, delimiter: str, header: bool | str) -> None:
    rows = with_text_times(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        files = output_partitions(rows, block_size, delimiter)
        (
            rows.repartitionByRange(files, "day", "window_start")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("sep", delimiter)
            .option("header", str(header).lower())
            .partitionBy("day")
            .csv(path)
        )
    finally:
        rows.unpersist()


def corrected_windows(
    spark: SparkSession, state_path: str, key_fields: Sequence[T.StructField] = (), compact_every: int = 8
) -> DataFrame:
    """The newest row of every window, from the state."""
    last = last_batch(spark, f"{state_path}/progress")
    rows = window_table(state_path, key_fields, compact_every).current(spark, 0 if last is None else last + 1)
    return _shaped(rows, [f.name for f in key_fields])
