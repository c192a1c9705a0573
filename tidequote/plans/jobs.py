"""The two jobs: files to Level-1 files, and a directory stream to Level-1 files."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidequote.functions.text import partitions_for, row_text, total_bytes
from tidequote.operators.quotes import l3_to_l1
from tidequote.operators.windows import l1_windows
from tidequote.schema import L3_SCHEMA, keyed_schema
from tidequote.sinks.files import write_by_date, write_csv
from tidequote.sources.files import file_log_settings, read_csv, read_file_stream
from tidequote.sources.landing import land, land_measured, landing_area
from tidequote.streaming.continuous import continuous_sink
from tidequote.streaming.continuous_book import continuous_book_sink
from tidequote.streaming.corrected import corrected_window_sink
from tidequote.streaming.per_batch import l1_batch_sink, window_batch_sink
from tidequote.streaming.windowed import watermarked


@dataclass(frozen=True)
class BatchOptions:
    input_path: str
    output_path: str
    input_delimiter: str = ","
    input_header: bool | str = True
    output_delimiter: str = ","
    output_header: bool | str = True
    block_size: int = 128
    mode: str = "best_quote"
    key_fields: Sequence[T.StructField] = ()
    strict_header: bool = False
    ordered_files: bool = False
    by_date: bool = False

    def __post_init__(self):
        if self.by_date and self.ordered_files:
            raise ValueError("files are either by date or in order")


@dataclass(frozen=True)
class BatchReport:
    rows: int
    payload_bytes: int
    partitions: int


def run_batch(spark: SparkSession, options: BatchOptions) -> BatchReport:
    """CSV in, Level-1 CSV out, in files of about ``block_size`` MiB.

    The text is parsed once into a landed table that the passes of the quote operator read;
    the result is landed once more while its size is measured, then written out.
    """
    keys = [f.name for f in options.key_fields]
    with landing_area(spark):
        l3 = land(
            read_csv(
                spark,
                options.input_path,
                keyed_schema(L3_SCHEMA, options.key_fields),
                options.input_delimiter,
                options.input_header,
                options.strict_header,
            ),
            "l3",
        )
        l1 = l3_to_l1(l3, options.mode, keys)
        size = total_bytes(row_text(l1, options.output_delimiter))
        landed, seen = land_measured(
            l1,
            "l1",
            rows=F.count("*"),
            payload_bytes=size,
            partitions=partitions_for(size, options.block_size),
        )
        csv = (seen["partitions"], options.output_delimiter, options.output_header)
        if options.by_date:
            write_by_date(landed, options.output_path, *csv)
        else:
            order = "seq_num" if options.ordered_files else None
            write_csv(landed, options.output_path, *csv, order)
    return BatchReport(**seen)


@dataclass(frozen=True)
class StreamOptions:
    input_stream_dir: str
    output_path: str
    checkpoint_dir: str
    input_file_format: str = "csv"
    input_delimiter: str = ","
    input_header: bool | str = True
    max_files_per_trigger: int | None = 1
    clean_source: str | None = None
    source_archive_dir: str | None = None
    cleanup_delay: int | None = None
    compact_interval: int | None = None
    output_delimiter: str = ","
    output_header: bool | str = True
    output_mode: str = "append"
    block_size: int = 128
    lateness: str = "30 minutes"
    mode: str = "best_quote"
    key_fields: Sequence[T.StructField] = ()
    continuous: bool = False
    drop_late: bool = False
    window: str | None = None
    slide: str | None = None
    forget_after: str = "7 days"

    def __post_init__(self):
        if self.output_mode not in ("append", "update"):
            raise ValueError(f"output_mode must be append or update, got {self.output_mode!r}")
        if self.window and (self.continuous or self.mode != "best_quote"):
            raise ValueError("windows hold the best quote of the window and carry nothing on")
        if self.slide and not self.window:
            raise ValueError("slide needs a window")
        if self.drop_late and not (self.continuous or self.window):
            raise ValueError("a batch quoted on its own has no late rows; drop_late needs continuous")


def run_stream(
    spark: SparkSession, options: StreamOptions, available_now: bool = False
) -> StreamingQuery:
    """Start the directory stream; the caller awaits or stops the query.

    Each micro-batch is quoted on its own, or from where the last one ended when ``continuous``.
    With ``window`` the output is the best quote of every window (each ``slide``). In append mode it
    is written once the watermark has passed it, and rows behind the watermark are dropped; in update
    mode it is written at once and late rows correct it, unless ``drop_late`` leaves out and counts those
    beyond ``lateness``, so there is one row a window at any time. Quotes are final in
    either mode. ``available_now`` stops after what is in the directory.
    """
    keys = [f.name for f in options.key_fields]
    late = options.lateness if options.drop_late else None
    stream = watermarked(
        read_file_stream(
            spark,
            options.input_stream_dir,
            keyed_schema(L3_SCHEMA, options.key_fields),
            options.input_file_format,
            options.input_header,
            options.input_delimiter,
            options.max_files_per_trigger,
            options.clean_source,
            options.source_archive_dir,
        ),
        options.lateness,
    )
    out = {
        "block_size": options.block_size,
        "delimiter": options.output_delimiter,
        "header": options.output_header,
    }
    if options.window and options.output_mode == "update":
        state = f"{options.checkpoint_dir}/window_state"
        window = (options.window, options.slide, options.key_fields, late)
        sink = corrected_window_sink(options.output_path, state, *window, **out)
    elif options.window:
        stream = l1_windows(stream, options.window, options.slide, keys)
        sink = window_batch_sink(options.output_path, **out)
    elif options.continuous and options.mode == "full_book":
        state = f"{options.checkpoint_dir}/book_state"
        book = (options.key_fields, late, options.forget_after)
        sink = continuous_book_sink(options.output_path, state, *book, **out)
    elif options.continuous:
        state = f"{options.checkpoint_dir}/quote_state"
        sink = continuous_sink(options.output_path, state, options.mode, keys, late, **out)
    else:
        sink = l1_batch_sink(options.output_path, options.mode, keys, **out)
    writer = (
        stream.writeStream.outputMode(options.output_mode)
        .foreachBatch(sink)
        .option("checkpointLocation", options.checkpoint_dir)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    with file_log_settings(spark, options.cleanup_delay, options.compact_interval):
        query = writer.start()
        # Sources read the session's settings after the start has returned.
        while query.isActive and query.status["message"].startswith("Initializing"):
            time.sleep(0.01)
        return query
