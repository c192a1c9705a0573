"""Named queries over the given tables; each takes (spark, sf_dir) and returns a DataFrame.

Level-3 messages are derived from the whole ``events`` table and landed first, as a real
feed would be. Results show times without zone, like the source table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidequote.functions.messages import l3_messages
from tidequote.functions.text import partitions_for, row_text, total_bytes, with_text_times
from tidequote.operators.asof import asof_join, both_feeds
from tidequote.operators.book import book_depth
from tidequote.operators.consolidated import consolidated
from tidequote.operators.lives import order_lives
from tidequote.operators.quotes import l3_to_l1
from tidequote.operators.ranges import plan_ranges
from tidequote.operators.replays import without_replays
from tidequote.operators.sessions import l1_sessions
from tidequote.operators.sizing import output_partitions, output_size, payload_bytes, spread
from tidequote.operators.weighted import time_weighted
from tidequote.operators.windows import l1_windows
from tidequote.plans.jobs import BatchOptions, StreamOptions, run_batch, run_stream
from tidequote.schema import L1_SCHEMA, L3_SCHEMA, keyed_schema
from tidequote.sinks.files import write_by_date, write_csv
from tidequote.sources.events import l3_from_events
from tidequote.sources.files import cast_to, read_csv, read_csv_text, read_file_stream
from tidequote.sources.landing import fresh_path, land
from tidequote.sources.quarantine import intake
from tidequote.streaming.lives import life_state, life_stream
from tidequote.streaming.sessions import session_sink
from tidequote.streaming.windowed import windowed_stream

Query = Callable[[SparkSession, str], DataFrame]

KEY = "instrument"
KEY_FIELD = T.StructField(KEY, T.LongType())
# Files of this many MiB in the sizing queries, small enough to give several at any scale.
SMALL_BLOCK = 1
WINDOW_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("bid_price", T.DoubleType()),
        T.StructField("ask_price", T.DoubleType()),
        T.StructField("bid_size", T.IntegerType()),
        T.StructField("ask_size", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
FORMATS = ("csv", "json", "parquet", "orc")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _l3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return land(l3_from_events(_table(spark, sf_dir, "events")), "l3")


def _partial_l3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with trades of one to three pieces, so that most orders are filled in parts."""
    feed = l3_from_events(_table(spark, sf_dir, "events"))
    sold = F.when(F.col("trade_qty").isNotNull(), (F.pmod("seq_num", F.lit(3)) + 1).cast("int"))
    return land(feed.withColumn("trade_qty", sold), "partial")


def _skewed(l3: DataFrame) -> DataFrame:
    """Instrument 0 gets most of the feed."""
    return land(l3.withColumn(KEY, F.greatest(F.col(KEY) - 5, F.lit(0))), "skewed")


def _plain_times(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _feed(l3: DataFrame, *more: str) -> DataFrame:
    return l3.select(*L3_SCHEMA.names, *more)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(l3_messages(_l3(spark, sf_dir)))


def _action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = l3_messages(_l3(spark, sf_dir))
    return messages.groupBy("action", "side").agg(
        F.count("*").alias("messages"),
        F.count("price").alias("priced"),
        F.sum("qty").alias("total_qty"),
    )


def _message_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = l3_messages(_l3(spark, sf_dir))
    return messages.select("seq_num", F.octet_length(row_text(messages)).alias("line_bytes"))


def _quotes(mode: str, *keys: str) -> Query:
    return lambda spark, sf_dir: _plain_times(l3_to_l1(_l3(spark, sf_dir), mode, keys))


def _split_quotes(mode: str, *keys: str) -> Query:
    """The quotes with ranges of a twentieth of the feed and, with keys, one that holds most of it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        l3 = _l3(spark, sf_dir)
        if keys:
            l3 = _skewed(l3)
        l3 = l3_messages(l3, keys)
        ranges = plan_ranges(l3, key_cols=keys, rows_per_range=l3.count() // 20 + 1)
        return _plain_times(l3_to_l1(l3, mode, keys, ranges))

    return query


def _tied_quotes(mode: str) -> Query:
    """Four messages share each order value, and some users' messages have none."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        l3 = _l3(spark, sf_dir)
        seq = F.when(F.col(KEY) != 7, F.floor(F.col("seq_num") / 4))
        return _plain_times(l3_to_l1(land(l3.withColumn("seq_num", seq), "tied"), mode))

    return query


def _partial_book(*keys: str) -> Query:
    return lambda spark, sf_dir: _plain_times(l3_to_l1(_partial_l3(spark, sf_dir), "full_book", keys))


def _depth(levels: int, split: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        messages = l3_messages(_partial_l3(spark, sf_dir))
        ranges = plan_ranges(messages, rows_per_range=messages.count() // 20 + 1) if split else None
        return _plain_times(book_depth(messages, levels, ranges=ranges))

    return query


def _replayed_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed delivered twice, in other files, and counted once."""
    l3 = _partial_l3(spark, sf_dir)
    messages, _ = without_replays(l3.unionByName(l3))
    return _plain_times(l3_to_l1(land(messages, "once"), "full_book"))


def _replay_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed again with every tenth message's quantity changed: those are set apart."""
    l3 = _feed(_l3(spark, sf_dir))
    changed = l3.where(F.col("seq_num") % 10 == 0).withColumn("add_qty", F.col("add_qty") + 1)
    _, conflicts = without_replays(l3.unionByName(l3).unionByName(changed))
    return conflicts.select("seq_num", "add_qty", "copies", "versions")


def _trades_and_quotes(l3: DataFrame) -> tuple[DataFrame, DataFrame]:
    trades = l3_messages(l3, [KEY]).where("action = 'trade'").select(KEY, "seq_num", "time", "price", "qty")
    return land(trades, "trades"), land(l3_to_l1(l3, "best_quote", [KEY]), "quotes")


def _asof(tolerance: str | None = None, split: bool = False) -> Query:
    """Each trade with the latest quote of its instrument at or before its time."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        l3 = _l3(spark, sf_dir)
        trades, quotes = _trades_and_quotes(_skewed(l3) if split else l3)
        ranges = None
        if split:
            rows = both_feeds(trades, quotes, "time", [KEY], ["seq_num"])
            ranges = plan_ranges(rows, "_on", [KEY], rows.count() // 20 + 1)
        found = asof_join(trades, quotes, "time", [KEY], tolerance=tolerance, ranges=ranges)
        return _plain_times(found)

    return query


def _asof_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each delete with the last trade before it by order value, over all instruments."""
    messages = l3_messages(_l3(spark, sf_dir)).select("seq_num", "action", "price", "qty")
    deletes, trades = (messages.where(F.col("action") == a).drop("action") for a in ("delete", "trade"))
    return asof_join(deletes, trades, "seq_num", ties=(), prefix="trade_", strict=True, tolerance=20)


def _lives(most: str, *keys: str) -> Query:
    return lambda spark, sf_dir: _plain_times(order_lives(_l3(spark, sf_dir), most, keys))


def _sessions(gap: str, *keys: str, split: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        l3 = _l3(spark, sf_dir)
        more = {"rows_per_range": 50} if split else {}
        return _plain_times(l1_sessions(_skewed(l3) if split and keys else l3, gap, keys, **more))

    return query


def _weighted(width: str, *keys: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        l1 = land(l3_to_l1(_l3(spark, sf_dir), "event_quote", keys), "l1")
        return _plain_times(time_weighted(l1, width, keys))

    return query


def _consolidated(split: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        l3 = _partial_l3(spark, sf_dir)
        l1 = land(l3_to_l1(_skewed(l3) if split else l3, "event_quote", [KEY]), "l1")
        more = {"rows_per_range": l1.count() // 20 + 1} if split else {}
        return _plain_times(consolidated(l1, [KEY], **more))

    return query


def _windows(width: str, slide: str | None = None, *keys: str, both_sides: bool = False) -> Query:
    return lambda spark, sf_dir: _plain_times(
        l1_windows(_l3(spark, sf_dir), width, slide, keys, both_sides)
    )


def _files(df: DataFrame, delimiter: str = ",") -> int:
    return output_partitions(df, SMALL_BLOCK, delimiter)


def _csv_of(spark: SparkSession, df: DataFrame, delimiter: str = ",") -> str:
    path = fresh_path(spark, "csv")
    write_csv(df, path, _files(df, delimiter), delimiter)
    return path


def _csv_scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv_of(spark, _feed(_l3(spark, sf_dir)))
    return _plain_times(cast_to(read_csv_text(spark, path), L3_SCHEMA))


def _csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv_of(spark, _feed(_l3(spark, sf_dir)), "|")
    return _plain_times(read_csv(spark, path, L3_SCHEMA, "|", strict_header=True))


def _dirty_csv(spark: SparkSession, sf_dir: str) -> str:
    """The feed as CSV in which some rows are broken in different ways."""
    feed = with_text_times(_feed(_l3(spark, sf_dir))).withColumn("_seq", F.col("seq_num"))
    seq = F.col("_seq")
    broken = feed.withColumns(
        {
            "seq_num": F.when(seq % 89 == 1, F.lit("12x")).when(seq % 89 == 2, F.lit(None)).otherwise(seq.cast("string")),
            "time": F.when(seq % 89 == 3, F.lit("soon")).otherwise(F.col("time")),
            "add_side": F.when((seq % 89 == 4) & F.col("add_side").isNotNull(), F.lit("HOLD")).otherwise(F.col("add_side")),
            "delete_order_id": F.when(seq % 89 == 5, F.coalesce("delete_order_id", F.lit(1))).otherwise(F.col("delete_order_id")),
        }
    )
    path = fresh_path(spark, "dirty")
    line = F.to_csv(F.struct(*L3_SCHEMA.names))
    line = F.when(seq % 89 == 6, F.concat(line, F.lit(",more"))).otherwise(line)
    broken.select(line.alias("value")).repartition(_files(feed)).write.text(path)
    return path


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by reason; good ones have none."""
    read = intake(spark, _dirty_csv(spark, sf_dir), header=False)
    good = read.good.select(F.lit("good").alias("reason"))
    return good.unionByName(read.bad.select("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def _quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(intake(spark, _dirty_csv(spark, sf_dir), header=False).good)


def _csv_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "ordered")
    l1 = land(l3_to_l1(_l3(spark, sf_dir)), "l1")
    write_csv(l1, path, _files(l1, ";"), ";", False, order_col="seq_num")
    return _plain_times(read_csv(spark, path, L1_SCHEMA, ";", False))


def _csv_write_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-date")
    l1 = land(l3_to_l1(_l3(spark, sf_dir)), "l1")
    write_by_date(l1, path, _files(l1))
    dated = keyed_schema(L1_SCHEMA, [T.StructField("trade_date", T.DateType())])
    return _plain_times(read_csv(spark, path, dated))


def _payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_bytes(_table(spark, sf_dir, "documents"), "text")


def _output_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output_size(l3_to_l1(_l3(spark, sf_dir)), SMALL_BLOCK)


def _document_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = total_bytes(F.col("text"))
    return (
        _table(spark, sf_dir, "documents")
        .groupBy("source")
        .agg(size.alias("payload_bytes"), partitions_for(size, SMALL_BLOCK).alias("partitions"))
    )


def _spread_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    files = payload_bytes(documents, "text").select(
        partitions_for(F.col("payload_bytes"), SMALL_BLOCK).alias("files")
    )
    return spread(documents, files.first()["files"]).select(
        "doc_id", F.octet_length("text").alias("text_bytes")
    )


def _stream_scan(file_format: str) -> Query:
    """Write the feed in ``file_format``, stream it back file by file into a table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = _feed(_l3(spark, sf_dir))
        source, sink = fresh_path(spark, "feed"), fresh_path(spark, "streamed")
        files = _files(feed)
        if file_format == "csv":
            write_csv(feed, source, files)
        else:
            # Spark's JSON writer, like its CSV writer, keeps only milliseconds of a timestamp.
            rows = with_text_times(feed) if file_format == "json" else feed
            rows.repartition(files).write.format(file_format).save(source)
        stream = read_file_stream(
            spark, source, L3_SCHEMA, file_format, max_files_per_trigger=-(-files // 2)
        )
        query = (
            stream.writeStream.outputMode("append")
            .format("parquet")
            .option("checkpointLocation", fresh_path(spark, "progress"))
            .trigger(availableNow=True)
            .start(sink)
        )
        query.awaitTermination()
        return _plain_times(spark.read.schema(L3_SCHEMA).parquet(sink))

    return query


# Files of one delivery arrive together; the stream resumes from its checkpoint for the next.
def _deliveries(feed: DataFrame, parts: list, source: str):
    for part in parts:
        feed.where(part).write.mode("append").parquet(source)
        yield


def _thirds(feed: DataFrame) -> list:
    """The feed in three parts by order value; rows without one come first."""
    last = feed.agg(F.max("seq_num").alias("last")).first()["last"] or 0
    third = F.coalesce(F.floor(F.col("seq_num") * 3 / F.lit(last + 1)), F.lit(0))
    return [third <= 0, third == 1, third >= 2]


def _stream_job(keys: bool = False, source: Callable = _l3, **options) -> Query:
    """Deliver the feed in three parts; one micro-batch each, resumed from the checkpoint."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = (KEY_FIELD,) if keys else ()
        feed = _feed(source(spark, sf_dir), *[f.name for f in fields])
        job = StreamOptions(
            input_stream_dir=fresh_path(spark, "arriving"),
            output_path=fresh_path(spark, "quotes"),
            checkpoint_dir=fresh_path(spark, "progress"),
            input_file_format="parquet",
            max_files_per_trigger=None,
            key_fields=fields,
            **options,
        )
        for _ in _deliveries(feed, _thirds(feed), job.input_stream_dir):
            run_stream(spark, job, available_now=True).awaitTermination()
        l1 = [T.StructField(f.name, _wide(f)) if job.mode == "full_book" else f for f in L1_SCHEMA.fields]
        schema = T.StructType([*fields, *l1, T.StructField("batch_id", T.LongType())])
        return _plain_times(read_csv(spark, job.output_path, schema))

    return query


def _wide(field: T.StructField) -> T.DataType:
    """Sizes of price levels are totals."""
    return T.LongType() if field.name.endswith("_size") else field.dataType


def _stream_corrected(width: str, slide: str | None, keys: bool = False) -> Query:
    """The window job in update mode; each delivery has messages of all times, so all windows are corrected."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = (KEY_FIELD,) if keys else ()
        feed = _feed(_l3(spark, sf_dir), *[f.name for f in fields])
        job = StreamOptions(
            input_stream_dir=fresh_path(spark, "arriving"),
            output_path=fresh_path(spark, "windows"),
            checkpoint_dir=fresh_path(spark, "progress"),
            input_file_format="parquet",
            max_files_per_trigger=None,
            key_fields=fields,
            window=width,
            slide=slide,
            output_mode="update",
        )
        parts = [F.pmod(F.coalesce("seq_num", F.lit(0)), F.lit(3)) == k for k in range(3)]
        for _ in _deliveries(feed, parts, job.input_stream_dir):
            run_stream(spark, job, available_now=True).awaitTermination()
        schema = T.StructType([*fields, *WINDOW_SCHEMA.fields[:-1], T.StructField("day", T.DateType())])
        return _plain_times(read_csv(spark, job.output_path, schema)).drop("day")

    return query


def _stream_sessions(gap: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = _feed(_l3(spark, sf_dir))
        source, out = fresh_path(spark, "arriving"), fresh_path(spark, "sessions")
        progress, state = fresh_path(spark, "progress"), fresh_path(spark, "session-state")
        for _ in _deliveries(feed, _thirds(feed), source):
            query = (
                read_file_stream(spark, source, L3_SCHEMA, "parquet")
                .writeStream.foreachBatch(session_sink(out, state, gap))
                .option("checkpointLocation", progress)
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        return _plain_times(read_csv(spark, out, WINDOW_SCHEMA)).drop("batch_id")

    return query


def _stream_lives(most: str, *keys: str) -> Query:
    """Lives of orders over three deliveries, and a message of no order that lets the last ones expire."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = [KEY_FIELD] if keys else []
        feed = _feed(_l3(spark, sf_dir), *keys)
        source, sink = fresh_path(spark, "arriving"), fresh_path(spark, "lives")
        progress = fresh_path(spark, "progress")
        end = (F.max("time") + F.expr(f"interval {most}") + F.expr("interval 1 day")).alias("time")
        beat = feed.agg(end).select(
            *[F.col("time") if f.name == "time" else F.lit(None).cast(f.dataType).alias(f.name) for f in feed.schema.fields]
        )
        parts = [*_thirds(feed), F.lit(True)]
        for k, part in enumerate(parts):
            (beat if k == 3 else feed).where(part).write.mode("append").parquet(source)
            stream = read_file_stream(spark, source, T.StructType([*L3_SCHEMA.fields, *fields]), "parquet")
            lives = life_stream(stream, most, key_cols=keys).writeStream.outputMode("append").format("parquet")
            with life_state(spark):
                query = lives.option("checkpointLocation", progress).trigger(availableNow=True).start(sink)
            query.awaitTermination()
        return _plain_times(spark.read.parquet(sink))

    return query


def _stream_windows(width: str, slide: str | None, late: bool) -> Query:
    """Windows of a watermarked stream. When ``late``, all deletes come after all else."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = _feed(_l3(spark, sf_dir))
        source, sink = fresh_path(spark, "arriving"), fresh_path(spark, "windows")
        progress = fresh_path(spark, "progress")
        is_delete = F.col("delete_order_id").isNotNull()
        parts = [~is_delete, is_delete] if late else _thirds(feed)
        for _ in _deliveries(feed, parts, source):
            stream = read_file_stream(spark, source, L3_SCHEMA, "parquet")
            query = (
                windowed_stream(stream, width, slide)
                .writeStream.outputMode("append")
                .format("parquet")
                .option("checkpointLocation", progress)
                .trigger(availableNow=True)
                .start(sink)
            )
            query.awaitTermination()
        return _plain_times(spark.read.parquet(sink))

    return query


def _stream_window_job(width: str, slide: str) -> Query:
    """The stream job with windowed output."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = _feed(_l3(spark, sf_dir))
        job = StreamOptions(
            input_stream_dir=fresh_path(spark, "arriving"),
            output_path=fresh_path(spark, "windows"),
            checkpoint_dir=fresh_path(spark, "progress"),
            input_file_format="parquet",
            max_files_per_trigger=None,
            window=width,
            slide=slide,
        )
        for _ in _deliveries(feed, _thirds(feed), job.input_stream_dir):
            run_stream(spark, job, available_now=True).awaitTermination()
        return _plain_times(read_csv(spark, job.output_path, WINDOW_SCHEMA)).drop("batch_id")

    return query


def _stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the feed with archiving on, a micro-batch a delivery; then read what is archived and what is left."""
    feed = _feed(_l3(spark, sf_dir))
    root = fresh_path(spark, "archiving")
    source, archive = f"{root}/in", f"{root}/done"
    job = StreamOptions(
        input_stream_dir=source,
        output_path=f"{root}/quotes",
        checkpoint_dir=f"{root}/progress",
        input_file_format="parquet",
        max_files_per_trigger=None,
        clean_source="archive",
        source_archive_dir=archive,
        compact_interval=2,
    )
    for _ in _deliveries(feed, _thirds(feed), source):
        run_stream(spark, job, available_now=True).awaitTermination()
    both = spark.read.schema(L3_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return _plain_times(both.parquet(source).unionByName(both.parquet(archive)))


def _batch_job(mode: str, keys: bool = False, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = (KEY_FIELD,) if keys else ()
        feed = _feed(_l3(spark, sf_dir), *[f.name for f in fields])
        job = BatchOptions(
            input_path=_csv_of(spark, feed),
            output_path=fresh_path(spark, "quotes"),
            block_size=SMALL_BLOCK,
            mode=mode,
            key_fields=fields,
            **options,
        )
        run_batch(spark, job)
        schema = T.StructType([*fields, *L1_SCHEMA.fields])
        return _plain_times(read_csv(spark, job.output_path, schema))

    return query


def queries() -> dict[str, Query]:
    return {
        "l3_messages": _messages,
        "l3_action_counts": _action_counts,
        "l3_line_bytes": _message_text,
        "l1_best_quote": _quotes("best_quote"),
        "l1_event_quote": _quotes("event_quote"),
        "l1_as_coded": _quotes("as_coded"),
        "l1_full_book": _quotes("full_book"),
        "l1_best_quote_keyed": _quotes("best_quote", KEY),
        "l1_event_quote_keyed": _quotes("event_quote", KEY),
        "l1_as_coded_keyed": _quotes("as_coded", KEY),
        "l1_full_book_keyed": _quotes("full_book", KEY),
        "l1_best_quote_split": _split_quotes("best_quote"),
        "l1_full_book_split": _split_quotes("full_book"),
        "l1_best_quote_keyed_split": _split_quotes("best_quote", KEY),
        "l1_full_book_keyed_split": _split_quotes("full_book", KEY),
        "l1_best_quote_tied": _tied_quotes("best_quote"),
        "l1_as_coded_tied": _tied_quotes("as_coded"),
        "l1_full_book_partial": _partial_book(),
        "l1_full_book_partial_keyed": _partial_book(KEY),
        "l1_depth_5": _depth(5),
        "l1_depth_5_split": _depth(5, split=True),
        "l1_full_book_replayed": _replayed_book,
        "l3_replay_conflicts": _replay_conflicts,
        "asof_trade_quote": _asof(),
        "asof_trade_quote_split": _asof("10 minutes", split=True),
        "asof_delete_trade": _asof_strict,
        "order_life": _lives("1 hour"),
        "order_life_keyed": _lives("10 minutes", KEY),
        "l1_consolidated": _consolidated(),
        "l1_consolidated_split": _consolidated(split=True),
        "l1_window_session": _sessions("5 minutes"),
        "l1_window_session_keyed": _sessions("20 minutes", KEY),
        "l1_window_session_split": _sessions("5 minutes", split=True),
        "l1_window_time_weighted": _weighted("15 minutes"),
        "l1_window_time_weighted_keyed": _weighted("1 hour", KEY),
        "csv_quarantine": _quarantine,
        "csv_quarantine_good": _quarantine_good,
        "l1_window_tumbling": _windows("1 hour"),
        "l1_window_sliding": _windows("1 hour", "15 minutes"),
        "l1_window_sliding_keyed": _windows("6 hours", "1 hour", KEY, both_sides=True),
        "csv_scan_header": _csv_scan_text,
        "csv_scan_typed": _csv_scan_typed,
        "csv_write_ordered": _csv_write,
        "csv_write_partitioned": _csv_write_by_date,
        "payload_bytes": _payload,
        "output_partitions": _output_size,
        "document_partitions": _document_partitions,
        "repartition_rows": _spread_rows,
        **{f"stream_{f}_scan": _stream_scan(f) for f in FORMATS},
        "stream_l1_per_batch": _stream_job(),
        "stream_l1_per_batch_keyed": _stream_job(keys=True, mode="event_quote"),
        "stream_l1_continuous": _stream_job(continuous=True),
        "stream_l1_continuous_keyed": _stream_job(keys=True, continuous=True, mode="event_quote"),
        "stream_l1_continuous_as_coded": _stream_job(continuous=True, mode="as_coded"),
        "stream_l1_full_book": _stream_job(source=_partial_l3, continuous=True, mode="full_book"),
        "stream_l1_full_book_keyed": _stream_job(keys=True, source=_partial_l3, continuous=True, mode="full_book"),
        "stream_window_corrected": _stream_corrected("1 hour", "15 minutes"),
        "stream_window_corrected_keyed": _stream_corrected("1 hour", None, keys=True),
        "stream_l1_window_session": _stream_sessions("5 minutes"),
        "stream_order_life": _stream_lives("1 hour"),
        "stream_order_life_keyed": _stream_lives("10 minutes", KEY),
        "stream_archive_scan": _stream_archive,
        "stream_job_window": _stream_window_job("1 hour", "15 minutes"),
        "stream_l1_window": _stream_windows("1 hour", None, late=False),
        "stream_l1_window_sliding": _stream_windows("1 hour", "15 minutes", late=False),
        "stream_late_rows": _stream_windows("1 hour", None, late=True),
        "job_batch": _batch_job("best_quote"),
        "job_batch_as_coded": _batch_job("as_coded"),
        "job_batch_keyed": _batch_job("event_quote", keys=True, ordered_files=True),
    }
