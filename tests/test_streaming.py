import os
import time
from datetime import datetime
from pathlib import Path

import pytest
from fixtures import EDGE_QUOTES, SAMPLE_QUOTES, SEQ, edge_l3, quotes_by_seq, sample_csv, sample_l3
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidequote import L1_SCHEMA, L3_SCHEMA, BatchOptions, StreamOptions, run_batch, run_stream
from tidequote.sinks.files import write_csv
from tidequote.sources.files import read_csv, read_file_stream
from tidequote.sources.landing import shared_dir
from tidequote.streaming.continuous import continuous_sink, late_rows
from tidequote.streaming.windowed import windowed_stream

# (seq, side, price, qty, time) per file
LATE_FILES = [
    [(1, "BUY", 10.0, 5, "01:00:01"), (2, "SELL", 12.0, 5, "01:00:02")],
    [(3, "BUY", 11.0, 5, "02:00:01")],
    [(7, "BUY", 9.0, 5, "02:00:02")],
    [(4, "BUY", 11.5, 5, "01:00:03"), (5, "SELL", 11.8, 1, "01:59:00")],
    [(6, "SELL", 11.7, 1, "03:00:00")],
]
BATCHED = T.StructType([*L1_SCHEMA.fields, T.StructField("batch_id", T.LongType())])


def write_feed(path: Path, files) -> str:
    """One file per list of adds, oldest first."""
    path.mkdir()
    for i, rows in enumerate(files):
        lines = [",".join(L3_SCHEMA.names)]
        lines += [f"{s},{s},{side},{p},{q}{',' * 11}2021-08-03 {t} UTC" for s, side, p, q, t in rows]
        file = path / f"f{i}.csv"
        file.write_text("\n".join(lines) + "\n")
        stamp = time.time() - 1000 + i * 10
        os.utime(file, (stamp, stamp))
    return str(path)


def options(tmp_path, source, **more) -> StreamOptions:
    return StreamOptions(source, str(tmp_path / "out"), str(tmp_path / "progress"), **more)


def finish(spark, opts):
    query = run_stream(spark, opts, available_now=True)
    query.awaitTermination()
    return query


def output(spark, opts):
    return read_csv(spark, opts.output_path, BATCHED)


def test_each_batch_starts_empty(spark, tmp_path):
    opts = options(tmp_path, write_feed(tmp_path / "in", LATE_FILES))
    finish(spark, opts)
    got = output(spark, opts)
    assert quotes_by_seq(got) == {2: (10.0, 5, 12.0, 5), 5: (11.5, 5, 11.8, 1)}
    assert {r["seq_num"]: r["batch_id"] for r in got.collect()} == {2: 0, 5: 3}


def test_one_batch_of_several_files(spark, tmp_path):
    opts = options(tmp_path, write_feed(tmp_path / "in", LATE_FILES), max_files_per_trigger=None)
    finish(spark, opts)
    assert set(quotes_by_seq(output(spark, opts))) == {2, 3, 4, 5, 6, 7}


CARRIED = {
    2: (10.0, 5, 12.0, 5),
    3: (11.0, 5, 12.0, 5),
    7: (11.0, 5, 12.0, 5),
    4: (11.5, 5, 12.0, 5),
    5: (11.5, 5, 11.8, 1),
    6: (11.5, 5, 11.7, 1),
}


def test_continuous(spark, tmp_path):
    opts = options(tmp_path, write_feed(tmp_path / "in", LATE_FILES), continuous=True)
    finish(spark, opts)
    assert quotes_by_seq(output(spark, opts)) == CARRIED
    assert sorted(p.name for p in Path(opts.checkpoint_dir, "quote_state").iterdir()) == [
        "slot=0",
        "slot=1",
    ]


def test_continuous_drops_late_messages_on_request(spark, tmp_path):
    source = write_feed(tmp_path / "in", LATE_FILES)
    opts = options(tmp_path, source, continuous=True, drop_late=True)
    finish(spark, opts)
    assert quotes_by_seq(output(spark, opts)) == {
        2: (10.0, 5, 12.0, 5),
        3: (11.0, 5, 12.0, 5),
        7: (11.0, 5, 12.0, 5),
        5: (11.0, 5, 11.8, 1),
        6: (11.0, 5, 11.7, 1),
    }


def test_restart_goes_on_and_adds_nothing_twice(spark, tmp_path):
    source = write_feed(tmp_path / "in", LATE_FILES[:2])
    opts = options(tmp_path, source, continuous=True)
    finish(spark, opts)
    finish(spark, opts)
    assert set(quotes_by_seq(output(spark, opts))) == {2, 3}
    rest = Path(write_feed(tmp_path / "rest", LATE_FILES[2:]))
    for i, file in enumerate(sorted(rest.iterdir())):
        (Path(source) / f"g{i}.csv").write_bytes(file.read_bytes())
        finish(spark, opts)
    assert quotes_by_seq(output(spark, opts)) == CARRIED


def test_replayed_batch_leaves_the_same(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sink = continuous_sink(out, state)
    feed = sample_l3(spark)
    parts = [feed.where(F.col("seq_num") <= SEQ + 174), feed.where(F.col("seq_num") > SEQ + 174)]
    for batch_id in (0, 1, 1):
        sink(parts[batch_id], batch_id)
    assert quotes_by_seq(read_csv(spark, out, BATCHED), SEQ) == SAMPLE_QUOTES["best_quote"]
    with pytest.raises(RuntimeError, match="state"):
        sink(parts[1], 3)


@pytest.mark.parametrize("mode", ["best_quote", "event_quote"])
def test_continuous_equals_batch_when_files_come_in_order(spark, tmp_path, mode):
    source = tmp_path / "in"
    for lo, hi in ((0, 4), (5, 5), (6, 9), (10, 13)):
        edge_l3(spark).where(F.col("seq_num").between(lo, hi)).coalesce(1).write.mode(
            "append"
        ).parquet(str(source))
        time.sleep(1.1)
    opts = options(
        tmp_path, str(source), continuous=True, mode=mode, input_file_format="parquet"
    )
    finish(spark, opts)
    assert quotes_by_seq(output(spark, opts)) == EDGE_QUOTES[mode]


def test_modes_without_a_carried_state_are_refused(tmp_path):
    with pytest.raises(ValueError, match="full_book"):
        continuous_sink(str(tmp_path / "out"), str(tmp_path / "state"), mode="full_book")


def test_continuous_full_book(spark, tmp_path):
    """The job carries the book on from batch to batch, also when it starts anew between them."""
    source = tmp_path / "in"
    opts = options(tmp_path, str(source), continuous=True, mode="full_book", input_file_format="parquet", max_files_per_trigger=None)
    for lo, hi in ((0, 4), (5, 9), (10, 13)):
        part = edge_l3(spark).where(F.col("seq_num").between(lo, hi))
        part.coalesce(1).write.mode("append").parquet(str(source))
        finish(spark, opts)
    assert quotes_by_seq(output(spark, opts)) == EDGE_QUOTES["full_book"]


def test_windows_drop_late_rows_and_wait_for_the_watermark(spark, tmp_path):
    source = write_feed(tmp_path / "in", LATE_FILES)
    stream = read_file_stream(spark, source, L3_SCHEMA, max_files_per_trigger=1)
    assert stream.isStreaming
    query = (
        windowed_stream(stream, "1 minute")
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.window_start, r.bid_price, r.ask_price, r.n) for r in rows] == [
        (datetime(2021, 8, 3, 1, 0), 10.0, 12.0, 2),
        (datetime(2021, 8, 3, 1, 59), None, 11.8, 1),
        (datetime(2021, 8, 3, 2, 0), 11.0, None, 2),
    ]
    dropped = sum(
        s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
    )
    assert dropped == 1


def test_finished_files_are_archived(spark, tmp_path):
    source = write_feed(tmp_path / "in", LATE_FILES)
    opts = options(
        tmp_path,
        source,
        clean_source="archive",
        source_archive_dir=str(tmp_path / "archive"),
        cleanup_delay=1,
        compact_interval=1,
    )
    finish(spark, opts)
    deadline = time.time() + 20
    while len(archived := list((tmp_path / "archive").rglob("f*.csv"))) < 4 and time.time() < deadline:
        time.sleep(0.2)
    assert len(archived) == 4
    assert [p.name for p in Path(source).glob("f*.csv")] == ["f4.csv"]
    assert spark.conf.get("spark.sql.streaming.fileSource.log.compactInterval") != "1"


@pytest.mark.parametrize(
    "wrong",
    [
        {"drop_late": True},
        {"window": "1 hour", "continuous": True},
        {"window": "1 hour", "mode": "full_book"},
        {"slide": "1 minute"},
    ],
)
def test_options_that_exclude_each_other(tmp_path, wrong):
    with pytest.raises(ValueError):
        options(tmp_path, str(tmp_path), **wrong)


def test_files_by_date_have_no_order():
    with pytest.raises(ValueError):
        BatchOptions("in", "out", ordered_files=True, by_date=True)


def test_batches_leave_no_landed_tables(spark, tmp_path):
    area = Path(shared_dir(spark)) / "tidequote"

    def landed():
        return {p for p in area.rglob("*.parquet")} if area.exists() else set()

    before = landed()
    source = write_feed(tmp_path / "in", LATE_FILES)
    finish(spark, options(tmp_path, source, mode="full_book", max_files_per_trigger=2))
    assert len(list((tmp_path / "out").glob("batch_id=*"))) >= 3
    assert landed() <= before


def test_late_rows_are_counted(spark, tmp_path):
    source = write_feed(tmp_path / "in", LATE_FILES)
    opts = options(tmp_path, source, continuous=True, drop_late=True)
    finish(spark, opts)
    assert late_rows(spark, f"{opts.checkpoint_dir}/quote_state") == 1


def test_windowed_job(spark, tmp_path):
    source = write_feed(tmp_path / "in", LATE_FILES)
    opts = options(tmp_path, source, window="1 minute")
    finish(spark, opts)
    files = spark.read.option("header", "true").csv(opts.output_path).where("window_start is not null")
    got = sorted((r.window_start, r.bid_price, r.ask_price, r.n) for r in files.collect())
    assert [(b, a, n) for _, b, a, n in got] == [("10.0", "12.0", "2"), (None, "11.8", "1"), ("11.0", None, "2")]


@pytest.mark.parametrize("mode", list(SAMPLE_QUOTES))
@pytest.mark.parametrize("more", [{}, {"ordered_files": True}, {"by_date": True}])
def test_batch_job(spark, tmp_path, mode, more):
    opts = BatchOptions(
        sample_csv(tmp_path / "l3.csv"), str(tmp_path / "out"), output_delimiter=";", mode=mode, **more
    )
    report = run_batch(spark, opts)
    assert report.rows == len(SAMPLE_QUOTES[mode]) and report.partitions == 1
    got = read_csv(spark, opts.output_path, L1_SCHEMA, ";")
    assert quotes_by_seq(got, SEQ) == SAMPLE_QUOTES[mode]


def test_batch_job_with_keys(spark, tmp_path):
    both = sample_l3(spark).withColumn("venue", F.explode(F.array(F.lit("A"), F.lit("B"))))
    write_csv(both, str(tmp_path / "in"), 2)
    key = T.StructField("venue", T.StringType())
    opts = BatchOptions(str(tmp_path / "in"), str(tmp_path / "out"), key_fields=[key])
    assert run_batch(spark, opts).rows == 12
    got = read_csv(spark, opts.output_path, T.StructType([key, *L1_SCHEMA.fields]))
    for venue in "AB":
        assert quotes_by_seq(got.where(F.col("venue") == venue), SEQ) == SAMPLE_QUOTES["best_quote"]
