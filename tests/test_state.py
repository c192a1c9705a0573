"""State that goes on from micro-batch to micro-batch: versions, the book, corrected windows, sessions."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from fixtures import START, quotes_by_seq, random_messages, replay, wide_row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidequote import L1_SCHEMA, L3_SCHEMA, StreamOptions, l1_windows, run_stream
from tidequote.operators.sessions import l1_sessions
from tidequote.sources.files import read_csv
from tidequote.streaming.continuous_book import continuous_book_sink, level_table, order_table
from tidequote.streaming.corrected import corrected_window_sink, corrected_windows
from tidequote.streaming.sessions import pane_table, session_sink
from tidequote.streaming.versioned import VersionedTable, last_batch, read_progress, write_progress

LONGS = T.StructType([T.StructField(f.name, T.LongType() if f.name.endswith("_size") else f.dataType) for f in L1_SCHEMA])
BOOK = T.StructType([*LONGS.fields, T.StructField("batch_id", T.LongType())])
PAIRS = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def wide(spark, messages, step=timedelta(milliseconds=1)):
    rows = [wide_row(m[0], *m[1:6], START + step * m[0]) for m in messages]
    return spark.createDataFrame(rows, L3_SCHEMA)


def tree(path) -> set:
    return {str(p.relative_to(path)) for p in Path(path).glob("*/*") if p.is_dir()}


def test_versions(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), ("k",), PAIRS, every=3)
    rng, expected = random.Random(1), {}
    for batch in range(11):
        assert {r["k"]: r["v"] for r in table.current(spark, batch).collect()} == expected
        rows = [(k, f"{batch}.{k}" if rng.random() < 0.8 else "gone") for k in [None, *range(6)] if rng.random() < 0.5]
        for _ in range(2):  # a replay leaves the same
            table.write(spark.createDataFrame(rows, PAIRS), batch)
            table.compact(spark, batch, F.col("v") != "gone")
        expected |= dict(rows)
        if (batch + 1) % 3 == 0:
            expected = {k: v for k, v in expected.items() if v != "gone"}
    wanted = spark.createDataFrame([(None,), (2,)], "k long")
    assert {r["k"] for r in table.current(spark, 11, wanted).collect()} == {None, 2} & set(expected)
    # the last base and the deltas since, and one generation before for a replay
    assert tree(tmp_path / "t") == {"base/6", "base/9", *(f"delta/{i}" for i in range(6, 11))}


def test_progress(spark, tmp_path):
    path = str(tmp_path / "p")
    assert read_progress(spark, path, 0) == (None, 0)
    write_progress(spark, path, 0, None, 2)
    write_progress(spark, path, 1, 77, 3)
    assert read_progress(spark, path, 2) == (77, 3) and last_batch(spark, path) == 1
    with pytest.raises(RuntimeError, match="state"):
        read_progress(spark, path, 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_continuous_book_equals_one_long_feed(spark, tmp_path, seed):
    messages = random_messages(random.Random(seed), 260)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sink = continuous_book_sink(out, state, compact_every=2)
    cuts = [0, 70, 71, 140, 200, 260]
    for batch, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = wide(spark, random.Random(batch).sample(messages[a:b], b - a))
        sink(part, batch)
        if batch in (1, 3):
            sink(part, batch)
    assert quotes_by_seq(read_csv(spark, out, BOOK)) == replay(messages, "full_book")


def test_the_book_keeps_only_live_orders_and_late_deletes(spark, tmp_path):
    """Orders come and go for ever; what is kept is bounded."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sink = continuous_book_sink(out, state, forget_after="50 milliseconds", compact_every=2)
    for batch in range(8):
        rows, seq = [], batch * 100
        for i in range(20):
            order = batch * 1000 + i
            rows.append((seq + 3 * i + 1, "add", order, "BUY" if i % 2 else "SELL", 90.0 + i % 2 * -5 + 10, 5))
            rows.append((seq + 3 * i + 2, "trade" if i % 3 == 0 else "delete", order, None, 1.0, 5))
        rows += [(seq + 90, "add", 10**6 + batch, "BUY", 50.0 + batch, 1), (seq + 91, "add", 10**7, "SELL", 150.0, 1)]
        sink(wide(spark, rows), batch)
    kept = order_table(state, (), 2).current(spark, 8)
    live = kept.where("not gone and left > 0").count()
    # one bid a batch and the one ask; deletes of the last batches only, though 104 ids were deleted
    assert live == 9 and kept.where("gone").count() <= 2 * 13 and kept.where("not gone and left = 0").count() <= 2 * 7
    levels = {(r["side"], r["price"]): r["amount"] for r in level_table(state, (), 2).current(spark, 8).where("amount != 0").collect()}
    assert levels == {(1, 50.0 + b): 1 for b in range(8)} | {(-1, 150.0): 1}


def test_a_delete_is_final_until_it_is_forgotten(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sink = continuous_book_sink(out, state, forget_after="100 milliseconds")
    batches = [
        [(1, "add", 1, "BUY", 10.0, 5), (2, "add", 2, "SELL", 20.0, 5), (3, "delete", 1, "BUY", None, None)],
        [(50, "add", 3, "BUY", 8.0, 1), (51, "update", 1, "BUY", 11.0, 5)],
        [(400, "add", 4, "BUY", 9.0, 1)],
        [(401, "update", 1, "BUY", 11.0, 7)],
    ]
    for i, rows in enumerate(batches):
        sink(wide(spark, rows), i)
    got = quotes_by_seq(read_csv(spark, out, BOOK))
    assert got[51][:2] == (8.0, 1) and got[400][:2] == (9.0, 1) and got[401][:2] == (11.0, 7)


def test_late_messages_of_the_book_are_counted(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sink = continuous_book_sink(out, state, drop_later_than="10 milliseconds")
    sink(wide(spark, [(100, "add", 1, "BUY", 10.0, 5), (101, "add", 2, "SELL", 20.0, 5)]), 0)
    sink(wide(spark, [(5, "add", 3, "BUY", 15.0, 5), (95, "add", 4, "BUY", 12.0, 5), (7, "other", None, None, None, None)]), 1)
    assert read_progress(spark, f"{state}/progress", 2)[1] == 2
    assert set(quotes_by_seq(read_csv(spark, out, BOOK))) == {101, 95}


def window_rows(df):
    return sorted(tuple(r) for r in df.select("window_start", "window_end", "bid_price", "ask_price", "bid_size", "ask_size", "n").collect())


CSV_WINDOWS = T.StructType(
    [
        *(T.StructField(f"window_{c}", T.TimestampType()) for c in ("start", "end")),
        *(T.StructField(f"{s}_price", T.DoubleType()) for s in ("bid", "ask")),
        *(T.StructField(f"{s}_size", T.IntegerType()) for s in ("bid", "ask")),
        T.StructField("n", T.LongType()),
    ]
)
WITH_DAY = T.StructType([*CSV_WINDOWS.fields, T.StructField("day", T.DateType())])
WITH_BATCH = T.StructType([*CSV_WINDOWS.fields, T.StructField("batch_id", T.LongType())])


def some_quotes(seed, count, minutes):
    rng = random.Random(seed)
    return [
        wide_row(s, "add", s, rng.choice(["BUY", "SELL"]), float(rng.randint(90, 99)), rng.randint(1, 9), t)
        for s, t in ((s, START + timedelta(seconds=rng.randrange(minutes * 60))) for s in range(1, count + 1))
    ]


@pytest.mark.parametrize("slide", [None, "20 minutes"])
def test_late_rows_correct_their_windows(spark, tmp_path, slide):
    rows = some_quotes(3, 150, 60 * 30)
    rows.append(wide_row(999, "add", 9, "BUY", 99.0, 1, None))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sink = corrected_window_sink(out, state, "1 hour", slide, compact_every=2)
    random.Random(1).shuffle(rows)
    for i in range(5):
        part = spark.createDataFrame(rows[i::5], L3_SCHEMA)
        sink(part, i)
        if i == 2:
            sink(part, i)
    whole = window_rows(l1_windows(spark.createDataFrame(rows, L3_SCHEMA), "1 hour", slide))
    assert window_rows(read_csv(spark, out, WITH_DAY)) == whole
    assert window_rows(corrected_windows(spark, state, compact_every=2)) == whole


def test_only_touched_days_are_written_anew(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sink = corrected_window_sink(out, state, "1 hour", drop_later_than="2 days")
    days = [datetime(2021, 8, d, 12) for d in (3, 4, 5)]
    sink(spark.createDataFrame([wide_row(i, "add", i, "BUY", 9.0, 1, t) for i, t in enumerate(days)], L3_SCHEMA), 0)
    before = {p: p.stat().st_mtime_ns for p in Path(out).glob("day=*/*.csv")}
    late = [wide_row(8, "add", 8, "BUY", 10.0, 2, days[1]), wide_row(9, "add", 9, "BUY", 11.0, 2, datetime(2021, 8, 2))]
    sink(spark.createDataFrame(late, L3_SCHEMA), 1)
    after = {p: p.stat().st_mtime_ns for p in Path(out).glob("day=*/*.csv")}
    assert {p.parent.name for p in before.keys() & after.keys()} == {"day=2021-08-03", "day=2021-08-05"}
    rows = {r["day"].day: (r["bid_price"], r["n"]) for r in read_csv(spark, out, WITH_DAY).collect()}
    assert rows == {3: (9.0, 1), 4: (10.0, 2), 5: (9.0, 1)}
    assert read_progress(spark, f"{state}/progress", 2)[1] == 1


def test_update_mode_leaves_one_row_a_window(spark, tmp_path):
    rows = some_quotes(5, 90, 600)
    opts = StreamOptions(
        str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress"), input_file_format="parquet",
        window="1 hour", output_mode="update", max_files_per_trigger=None,
    )
    for i in range(3):
        spark.createDataFrame(rows[i::3], L3_SCHEMA).write.mode("append").parquet(opts.input_stream_dir)
        run_stream(spark, opts, available_now=True).awaitTermination()
    assert window_rows(read_csv(spark, opts.output_path, WITH_DAY)) == window_rows(
        l1_windows(spark.createDataFrame(rows, L3_SCHEMA), "1 hour")
    )


def test_other_output_modes_are_refused():
    with pytest.raises(ValueError, match="output_mode"):
        StreamOptions("in", "out", "progress", output_mode="complete")


def test_sessions_of_a_stream(spark, tmp_path):
    rows = some_quotes(7, 160, 60 * 20)
    rows.sort(key=lambda r: r[-1])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sink = session_sink(out, state, "10 minutes", "15 minutes", compact_every=2)
    cuts = [0, 40, 41, 90, 130, 160]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = spark.createDataFrame(rows[a:b], L3_SCHEMA)
        sink(part, i)
        if i == 3:
            sink(part, i)
    whole = l1_sessions(spark.createDataFrame(rows, L3_SCHEMA), "10 minutes")
    closed = whole.where(F.col("window_end") < F.lit(rows[-1][-1] - timedelta(minutes=15)))
    assert window_rows(read_csv(spark, out, WITH_BATCH)) == window_rows(closed)
    open_panes = pane_table(state, (), 2).current(spark, 5).where("not done")
    assert open_panes.agg(F.sum("n")).first()[0] == whole.agg(F.sum("n")).first()[0] - closed.agg(F.sum("n")).first()[0]


def test_sessions_drop_and_count_late_rows(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    sink = session_sink(out, state, "1 minute", "2 minutes")
    at = [START + timedelta(minutes=m) for m in (0, 10, 8.5, 7, 20)]
    rows = [wide_row(i, "add", i, "BUY", 9.0 + i, 1, t) for i, t in enumerate(at)]
    for i, part in enumerate((rows[:2], rows[2:4], rows[4:])):
        sink(spark.createDataFrame(part, L3_SCHEMA), i)
    got = [(r["window_start"], r["n"]) for r in read_csv(spark, out, WITH_BATCH).orderBy("window_start").collect()]
    assert got == [(at[0], 1), (at[2], 1), (at[1], 1)]
    assert read_progress(spark, f"{state}/progress", 3)[1] == 1
