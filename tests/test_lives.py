"""Lives of orders: nulls, ties, repeats, and endings that arrive before their adds."""

from collections import Counter
from contextlib import nullcontext
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidequote.operators.lives import order_lives
from tidequote.plans import registry
from tidequote.schema import L3_SCHEMA
from tidequote.sources.files import read_file_stream
from tidequote.streaming.lives import life_state, life_stream

START = datetime(2021, 8, 2, 12)


def _row(seq, action, order, minute, qty=5, side="BUY"):
    row = dict.fromkeys(L3_SCHEMA.names)
    row["seq_num"], row["time"] = seq, None if minute is None else START + timedelta(minutes=minute)
    if action:
        row |= {f"{action}_order_id": order, f"{action}_side": side}
        if action != "delete":
            row |= {f"{action}_price": 10.0, f"{action}_qty": qty}
    return tuple(row[n] for n in L3_SCHEMA.names)


MESSAGES = [
    _row(1, "add", 100, 0),
    _row(2, "trade", 100, 5, 2),
    _row(3, "delete", 100, 60),
    _row(4, "delete", 100, 61),  # later than an hour
    _row(5, "add", 101, 1),
    _row(6, "update", 101, 2),
    _row(7, "add", 102, 3),
    _row(8, "trade", 102, 3),  # at the same time, after it
    _row(9, "add", 103, 4),
    _row(9, "delete", 103, 4),  # no greater order value
    _row(10, "add", 104, None),
    _row(11, "add", 105, 5),
    _row(11, "add", 105, 5),
    _row(12, "delete", 105, 6),
    _row(13, "delete", 999, 7),
    _row(14, "delete", 101, None),
    _row(None, "add", 106, 8),
    _row(15, "delete", 106, 9),
    _row(None, None, None, 10),
]
LIVES = [
    (100, 1, "trade", 2, 2),
    (100, 1, "delete", 3, None),
    (101, 5, None, None, None),
    (102, 7, "trade", 8, 5),
    (103, 9, None, None, None),
    (105, 11, "delete", 12, None),
    (105, 11, "delete", 12, None),
    (106, None, None, None, None),
]


def _told(df):
    return Counter((r.order_id, r.opened_seq, r.ended_by, r.ended_seq, r.ended_qty) for r in df.collect())


def test_lives(spark):
    feed = spark.createDataFrame(MESSAGES, L3_SCHEMA)
    assert _told(order_lives(feed)) == Counter(LIVES)
    assert order_lives(feed.limit(0)).collect() == []


def test_keys(spark):
    schema = T.StructType([*L3_SCHEMA.fields, T.StructField("venue", T.StringType())])
    feed = spark.createDataFrame([(*_row(1, "add", 1, 0), k) for k in ("a", "b", None)], schema)
    ends = spark.createDataFrame([(*_row(2, "delete", 1, 1), k) for k in ("b", None)], schema)
    got = order_lives(feed.unionByName(ends), key_cols=["venue"]).collect()
    assert {(r.venue, r.ended_by) for r in got} == {("a", None), ("b", "delete"), (None, "delete")}


@pytest.mark.parametrize("parts", [[MESSAGES], [MESSAGES[1::2], MESSAGES[::2]], [MESSAGES[::2], MESSAGES[1::2]]])
def test_stream_is_the_batch(spark, tmp_path, parts):
    """Within the lateness the order of arrival does not matter; state goes when lives have expired."""
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    kept = []
    for part in [*parts, [_row(None, None, None, 600)], [_row(None, None, None, 601)]]:
        spark.createDataFrame(part, L3_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        query = (
            life_stream(read_file_stream(spark, source, L3_SCHEMA, "parquet"), lateness="2 hours")
            .writeStream.outputMode("append")
            .format("parquet")
            .option("checkpointLocation", str(tmp_path / "progress"))
            .trigger(availableNow=True)
            .start(sink)
        )
        query.awaitTermination()
        kept.append(sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"]))
    assert _told(spark.read.parquet(sink)) == Counter(LIVES)
    assert kept[0] > 0 and kept[-1] == 0


def test_state_of_few_stores(spark, tmp_path, monkeypatch):
    """Stores on disk by the cores, not four in memory for each shuffle partition; the rows stay those of the batch."""
    rows = [(k, f"2021-08-02 12:{k // 60 % 60:02}:{k % 60:02}", k % 5, ("click", "view", "error")[k % 3], k / 7) for k in range(600)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(registry, "fresh_path", lambda _, name: f"{tmp_path}/{name}")
    partitions, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    own = spark.conf.get(partitions)
    spark.conf.set(partitions, str(3 * cores))
    try:
        got = registry.queries()["stream_order_life"](spark, str(tmp_path))
        assert spark.conf.get(partitions) == str(3 * cores)
        assert spark.conf.get("spark.sql.streaming.join.stateFormatVersion") == "2"
    finally:
        spark.conf.set(partitions, own)
    expected = registry.queries()["order_life"](spark, str(tmp_path))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.select(*got.columns).collect()))
    assert got.where("ended_by is not null").count() > 100
    state = tmp_path / "progress/state/0"
    stores = [p for p in state.iterdir() if p.name.isdigit()]
    assert len(stores) == 2 * cores
    assert not [p for s in stores for p in s.iterdir() if p.name.startswith(("left-", "right-"))]


def test_state_on_disk_is_the_batch(spark, tmp_path):
    """Endings before their adds, repeats and keys that are null; a restart outside of the block keeps the stores."""
    schema = T.StructType([*L3_SCHEMA.fields, T.StructField("venue", T.StringType())])
    feed = [(*m, v) for m in MESSAGES for v in ("a", None)]
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    kept = []
    for k, part in enumerate([feed[::-2], feed[-2::-2], [(*_row(None, None, None, 600), None)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        lives = life_stream(read_file_stream(spark, source, schema, "parquet"), lateness="2 hours", key_cols=["venue"])
        with life_state(spark, 3) if k < 2 else nullcontext():
            query = (
                lives.writeStream.outputMode("append")
                .format("parquet")
                .option("checkpointLocation", str(tmp_path / "progress"))
                .trigger(availableNow=True)
                .start(sink)
            )
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numShufflePartitions"])
    told = Counter()
    for r in spark.read.parquet(sink).collect():
        told[r.venue, r.order_id, r.opened_seq, r.ended_by, r.ended_seq, r.ended_qty] += 1
    assert told == Counter((v, *life) for life in LIVES for v in ("a", None))
    assert kept == [3, 3, 3]
