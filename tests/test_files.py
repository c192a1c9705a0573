from datetime import date, datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from fixtures import (
    SAMPLE_QUOTES,
    SEQ,
    edge_l3,
    messages_frame,
    quotes_by_seq,
    sample_csv,
    sample_l3,
)
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidequote import L1_SCHEMA, L3_SCHEMA, l3_messages, l3_to_l1
from tidequote.functions.text import partitions_for, row_text, time_text, total_bytes
from tidequote.operators.sizing import output_partitions, output_size, payload_bytes, spread
from tidequote.sinks.files import write_batch_csv, write_by_date, write_csv
from tidequote.sources.files import cast_to, read_csv, read_csv_text
from tidequote.sources import landing
from tidequote.sources.landing import land, land_measured, landing_area, shared_dir

# A file of another layout, as may lie in an input directory: seven columns, the first a number.
OTHER_FILE = """sensor,room,reading,unit,taken,level,note
,cellar,low,C,2020-01-05,7,first
,attic,high,C,2020-02-06,8,second
31,hall,low,F,2020-03-07,9,third
"""


def rows(df):
    return sorted(map(repr, df.collect()))


def test_typed_scan(spark, tmp_path):
    l3 = read_csv(spark, sample_csv(tmp_path / "l3.csv"), L3_SCHEMA, strict_header=True)
    assert l3.schema == L3_SCHEMA
    assert rows(l3) == rows(sample_l3(spark))


def test_text_scan_then_cast(spark, tmp_path):
    text = read_csv_text(spark, sample_csv(tmp_path / "l3.csv"))
    assert {f.dataType for f in text.schema} == {T.StringType()}
    assert rows(cast_to(text, L3_SCHEMA)) == rows(sample_l3(spark))


def test_scan_without_header_and_with_delimiter(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(sample_l3(spark), path, 2, "|", header=False)
    assert rows(read_csv(spark, path, L3_SCHEMA, "|", "false")) == rows(sample_l3(spark))


def test_other_layout_binds_by_position(spark, tmp_path):
    (tmp_path / "other.csv").write_text(OTHER_FILE)
    l3 = read_csv(spark, str(tmp_path / "other.csv"), L3_SCHEMA)
    got = l3.orderBy("update_side").select("seq_num", "add_order_id", "add_side", "update_order_id", "update_side")
    assert [tuple(r) for r in got.collect()] == [
        (None, None, "low", 7, "first"),
        (None, None, "high", 8, "second"),
        (31, None, "low", 9, "third"),
    ]
    for mode in ("best_quote", "event_quote", "full_book"):
        assert l3_to_l1(l3, mode).count() == 0


def test_other_layout_is_refused_when_strict(spark, tmp_path):
    (tmp_path / "other.csv").write_text(OTHER_FILE)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "other.csv"), L3_SCHEMA, strict_header=True).collect()


def test_classification(spark):
    got = {r["seq_num"]: r for r in l3_messages(edge_l3(spark)).collect()}
    actions = {s: r["action"] for s, r in got.items()}
    assert actions == {
        **dict.fromkeys((1, 2, 3, 4, 8, 11), "add"),
        **dict.fromkeys((5, 12), "update"),
        **dict.fromkeys((6, 9), "delete"),
        **dict.fromkeys((7, 13), "trade"),
        10: "other",
    }
    assert (got[6]["order_id"], got[6]["side"], got[6]["price"], got[6]["qty"]) == (3, "BUY", None, None)
    assert got[11]["side"] is None and got[11]["price"] == 99.0


def test_times_keep_microseconds(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(l3_to_l1(sample_l3(spark)), path, 1)
    lines = read_csv_text(spark, path).orderBy("seq_num").collect()
    assert lines[0]["time"] == "2021-08-03 01:00:01.107502 UTC"
    assert lines[2]["time"] == "2021-08-03 01:00:03.22333 UTC"
    back = read_csv(spark, path, L1_SCHEMA, strict_header=True)
    assert quotes_by_seq(back, SEQ) == SAMPLE_QUOTES["best_quote"]
    assert back.agg(F.min("time")).first()[0] == datetime(2021, 8, 3, 1, 0, 1, 107502)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_text_in_every_zone(spark, zone):
    texts = [
        "2021-08-02 22:11:21.94404 UTC",
        "2021-11-07 05:30:00 UTC",
        "2021-11-07 06:30:00 UTC",
        "1969-12-31 23:59:59.999999 UTC",
        "2200-01-01 00:00:00.000001 UTC",
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        assert [r[0] for r in df.select(time_text(F.col("t").cast("timestamp"))).collect()] == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_write_replaces_and_has_n_files(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.range(1000).select(F.col("id").alias("seq_num"))
    write_csv(df, str(path), 3)
    write_csv(df, str(path), 4)
    assert len(list(path.glob("part-*.csv"))) == 4
    assert spark.read.csv(str(path), header=True).count() == 1000


def test_ordered_files(spark, tmp_path):
    path = tmp_path / "out"
    write_csv(spark.range(1000).select(F.col("id").alias("seq_num")), str(path), 4, order_col="seq_num")
    seen = []
    for file in sorted(path.glob("part-*.csv")):
        seen += [int(line) for line in file.read_text().split()[1:]]
    assert seen == list(range(1000))


def test_batch_directories(spark, tmp_path):
    path = str(tmp_path / "out")
    for batch, n in ((0, 5), (1, 7), (1, 6)):
        write_batch_csv(spark.range(n), batch, path, 1)
    got = spark.read.csv(path, header=True).groupBy("batch_id").count().collect()
    assert {r[0]: r[1] for r in got} == {0: 5, 1: 6}


def test_by_date(spark, tmp_path):
    path = tmp_path / "out"
    write_by_date(sample_l3(spark), str(path), 3)
    names = {p.name for p in path.iterdir() if p.is_dir()}
    assert names == {"trade_date=2021-08-02", "trade_date=2021-08-03"}
    got = spark.read.csv(str(path), header=True).groupBy("trade_date").count().collect()
    assert {r[0]: r[1] for r in got} == {date(2021, 8, 2): 2, date(2021, 8, 3): 7}


def test_payload_bytes(spark):
    df = spark.createDataFrame([("abc",), ("äö",), (None,), ("",)], "t string")
    assert payload_bytes(df, "t").first()[0] == 7
    assert payload_bytes(df.where("false"), "t").first()[0] == 0


def test_rendered_size_is_that_of_the_written_lines(spark, tmp_path):
    l3 = sample_l3(spark)
    path = tmp_path / "out"
    write_csv(l3, str(path), 1, header=False)
    written = sum(len(p.read_text().replace("\n", "")) for p in path.glob("part-*.csv"))
    assert output_size(l3, 128).first()["payload_bytes"] == written
    assert l3.agg(total_bytes(row_text(l3))).first()[0] == written


@pytest.mark.parametrize(
    ("payload", "block", "files"),
    [
        (0, 128, 1),
        (128 * 1048576 - 1, 128, 1),
        (256 * 1048576 - 1, 128, 1),
        (256 * 1048576, 128, 2),
        (10**14, 128, 745058),
        (5 * 1048576 + 7, 1, 5),
    ],
)
def test_partition_arithmetic(spark, payload, block, files):
    got = spark.range(1).select(partitions_for(F.lit(payload).cast("long"), block))
    assert got.first()[0] == files


def test_partitions_of_rows(spark):
    df = spark.range(5).select(F.repeat(F.lit("x"), 1048576).alias("t"))
    assert output_partitions(df, 1) == 5
    assert output_partitions(df, 2) == 2
    assert output_partitions(df, 128) == 1
    for bad in (0, -1):
        with pytest.raises(ValueError, match="block_size"):
            output_partitions(df, bad)


def test_spread(spark):
    df = spark.range(100).coalesce(1)
    assert spread(df, 5).rdd.getNumPartitions() == 5
    sizes = spread(df, 5).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 5 and all(18 <= r[1] <= 22 for r in sizes)


def test_landing(spark):
    df = messages_frame(spark, [(1, "add", 1, "BUY", 1.0, 1), (2, "other", None, None, None, None)])
    landed, seen = land_measured(df, "t", rows=F.count("*"), priced=F.count("price"))
    assert seen == {"rows": 2, "priced": 1}
    assert landed.schema == df.schema and rows(landed) == rows(df)
    assert landed.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark))


def test_landing_area_is_removed(spark, tmp_path):
    with landing_area(spark) as root:
        assert land(spark.range(3), "t").count() == 3
        assert list(Path(root).iterdir())
    assert not Path(root).exists()


def _session(master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_one_temporary_folder_in_local_mode(monkeypatch):
    made = []
    monkeypatch.setattr(landing.tempfile, "mkdtemp", lambda prefix: made.append(prefix) or f"/tmp/{prefix}{len(made)}")
    monkeypatch.setattr(landing, "_local_dir", {})
    assert shared_dir(_session("local[4]")) == shared_dir(_session("local")) == shared_dir(_session("local[*]"))
    assert len(made) == 1


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", "spark://host:7077"])
def test_a_cluster_has_to_name_its_shared_folder(master):
    with pytest.raises(RuntimeError):
        shared_dir(_session(master))
