import gzip
import hashlib
from collections import Counter
from io import BytesIO
from itertools import accumulate

import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tidequote.llm import warc
from tidequote.llm.warc import LoserTree, archive_pages, parse_record, read_members, record_bytes, url_key
from tidequote.sources.landing import fresh_path, land

BIG = "<html>" + "é" * 100 + "</html>"
PAGES = [
    (1, "http://www.A.example/x", BIG),
    (3, "https://a.example:443/X?q=1#f", BIG),
    (2, "http://a.example/x", "short"),
    (5, "http://b.example:8080", "short"),
    (4, None, None),
    (6, "", ""),
    (7, "not a url\r\nInjected: yes", "x" * 99),
    (8, "ftp://user:pw@c.example/", "x" * 99),
    (9, "http://c.example/", "x" * 100),
    (10, "http://c.example/", "x" * 100),
    (10, "http://c.example/", "x" * 100),
    (None, "http://d.example/", BIG),
    (None, None, None),
    (11, "http://e.example/long", "0123456789" * 300_000),
    (12, "http://e.example/crlf", "a\r\n\r\nWARC/1.1\r\n\r\n" * 30),
]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20)), max_size=9))
def test_loser_tree(runs):
    merged = list(LoserTree([iter(sorted(r)) for r in runs]))
    assert merged == sorted(x for r in runs for x in r)


def test_url_keys():
    assert url_key("http://www.Sub.Example.COM:80/A/b?c#d") == "com,example,sub)/a/b?c"
    assert url_key("https://example.com:8443") == "com,example:8443)/"
    assert url_key(None) == url_key("") == ""


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=300), st.text(max_size=40) | st.none(), st.integers(0, 2**62) | st.none())
def test_records_return(html, url, page):
    html = html.encode("utf-8", "ignore").decode()
    digest = hashlib.sha256(html.encode()).hexdigest()
    row = parse_record(record_bytes(page, url, html, digest, None))
    assert (row["page_id"], row["payload_bytes"], row["payload_digest"]) == (page, len(html.encode()), digest)
    again = parse_record(record_bytes(page, url, html, digest, 7))
    assert (again["record_type"], again["refers_to"], again["payload_bytes"]) == ("revisit", 7, len(html.encode()))


def test_damage_is_found():
    raw = record_bytes(1, "u", "payload", hashlib.sha256(b"payload").hexdigest(), None)
    with pytest.raises(ValueError, match="damaged"):
        parse_record(raw.replace(b"payload\r\n", b"Payload\r\n"))
    packed = gzip.compress(raw)
    with pytest.raises(ValueError, match="truncated"):
        list(read_members(BytesIO(packed[:-4])))


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_members(step):
    parts = [b"a" * 1000, b"", b"bc" * 77]
    packed = [gzip.compress(p) for p in parts]
    found = list(read_members(BytesIO(b"".join(packed)), step))
    assert [c for _, _, c in found] == parts
    assert [n for _, n, _ in found] == list(map(len, packed))


def _want(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            first[data] = min(first.get(data, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        owner = first.get(data)
        again = owner is not None and (page is None or page > owner)
        kind = "revisit" if again else "response"
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), kind, owner if again else None))
    return Counter(out)


def _got(frame):
    return Counter(tuple(r[:5]) for r in frame.collect())


@pytest.mark.parametrize("archive_bytes", [1, 64 << 20])
def test_round_trip(spark, monkeypatch, archive_bytes):
    monkeypatch.setattr(warc, "ROWS_PER_RANGE", 4)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as file", "2 as payload_digest")
    got = archive_pages(pages, archive_bytes).cache()
    assert _got(got) == _want(PAGES)
    rows = got.orderBy("range_id", "range_pos").collect()
    keys = [(r.url_key, r.captured_at) for r in rows]
    assert keys == sorted(keys)
    assert max(r.range_id for r in rows) > 0
    files, _ = pafs.FileSystem.from_uri(rows[0].file)
    for r in rows:
        with files.open_input_file(r.file) as stream:
            raw = gzip.decompress(stream.read_at(r.record_length, r.record_offset))
        row = parse_record(raw)
        assert (row["page_id"], row["record_type"], row["url_key"]) == (r.page_id, r.record_type, r.url_key)


def test_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    again = pages.unionByName(pages.selectExpr("page_id + 100000 as page_id", "url", "html")).unionByName(pages.limit(3))
    rows = [tuple(r) for r in again.select("page_id", "url", "html").collect()]
    assert _got(archive_pages(again)) == _want(rows)


def test_no_pages(spark):
    assert archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_archives_are_read_by_many_tasks(spark):
    """Adaptive execution must not coalesce the few short file names into one task."""
    rows = [(i, f"http://h{i % 7}.org/{i}", f"page {i} " * 40) for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    folder = fresh_path(spark, "many")
    files, root = pafs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    archives = land(warc.write_archives(warc.with_record_types(pages), folder, 2000), "archives")
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true" and archives.count() > 6
    tasks = warc.read_runs(archives, folder).withColumn("task", F.spark_partition_id())
    files = tasks.groupBy("task").agg(F.count_distinct("file").alias("n")).collect()
    assert len(files) >= archives.count() // 2 and sum(r["n"] for r in files) == archives.count()


@pytest.mark.parametrize(("step", "bite"), [(7, 3), (1 << 20, 16), (100, 1 << 14)])
def test_members_in_small_bites(step, bite):
    contents = [b"", b"a", b"xyz" * 500, b"end"]
    raw = [gzip.compress(c) for c in contents]
    got = list(read_members(BytesIO(b"".join(raw)), step, bite))
    ends = list(accumulate(map(len, raw), initial=0))
    assert got == [(a, b - a, c) for a, b, c in zip(ends, ends[1:], contents)]
    with pytest.raises(ValueError, match="truncated"):
        list(read_members(BytesIO(raw[2][:-4]), step, bite))


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_archives_follow_pages_not_shuffle_partitions(spark, broadcast):
    """Pages are written by the tasks that read them: not a file, with processes to set its mode, for each shuffle partition."""
    held = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": broadcast,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": broadcast,
    }
    rows = [(i, f"http://h{i % 7}.org/{i}", f"page {i // 2 % 90} " * 30) for i in range(400)] + PAGES
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = archive_pages(pages).cache()
        assert _got(got) == _want(rows)
        if broadcast != "-1":
            assert got.select("file").distinct().count() <= 3
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_whole_pages_come_in_small_batches(spark, monkeypatch):
    seen, wanted = {}, ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
    own = [spark.conf.get(k) for k in wanted]

    def landed(df, name):
        seen[name] = [int(spark.conf.get(k)) for k in wanted]
        return land(df, name)

    monkeypatch.setattr(warc, "land", landed)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert _got(archive_pages(pages)) == _want(PAGES)
    assert max(seen["repeated"] + seen["archives"]) <= 256
    assert [spark.conf.get(k) for k in wanted] == own
