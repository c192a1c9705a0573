"""WARC archives of pages, and their index by merging sorted runs (operator 4).

Tasks write gzipped WARC files to the shared folder and return what they wrote; a file counts
only once Spark has committed its rows, so a repeated task leaves an unused file and nothing
else. Reading back gives one index run per file, sorted by URL key and time. Runs are cut into
key ranges by a shuffle; a task merges the slices of its range with a loser tree. Ranges in order
hold the capture histories of all URLs in order; an URL with many captures spans ranges.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidequote.sources.files import stream_settings
from tidequote.sources.landing import fresh_path, land

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
ROWS_PER_RANGE = 50_000
MAX_READ_TASKS = 1 << 15
# whole pages are read, and sent to Python, so many at once (Spark's own: 4,096 and 10,000), from files by so many
# bytes (8 MB): arrays of many megabytes make an executor's heap grow far beyond what it holds
PAGE_BATCHES = {
    "spark.sql.parquet.columnarReaderBatchSize": "256",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "parquet.read.allocation.size": str(1 << 18),
}
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=UTC)

_URL = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^#]*)", re.IGNORECASE)


def url_key(url: str | None) -> str:
    """Sort key: host labels from the last to the first, then path and query, in lower case."""
    if not url:
        return ""
    m = _URL.match(url)
    if not m:
        return url.lower()
    host = ",".join(reversed(m[1].lower().removeprefix("www.").rstrip(".").split(".")))
    port = f":{m[2]}" if m[2] and m[2] not in ("80", "443") else ""
    return f"{host}{port}){(m[3] or '/').lower()}"


def record_bytes(page_id, url, html: str, digest: str, refers_to) -> bytes:
    """One WARC record. A revisit (``refers_to`` given) keeps the HTTP header but no payload."""
    payload = html.encode("utf-8", "surrogatepass")
    when = FIRST_CAPTURE + timedelta(seconds=int(page_id or 0) % (1 << 32))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", "", url))
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page_of(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def parse_record(raw: bytes) -> dict:
    """The index row of a record; the digest of a payload that is present is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page_of(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
        "url_key": url_key(fields.get("WARC-Target-URI")),
        "captured_at": fields["WARC-Date"],
    }


def read_members(stream, step: int = 1 << 20, bite: int = 1 << 14) -> Iterator[tuple[int, int, bytes]]:
    """(offset, compressed length, content) of each gzip member, reading ``step`` bytes at a time.

    A member gets ``bite`` bytes at once, so what it leaves to the next one is copied in small pieces.
    """
    offset, buffer, at = 0, b"", 0
    while True:
        member, parts, used = zlib.decompressobj(31), [], 0
        while not member.eof:
            if at == len(buffer):
                buffer, at = stream.read(step), 0
                if not buffer:
                    if used:
                        raise ValueError("truncated archive")
                    return
            piece = memoryview(buffer)[at : at + bite]
            parts.append(member.decompress(piece))
            taken = len(piece) - len(member.unused_data)
            at, used = at + taken, used + taken
        yield offset, used, b"".join(parts)
        offset += used


class LoserTree:
    """k-way merge: inner nodes hold the losers of their matches, so a pop replays one path."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        k = len(runs)
        self.losers = [-1] * max(k, 1)
        winners = [-1] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._first(a, b) else (b, a)
        self.winner = winners[1] if k > 1 else 0 if k else -1

    def _first(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return x < y or (x == y and a < b)

    def __iter__(self):
        k = len(self.runs)
        while k and (top := self.heads[self.winner]) is not None:
            yield top
            at = self.winner
            self.heads[at] = next(self.runs[at], None)
            node = (at + k) // 2
            while node:
                if self._first(self.losers[node], at):
                    at, self.losers[node] = self.losers[node], at
                node //= 2
            self.winner = at


def with_record_types(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_digest, refers_to): refers_to is null for responses.

    What repeats is landed, so that Spark knows its size before the join: unless that is large, pages
    are not shuffled, and are written by the tasks that read them, however many the shuffle's would be.
    """
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("payload_digest", F.sha2("html", 256))
    large = own.where(F.octet_length("html") >= MIN_REVISIT_BYTES)
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    first = land(first.where("n > 1").drop("n"), "repeated")
    again = F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id"))
    refers_to = F.when(again, F.col("first_id"))
    return own.join(first, "payload_digest", "left").withColumn("refers_to", refers_to).drop("first_id")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes WARC files below ``folder``; one row per file: file, n_records, n_bytes."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = pafs.FileSystem.from_uri(folder)
        task, number, done, out = TaskContext.get().taskAttemptId(), 0, [], None
        path, records, size = "", 0, 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in batch.itertuples(index=False):
                if out is None:
                    path, records, size = f"{root}/{task:08d}-{number:05d}.warc.gz", 0, 0
                    out = files.open_output_stream(path, compression=None)
                page = None if pd.isna(page_id) else int(page_id)
                refers = None if pd.isna(refers_to) else int(refers_to)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = packer.compress(record_bytes(page, url, html, digest, refers)) + packer.flush()
                out.write(raw)
                records, size = records + 1, size + len(raw)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, records, size))
                    out, number = None, number + 1
        if out is not None:
            out.close()
            done.append((path, records, size))
        yield pd.DataFrame(done, columns=["file", "n_records", "n_bytes"])

    columns = ["page_id", "url", "html", "payload_digest", "refers_to"]
    # page numbers travel as decimals: pandas would make nullable longs inexact
    own = pages.select(*[F.col(c).cast("string").alias(c) if c in ("page_id", "refers_to") else F.col(c) for c in columns])
    return own.mapInPandas(write, "file string, n_records long, n_bytes long")


INDEX = (
    "url_key string, captured_at string, page_id long, payload_bytes long, payload_digest string,"
    " record_type string, refers_to long, file string, record_offset long, record_length long"
)
_INDEX_COLUMNS = [c.split()[0] for c in INDEX.split(",")]


def read_runs(archives: DataFrame, folder: str) -> DataFrame:
    """The index runs of archives: every record, sorted within its file."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch["file"]:
                rows = []
                with files.open_input_stream(path, compression=None) as stream:
                    for offset, length, raw in read_members(stream):
                        row = parse_record(raw) | {"file": path, "record_offset": offset, "record_length": length}
                        rows.append(row)
                run = pd.DataFrame(rows, columns=_INDEX_COLUMNS, dtype=object)
                yield run.sort_values(["url_key", "captured_at", "record_offset"], kind="stable")

    # about one file a task, as archives are of one size; a given number is not coalesced, which a repartition
    # by the short names alone would be, down to one task
    tasks = min(MAX_READ_TASKS, max(1, archives.count()))
    return archives.select("file").repartitionByRange(tasks, "file").mapInPandas(read, INDEX)


def merge_runs(runs: DataFrame, rows: int) -> DataFrame:
    """All index rows with ``range_id`` and ``range_pos``, their place in the global order."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices = [b for b in batches if len(b)]
        if not slices:
            return
        rows = pd.concat(slices, ignore_index=True)
        keys = list(zip(rows["url_key"], rows["captured_at"], rows["file"], rows["record_offset"], strict=True))
        cuts = [0, *rows.index[rows["file"].ne(rows["file"].shift())][1:], len(rows)]
        spans = zip(cuts, cuts[1:], strict=False)
        tree = LoserTree([zip(keys[a:b], range(a, b), strict=True) for a, b in spans])
        merged = rows.iloc[[at for _, at in tree]].reset_index(drop=True)
        merged["range_id"] = TaskContext.get().partitionId()
        merged["range_pos"] = merged.index
        yield merged

    text = [F.col(c).cast("string").alias(c) if c in ("page_id", "refers_to") else F.col(c) for c in _INDEX_COLUMNS]
    ranges = max(1, -(-rows // ROWS_PER_RANGE))
    dealt = runs.repartitionByRange(ranges, "url_key", "captured_at", "file", "record_offset")
    dealt = dealt.sortWithinPartitions("file", "url_key", "captured_at", "record_offset").select(*text)
    schema = INDEX.replace("page_id long", "page_id string").replace("refers_to long", "refers_to string")
    merged = dealt.mapInPandas(merge, schema + ", range_id int, range_pos long")
    return merged.withColumn("page_id", F.col("page_id").cast("long")).withColumn("refers_to", F.col("refers_to").cast("long"))


def archive_pages(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as WARC files, reads them back, merges the index.

    One row per page, in the global order of (url_key, captured_at): page_id, payload_bytes,
    payload_digest, record_type, refers_to, url_key, captured_at, the record's place (file,
    record_offset, record_length) and its place in the order. Of equal payloads of 100 bytes or
    more the smallest page_id is the response; rows that repeat it are responses too, a null
    page_id revisits it. A null html is an empty payload; a null url has the empty key; an empty
    table gives no archives and no rows; other columns are not read. The capture time, which
    pages do not have, is a fixed day plus page_id seconds. Archives stay in the shared folder.
    """
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    files, root = pafs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    with stream_settings(spark, PAGE_BATCHES):
        archives = land(write_archives(with_record_types(pages), folder, archive_bytes), "archives")
    runs = land(read_runs(archives, folder), "runs")
    merged = merge_runs(runs, runs.count())
    first = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return merged.select(*first, *[c for c in merged.columns if c not in first])
