"""CSV scans and file streams."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flag(value: bool | str) -> str:
    return str(value).lower()


def read_csv_text(
    spark: SparkSession, path: str, delimiter: str = ",", header: bool | str = True
) -> DataFrame:
    """Every column as text, named by the header line."""
    return spark.read.option("sep", delimiter).option("header", _flag(header)).csv(path)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to ``schema`` by name; what does not parse becomes null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    delimiter: str = ",",
    header: bool | str = True,
    strict_header: bool = False,
) -> DataFrame:
    """Typed scan; binds by position unless ``strict_header`` makes the names match."""
    reader = spark.read.schema(schema).option("sep", delimiter).option("header", _flag(header))
    if strict_header:
        reader = reader.option("enforceSchema", "false")
    return reader.csv(path)


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "csv",
    header: bool | str = True,
    delimiter: str = ",",
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    source_archive_dir: str | None = None,
) -> DataFrame:
    """File-source stream of any format Spark reads, with intake limit and housekeeping."""
    reader = spark.readStream.format(file_format).schema(schema)
    if file_format == "csv":
        reader = reader.option("header", _flag(header)).option("sep", delimiter)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if clean_source is not None:
        reader = reader.option("cleanSource", clean_source)
    if source_archive_dir is not None:
        reader = reader.option("sourceArchiveDir", source_archive_dir)
    return reader.load(path)


@contextmanager
def stream_settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Session settings for streams started or tables landed inside the block; the session gets its own ones back."""
    own = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in own.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def file_log_settings(
    spark: SparkSession, cleanup_delay: int | None = None, compact_interval: int | None = None
) -> Iterator[None]:
    """Settings of the source's file log, for streams started inside the block.

    ``cleanup_delay`` (milliseconds) and ``compact_interval`` (batches) are session settings in
    Spark; a stream takes them over when it starts, and the session gets its own ones back.
    """
    log = "spark.sql.streaming.fileSource.log"
    wanted = {f"{log}.cleanupDelay": cleanup_delay, f"{log}.compactInterval": compact_interval}
    with stream_settings(spark, {k: str(v) for k, v in wanted.items() if v is not None}):
        yield
