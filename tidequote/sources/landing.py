"""Tables written once to shared storage, so that several passes read them cheaply."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_area: ContextVar[str | None] = ContextVar("landing_area", default=None)
_local_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dir:
        _local_dir[app] = tempfile.mkdtemp(prefix="tidequote-")
    return _local_dir[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    root = _area.get() or f"{shared_dir(spark)}/tidequote"
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextmanager
def landing_area(spark: SparkSession) -> Iterator[str]:
    """Tables landed inside the block are removed when it ends."""
    root = fresh_path(spark, "run")
    token = _area.set(root)
    try:
        yield root
    finally:
        _area.reset(token)
        remove(spark, root)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is; the one place that needs the JVM's file systems."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Unlike a recomputed plan it is scanned with column pruning, counted from file footers,
    and survives the loss of any executor. The table belongs to the ``landing_area`` around the
    call; outside of one it stays until the owner of the folder removes it.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_measured(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``land`` that also returns aggregates taken while the rows are written."""
    seen = Observation()
    landed = land(df.observe(seen, *[m.alias(k) for k, m in metrics.items()]), name)
    return landed, seen.get
