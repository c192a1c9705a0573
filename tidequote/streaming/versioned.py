"""A keyed table that grows by one version per micro-batch.

Every micro-batch adds a delta with the new rows of the keys that it touches. After every ``every``
batches the newest rows are written as a base, so a reader meets at most that many deltas, and what is
no longer wanted goes. Which files a batch reads follows from its number alone, and it
overwrites only its own, so a replayed batch finds what it found before.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidequote.sources.landing import remove

VERSION = "_version"


def same_keys(keys: Sequence[str], other: str = "_right_") -> Column:
    """Null-safe equality of ``keys`` with columns of the same names behind ``other``."""
    return functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in keys])


def matching(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys are in ``wanted``; null keys match."""
    right = wanted.select(*[F.col(k).alias(f"_right_{k}") for k in keys]).distinct()
    return rows.join(right, same_keys(keys), "left_semi")


@dataclass(frozen=True)
class VersionedTable:
    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    every: int = 8

    def _base_of(self, batch_id: int) -> int:
        return batch_id // self.every * self.every

    def _full_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType())])

    def versions(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """All rows that are of interest to batch ``batch_id``: the last base and the deltas since."""
        base = self._base_of(batch_id)
        paths = [f"{self.path}/base/{base}"] if base else []
        paths += [f"{self.path}/delta/{i}" for i in range(base, batch_id)]
        if not paths:
            return spark.createDataFrame([], self._full_schema())
        return spark.read.schema(self._full_schema()).parquet(*paths)

    def newest(self, rows: DataFrame) -> DataFrame:
        """One row per key, that of the last version."""
        values = [c for c in self.schema.names if c not in self.keys]
        last = F.max_by(F.struct(*values), VERSION).alias("_last")
        return rows.groupBy(*self.keys).agg(last, F.max(VERSION).alias(VERSION)).select(*self.keys, "_last.*", VERSION)

    def current(self, spark: SparkSession, batch_id: int, wanted: DataFrame | None = None) -> DataFrame:
        """The newest rows before batch ``batch_id``, only those of the keys in ``wanted`` if given."""
        rows = self.versions(spark, batch_id)
        if wanted is not None:
            rows = matching(rows, wanted, self.keys)
        return self.newest(rows)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        own = rows.select(*self.schema.names).withColumn(VERSION, F.lit(batch_id).cast("long"))
        own.write.mode("overwrite").parquet(f"{self.path}/delta/{batch_id}")

    def compact(self, spark: SparkSession, batch_id: int, keep: Column | None = None) -> None:
        """Behind the last batch of a base: write the next one, and remove what no replay can ask for."""
        after = batch_id + 1
        if after % self.every:
            return
        rows = self.newest(self.versions_upto(spark, batch_id))
        rows = rows if keep is None else rows.where(keep)
        rows.write.mode("overwrite").parquet(f"{self.path}/base/{after}")
        old = after - 2 * self.every
        if old >= 0:
            for name in (f"base/{old}", *(f"delta/{i}" for i in range(old, old + self.every))):
                remove(spark, f"{self.path}/{name}")

    def versions_upto(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """As ``versions``, with the delta of ``batch_id`` itself and the base before it."""
        own = spark.read.schema(self._full_schema()).parquet(f"{self.path}/delta/{batch_id}")
        return self.versions(spark, batch_id).unionByName(own)


PROGRESS = "batch_id long, latest long, late_rows long"


def read_progress(spark: SparkSession, path: str, batch_id: int) -> tuple[int | None, int]:
    """(latest time in microseconds, rows dropped as too late) that the batch before left."""
    if batch_id == 0:
        return None, 0
    row = spark.read.schema(PROGRESS).parquet(f"{path}/slot={(batch_id - 1) % 2}").drop("slot").first()
    if row is None or row["batch_id"] != batch_id - 1:
        raise RuntimeError(f"state in {path} is not that of batch {batch_id - 1}")
    return row["latest"], row["late_rows"]


def write_progress(spark: SparkSession, path: str, batch_id: int, latest: int | None, late_rows: int) -> None:
    row = spark.createDataFrame([(batch_id, latest, late_rows)], PROGRESS)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")


def last_batch(spark: SparkSession, path: str) -> int | None:
    """The last batch whose progress is written."""
    rows = spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(path)
    return rows.agg(F.max("batch_id").alias("n")).first()["n"]
