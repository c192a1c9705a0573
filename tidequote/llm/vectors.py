"""Embedding columns as binary rows of doubles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_rows(table: DataFrame, id_col: str, vector_col: str, label: Column | None = None) -> DataFrame:
    """(vec_id, label, vector, dim, norm, key), one row per row of ``table``.

    ``vector`` holds doubles and ``key`` is a digest of it. They, ``dim`` and ``norm`` are null
    for vectors without a direction: null, empty, zero, or with null or non-finite components.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 becomes 0.0
            size = np.array([n or 0 for n in lists.value_lengths().to_pylist()], np.int64)
            end = np.cumsum(size)
            out: dict[str, list] = {k: [] for k in ("vector", "dim", "norm", "key")}
            for a, b in zip((end - size).tolist(), end.tolist(), strict=True):
                x = flat[a:b]
                largest = np.abs(x).max(initial=0.0)
                norm = float(np.linalg.norm(x / largest) * largest) if np.isfinite(largest) and largest > 0 else 0.0
                usable = 0 < norm < np.inf
                raw = x.tobytes() if usable else None
                out["vector"].append(raw)
                out["dim"].append(b - a if usable else None)
                out["norm"].append(norm if usable else None)
                out["key"].append(hashlib.blake2b(raw, digest_size=16).digest() if usable else None)
            types = (pa.binary(), pa.int32(), pa.float64(), pa.binary())
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.record_batch([batch.column("i"), batch.column("l"), *arrays], names=["vec_id", "label", *out])

    label = F.lit(None) if label is None else label
    own = table.select(
        F.col(id_col).cast("long").alias("i"),
        label.cast("string").alias("l"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    return own.mapInArrow(convert, "vec_id long, label string, vector binary, dim int, norm double, key binary")


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Binary vectors of one length as the rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def directions(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return vectors / norms[:, None]
