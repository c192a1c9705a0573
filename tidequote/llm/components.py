"""Connected components of links, without gathering links anywhere.

Each round deals the links by their larger end, joins what meets in a partition into stars around
the smallest member, and goes on until every vertex has one parent. A vertex that is the small
end of many links is never a key here, so big components are no hot groups. Then parents are
doubled until they are roots. Every round is written to the shared folder, from the first on by as
many tasks as its rows call for: a round of few rows is no file for each shuffle partition. So is the
first round of links that are landed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidequote.sources.landing import land

ROWS_PER_TASK = 1 << 18


def smallest_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, the smallest vertex each is linked to, itself included)."""
    vertices, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(vertices))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while not np.array_equal(root, up := root[root]):
            root = up
        if np.array_equal(root, before):
            return vertices, vertices[root]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if parts:
        v, root = smallest_reachable(*(np.concatenate(p) for p in zip(*parts, strict=True)))
        far = v != root
        yield pa.record_batch([pa.array(v[far]), pa.array(root[far])], names=["v", "m"])


def _tasks(rows: DataFrame) -> int:
    return max(1, -(-rows.count() // ROWS_PER_TASK))


def components(links: DataFrame, landed: bool = False) -> DataFrame:
    """(id, component_id) of every vertex of ``links`` (two long columns) that is not a root.

    ``component_id`` is the smallest id reachable. Links with a null end and loops say nothing.
    Links that are ``landed`` are counted first, as they are cheap to read twice.
    """
    a, b = (F.col(f"`{c}`").cast("long") for c in links.columns[:2])
    edges = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m"), a.alias("a"), b.alias("b"))
    edges = edges.where("a is not null and b is not null and v != m").select("v", "m")
    dealt = edges.repartition("v")
    if landed:
        dealt = dealt.coalesce(_tasks(edges))
    while True:
        stars = land(dealt.mapInArrow(_stars, "v long, m long"), "stars")
        tasks = _tasks(stars)
        parents = stars.groupBy("v").agg(F.min("m").alias("m"), F.max("m").alias("other")).coalesce(tasks)
        if parents.where("m != other").isEmpty():
            break
        dealt = stars.repartition("v").coalesce(tasks)
    parents = land(parents.select("v", "m"), "parents")
    while True:
        up = parents.select(F.col("v").alias("m"), F.col("m").alias("top"))
        raised = parents.join(up, "m", "left")
        if raised.where("top is not null").isEmpty():
            break
        parents = land(raised.select("v", F.coalesce("top", "m").alias("m")).coalesce(tasks), "parents")
    return parents.select(F.col("v").alias("id"), F.col("m").alias("component_id"))
