"""Embedding near-duplicates by an epsilon grid order join (operator 3).

Directions of cosine ``c`` or more lie within ``epsilon = sqrt(2 - 2c)`` of each other, in all
dimensions and so in the leading principal ones. Vectors are sorted by their epsilon cells there,
and the sequence is cut into blocks. The join descends over intervals of the sequence: two
intervals are split further only while their bounding boxes are within epsilon, and blocks that
are left are compared in full. A task sees two blocks; of each pair of blocks it reports counts
and a spanning forest, not all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidequote.llm.components import components, smallest_reachable
from tidequote.llm.vectors import directions, matrix, vector_rows
from tidequote.sources.landing import land

LEADING = 6
BLOCK = 1024
FAN = 8
ROWS_PER_RANGE = 20_000
AXIS_SAMPLE = 2048


def _axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal axes for each length of vector (few, as a table has few models).

    They are fitted on at most ``AXIS_SAMPLE`` classes of a length, drawn by a hash: distances along any
    orthonormal axes bound distances, so the sample decides what is skipped early and never what is found.
    """
    axes = {}
    for r in rows.select("dim").distinct().collect():
        own = rows.where(F.col("dim") == r["dim"]).select("vector", "norm", "key")
        drawn = own.orderBy(F.xxhash64("key"), "key").limit(AXIS_SAMPLE).collect()
        u = np.stack([np.frombuffer(x["vector"], np.float64) / x["norm"] for x in drawn])
        values, vectors = np.linalg.eigh(np.atleast_2d(np.cov(u, rowvar=False, bias=True)))
        axes[r["dim"]] = vectors[:, np.argsort(values)[::-1][:LEADING]]
    return axes


def _located(classes: DataFrame, axes: dict[int, np.ndarray], epsilon: float) -> DataFrame:
    """Adds ``place``, the leading coordinates, and ``cell``, their epsilon grid cells."""
    shared = classes.sparkSession.sparkContext.broadcast(axes)
    names = classes.columns

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            place = np.zeros((batch.num_rows, LEADING))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                raw = batch.column("vector").take(pa.array(own))
                u = directions(matrix(raw, dim), batch.column("norm").to_numpy()[own])
                axis = shared.value[dim]
                place[own, : axis.shape[1]] = u @ axis
            cell = np.floor(place / epsilon).astype(np.int32)
            at = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * LEADING)
            places = pa.ListArray.from_arrays(at, pa.array(place.ravel()))
            cells = pa.ListArray.from_arrays(at, pa.array(cell.ravel()))
            yield pa.record_batch([*batch.columns, places, cells], names=[*names, "place", "cell"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(locate, schema + ", place array<double>, cell array<int>")


def _blocks(located: DataFrame, rows: int) -> DataFrame:
    """The rows in grid order, cut into blocks: adds ``part`` and ``block`` within it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, number, filled = None, -1, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            blocks = []
            for of in zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True):
                if of != last or filled == BLOCK:
                    last, number, filled = of, number + 1, 0
                filled += 1
                blocks.append(number)
            parts = pa.array([part] * batch.num_rows, pa.int32())
            yield pa.record_batch([*batch.columns, parts, pa.array(blocks, pa.int32())], names=[*names, "part", "block"])

    ranges = max(1, -(-rows // ROWS_PER_RANGE))
    order = ["label", "dim", "cell", "rep"]
    dealt = located.repartitionByRange(ranges, *order).sortWithinPartitions(*order).drop("cell")
    names = dealt.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return dealt.mapInArrow(cut, schema + ", part int, block int")


def _box(side: str, agg) -> Column:
    return F.array(*[agg(F.col(side)[k]) for k in range(LEADING)]).alias(side)


def _near(a: str, b: str, epsilon: float) -> Column:
    """Bounding boxes of two intervals are within epsilon."""
    gaps = [
        F.greatest(
            F.lit(0.0), F.col(f"{a}_low")[k] - F.col(f"{b}_high")[k], F.col(f"{b}_low")[k] - F.col(f"{a}_high")[k]
        )
        for k in range(LEADING)
    ]
    return sum((g * g for g in gaps), F.lit(0.0)) <= epsilon**2 + 1e-9


def _side(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(c if c in ("label", "dim") else f"{name}_{c}") for c in nodes.columns])


def _block_pairs(sequence: DataFrame, epsilon: float) -> DataFrame:
    """(label, dim, a, b): pairs of blocks, by number in the sequence, that may hold links."""
    low = F.col("place").alias("low")
    rows = sequence.select("label", "dim", "number", low, F.col("place").alias("high"))
    nodes = [land(rows.groupBy("label", "dim", "number").agg(_box("low", F.min), _box("high", F.max)), "nodes")]
    most = nodes[0].agg(F.max("number")).first()[0] or 0
    while most >= FAN:
        up = nodes[-1].withColumn("number", F.floor(F.col("number") / FAN))
        nodes.append(up.groupBy("label", "dim", "number").agg(_box("low", F.min), _box("high", F.max)))
        most //= FAN
    # the top intervals of a label are fewer than FAN
    pairs = _side(nodes[-1], "a").join(_side(nodes[-1], "b"), ["label", "dim"])
    pairs = pairs.where((F.col("a_number") <= F.col("b_number")) & _near("a", "b", epsilon))
    for level in reversed(nodes[:-1]):
        pairs = land(pairs.select("label", "dim", F.col("a_number").alias("up_a"), F.col("b_number").alias("up_b")), "pairs")
        for side in "ab":
            below = _side(level, side).withColumn(f"up_{side}", F.floor(F.col(f"{side}_number") / FAN))
            pairs = pairs.join(below, ["label", "dim", f"up_{side}"])
        pairs = pairs.where((F.col("a_number") <= F.col("b_number")) & _near("a", "b", epsilon))
    return pairs.select("label", "dim", F.col("a_number").alias("a"), F.col("b_number").alias("b"))


def _compared(sequence: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """(rep, links, to): links found of a class between two blocks, or a link of the forest."""

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        dim, a, b = (key[k].as_py() for k in (1, 2, 3))
        rep, size, number = (group.column(c).to_numpy() for c in ("rep", "size", "number"))
        x = matrix(group.column("vector"), dim)
        norm = group.column("norm").to_numpy()
        u = directions(x, norm)
        i, j = np.flatnonzero(number == a), np.flatnonzero(number == b)
        near = u[i] @ u[j].T
        linked = near >= cosine
        for p, q in zip(*np.nonzero(np.abs(near - cosine) < 1e-12), strict=True):
            linked[p, q] = np.dot(x[i[p]], x[j[q]]) / (norm[i[p]] * norm[j[q]]) >= cosine
        if a == b:
            np.fill_diagonal(linked, False)
            linked |= linked.T
        ids, counts = [rep[i]], [linked @ size[j]]
        if a != b:
            ids.append(rep[j])
            counts.append(linked.T @ size[i])
        p, q = np.nonzero(linked)
        v, root = smallest_reachable(rep[i][p], rep[j][q]) if len(p) else (rep[:0], rep[:0])
        v, root = v[v != root], root[v != root]
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        ids, counts = ids[counts > 0], counts[counts > 0]
        return pa.table(
            {
                "rep": np.concatenate([ids, v]).astype(np.int64),
                "links": np.concatenate([counts, np.zeros(len(v), np.int64)]).astype(np.int64),
                "to": pa.array([None] * len(ids) + root.tolist(), pa.int64()),
            }
        )

    ends = pairs.withColumn("number", F.explode(F.array_distinct(F.array("a", "b"))))
    rows = sequence.select("label", "dim", "number", "rep", "size", "vector", "norm")
    dealt = ends.join(rows, ["label", "dim", "number"])
    return dealt.groupBy("label", "dim", "a", "b").applyInArrow(compare, "rep long, links long, `to` long")


def near_vectors(
    table: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Rows of one label (not null) and one length of vector are linked when their cosine in double
    precision is at least ``cosine``. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable. Rows without a label or whose vector is null,
    zero or not finite throughout link with nothing and are their own component; a null id gives
    a null component and is kept. Repeated rows link with each other, and where an id has several vectors
    each row has the links of its own. Equal vectors are compared
    once, as a class. An empty table gives an empty result; other columns are not read.
    """
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    epsilon = float(np.sqrt(2 - 2 * cosine))
    every = land(vector_rows(table, id_col, vector_col, F.col(label_col)), "vectors")
    usable = every.where("vector is not null and label is not null and vec_id is not null")
    classes = usable.groupBy("label", "dim", "key").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("size"), F.first("vector").alias("vector"), F.first("norm").alias("norm")
    )
    # classes have numbers, as vectors of one id may be in several; the numbers hold once they are written
    classes = land(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    members = land(_blocks(_located(classes.drop("low"), _axes(classes), epsilon), classes.count()), "blocks")
    numbers = members.select("label", "dim", "part", "block").distinct()
    by_order = W.partitionBy("label", "dim").orderBy("part", "block")
    numbers = numbers.withColumn("number", F.row_number().over(by_order) - 1)
    sequence = members.join(numbers, ["label", "dim", "part", "block"])
    found = land(_compared(sequence, _block_pairs(sequence, epsilon), cosine), "links")
    counts = found.where("`to` is null").groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.where("`to` is not null").select("rep", "to"))
    of_class = classes.join(counts, "rep", "left").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    of_class = of_class.withColumn("component", F.coalesce("component_id", "rep"))
    of_class = land(of_class.select("label", "dim", "key", "size", "links", "low", "component"), "linked-classes")
    lowest = of_class.groupBy("component").agg(F.min("low").alias("root"))
    of_class = of_class.join(lowest, "component").select(
        "label", "dim", "key", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "root"
    )
    key = F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")
    own = every.select("vec_id", "label", "dim", key).join(of_class, ["label", "dim", "key"], "left")
    component = F.coalesce("root", "vec_id")
    return own.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
