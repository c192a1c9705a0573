"""Approximate nearest neighbours with a hierarchical k-means tree (operator 9).

The tree is fitted on a bounded sample of directions; every row is then sent down it to a leaf.
A query walks the tree best bin first: a priority queue holds the nodes met so far by their
cosine to the query, and popped leaves are visited. How many leaves a query visits is calibrated:
the exact neighbours of some queries are found by comparing them with all rows, and visits widen
until they would have found ``TARGET_RECALL`` of these. Visits are made in two rounds: the few
best leaves of a query give a bound, and from the others only rows that reach it are reported.
Rows of crowded leaves and queries of crowded leaves are dealt over several tasks.

Leaves grow with the square root of the table, so that neither the leaves nor the rows in one
become too many.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidequote.llm.vectors import directions, matrix, vector_rows
from tidequote.sources.landing import land

SAMPLE_ROWS = 20_000
BRANCHES = 8
LEAF_ROWS = 256
ROOTS_PER_LEAF = 4.0
MIN_LEAF_SAMPLE = 8
PROBES = 200
TARGET_RECALL = 0.98
ROWS_PER_TASK = 16_384
QUERIES_PER_TASK = 2048


@dataclass
class Tree:
    """Nodes in arrays; node 0 is the root. ``children`` is empty and ``leaf`` >= 0 for leaves."""

    centers: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, u: np.ndarray) -> np.ndarray:
        """The leaf that each direction reaches by the nearest child at every node."""
        out = np.empty(len(u), np.int64)
        todo = [(0, np.arange(len(u)))]
        while todo:
            node, own = todo.pop()
            below = self.children[node]
            if not len(below):
                out[own] = self.leaf[node]
                continue
            nearest = (u[own] @ self.centers[below].T).argmax(1)
            todo += [(int(below[k]), own[nearest == k]) for k in range(len(below)) if (nearest == k).any()]
        return out

    def visits(self, u: np.ndarray) -> Iterator[int]:
        """All leaves, best bin first."""
        queue = [(-1.0, 0)]
        near = self.centers @ u
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if len(below):
                for k in below.tolist():
                    heapq.heappush(queue, (-near[k], k))
            else:
                yield int(self.leaf[node])


def _kmeans(u: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """Spherical k-means; rows of ``u`` are distinct. Returns at most ``k`` centers."""
    centers = u[rng.choice(len(u), min(k, len(u)), replace=False)]
    for _ in range(rounds):
        nearest = (u @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, u)
        norms = np.linalg.norm(sums, axis=1)
        filled = norms > 1e-12
        centers = sums[filled] / norms[filled, None]
    return centers


def grow_tree(u: np.ndarray, leaf_rows: int, seed: int = 5) -> Tree:
    """Splits nodes into ``BRANCHES`` until at most ``leaf_rows`` sampled directions are left."""
    rng = np.random.default_rng(seed)
    u = np.unique(u, axis=0)
    centers, children, leaf, leaves = [u.mean(0)], [np.empty(0, np.int64)], [-1], 0
    todo = [(0, np.arange(len(u)))]
    while todo:
        node, own = todo.pop()
        made = _kmeans(u[own], BRANCHES, rng) if len(own) > leaf_rows else None
        if made is None or len(made) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        nearest = (u[own] @ made.T).argmax(1)
        children[node] = np.arange(len(centers), len(centers) + len(made))
        for k in range(len(made)):
            centers.append(made[k])
            children.append(np.empty(0, np.int64))
            leaf.append(-1)
            todo.append((int(children[node][k]), own[nearest == k]))
    return Tree(np.array(centers), children, np.array(leaf))


def best_of(ids: np.ndarray, x: np.ndarray, norms: np.ndarray, u: np.ndarray, own_id, q, q_norm, k: int, least=-2.0):
    """The ``k`` nearest rows to one query, ties to the smaller id: (ids, cosines of at least ``least``).

    Candidates are found by one product; their cosines are then summed row by row, so equal
    vectors have equal cosines.
    """
    near = u @ (q / q_norm)
    near[ids == own_id] = -np.inf
    at = np.flatnonzero(near >= least - 1e-9)
    if len(at) > k:
        at = at[near[at] >= np.partition(near[at], len(at) - k)[len(at) - k] - 1e-9]
    exact = (x[at] * q).sum(1) / (norms[at] * q_norm)
    at, exact = at[exact >= least], exact[exact >= least]
    order = np.lexsort((ids[at], -exact))[:k]
    return ids[at][order], exact[order]


def _found(batch_rows) -> pa.RecordBatch:
    query, ids, near = (np.concatenate(c) if c else np.empty(0) for c in zip(*batch_rows, strict=True)) if batch_rows else ([], [], [])
    arrays = [pa.array(query, pa.int64()), pa.array(ids, pa.int64()), pa.array(near, pa.float64())]
    return pa.record_batch(arrays, names=["query_id", "vec_id", "score"])


def _top(found: DataFrame, k: int) -> DataFrame:
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def _exact_neighbours(rows: DataFrame, probes: list, dim: int, k: int) -> DataFrame:
    """Of a bounded number of queries, by comparing them with all rows, in blocks."""
    ids = [r["vec_id"] for r in probes]
    q = np.stack([np.frombuffer(r["vector"], np.float64) for r in probes])
    norms = np.array([r["norm"] for r in probes])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, own = matrix(batch.column("vector"), dim), batch.column("norm").to_numpy()
                there, u = batch.column("vec_id").to_numpy(), directions(x, own)
                out = []
                for i, a, b in zip(ids, q, norms, strict=True):
                    found, near = best_of(there, x, own, u, i, a, b, k)
                    out.append((np.full(len(found), i), found, near))
                yield _found(out)

    return _top(rows.mapInArrow(compare, "query_id long, vec_id long, score double"), k)


def _leaves_to_visit(tree: Tree, rows: DataFrame, probes: list, dim: int, k: int) -> int:
    """The fewest visits with which the probes find ``TARGET_RECALL`` of their neighbours."""
    true = _exact_neighbours(rows, probes, dim, k).select("query_id", "vec_id")
    leaf_of = rows.select("vec_id", "leaf").distinct()
    wanted: dict[int, list[int]] = {}
    for r in true.join(leaf_of, "vec_id").select("query_id", "leaf").collect():
        wanted.setdefault(r["query_id"], []).append(r["leaf"])
    turns = []
    for r in probes:
        u = np.frombuffer(r["vector"], np.float64) / r["norm"]
        turn = {leaf: n + 1 for n, leaf in enumerate(tree.visits(u))}
        turns += [turn[leaf] for leaf in wanted.get(r["vec_id"], [])]
    return int(np.quantile(turns, TARGET_RECALL, method="higher")) if turns else tree.leaves


def nearest(
    table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows whose id is divisible by ``every`` with their ``k`` nearest other rows by cosine.

    One row per neighbour: query_id, rank (from 1), vec_id, score, nearest first and ties to the
    smaller id. All rows are indexed, those of each length of vector by a tree of their own, as a cosine is
    one of two vectors of one length; recall is that of the calibration, not 1. Vectors that are
    null, zero or not finite throughout, and rows without an id, take no part. Rows that repeat an id
    are one row, that of the smallest digest. With ``k`` other rows or fewer of its length a query gets
    them all; an empty table gives an empty result; other columns are not read.
    """
    spark = table.sparkSession
    every_row = vector_rows(table, id_col, vector_col).where("vector is not null and vec_id is not null")
    every_row = land(every_row.select("vec_id", "vector", "dim", "norm", "key"), "vectors")
    once = every_row.groupBy("vec_id").agg(F.min("key").alias("key"))
    rows = every_row.join(once, ["vec_id", "key"]).dropDuplicates(["vec_id", "key"])
    lengths = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().orderBy("dim").collect()}
    if len(lengths) > 1:
        rows = land(rows, "one-row-an-id")
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dim, n in lengths.items():
        own = rows.where(F.col("dim") == dim).select("vec_id", "vector", "norm")
        near = _nearest_of_length(own, dim, n, k, every)
        if near is not None:
            found = near if len(lengths) == 1 else found.unionByName(near)
    return found


def _nearest_of_length(rows: DataFrame, dim: int, n: int, k: int, every: int) -> DataFrame | None:
    """The neighbours of the queries among ``n`` rows whose vectors have ``dim`` components."""
    spark = rows.sparkSession
    leaf_rows = max(LEAF_ROWS, ROOTS_PER_LEAF * n**0.5)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()
    u = np.stack([np.frombuffer(r["vector"], np.float64) / r["norm"] for r in sample])
    tree = grow_tree(u, max(MIN_LEAF_SAMPLE, int(leaf_rows * len(sample) / n)))
    shared = spark.sparkContext.broadcast(tree)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = directions(matrix(batch.column("vector"), dim), batch.column("norm").to_numpy())
                leaf = pa.array(shared.value.assign(own))
                yield pa.record_batch([*batch.columns, leaf], names=["vec_id", "vector", "norm", "leaf"])

    rows = land(rows.mapInArrow(index, "vec_id long, vector binary, norm double, leaf long"), "index")
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "vector", "norm")
    probes = queries.orderBy(F.xxhash64("vec_id", F.lit("probe")), "vec_id").limit(PROBES).collect()
    if not probes:
        return None
    reach = _leaves_to_visit(tree, rows, probes, dim, k)
    first = int(np.ceil(np.sqrt(reach)))
    sizes = {r["leaf"]: r["count"] for r in rows.groupBy("leaf").count().collect()}  # at most the tree's leaves
    search = _Search(rows, shared, sizes, dim, k)
    found = land(_top(search.visit(queries.withColumn("least", F.lit(-2.0)), 0, first), k), "found")
    bounds = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    bounded = queries.join(bounds, "vec_id", "left").withColumn("least", F.coalesce("bound", F.lit(-2.0))).drop("bound")
    later = search.visit(bounded, first, reach)
    return _top(found.drop("rank").unionByName(later), k).select("query_id", "rank", "vec_id", "score")


class _Search:
    """Visits ranges of the leaves that queries would visit, best first."""

    def __init__(self, rows: DataFrame, tree, sizes: dict[int, int], dim: int, k: int):
        self.rows, self.tree, self.sizes, self.dim, self.k = rows, tree, sizes, dim, k

    def visits(self, queries: DataFrame, start: int, stop: int, counting: bool) -> DataFrame:
        """One row per query and leaf, from the visit ``start`` to ``stop``, or on to ``k`` rows."""
        shared, sizes, dim, k = self.tree, self.sizes, self.dim, self.k
        names = ["leaf", "query_id"] if counting else ["leaf", "query_id", "q", "q_norm", "least"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                own = directions(matrix(batch.column("vector"), dim), batch.column("norm").to_numpy())
                at, leaves = [], []
                for i in range(len(own)):
                    seen = 0
                    for turn, leaf in enumerate(tree.visits(own[i])):
                        if turn >= stop and (seen > k or not start):
                            break
                        seen += sizes.get(leaf, 0)
                        if turn >= start and leaf in sizes:
                            at.append(i)
                            leaves.append(leaf)
                    if len(at) > 4096 or i == len(own) - 1:
                        part = batch.take(pa.array(at, pa.int64()))
                        yield pa.record_batch([pa.array(leaves, pa.int64()), *part.columns[: len(names) - 1]], names=names)
                        at, leaves = [], []

        schema = ["leaf long", "query_id long", "q binary", "q_norm double", "least double"][: len(names)]
        return queries.select("vec_id", "vector", "norm", "least").mapInArrow(run, ", ".join(schema))

    def visit(self, queries: DataFrame, start: int, stop: int) -> DataFrame:
        """(query_id, vec_id, score): the nearest rows of these leaves that reach the query's least."""
        counts = self.visits(queries, start, stop, True).groupBy("leaf").count().collect()
        asked = {r["leaf"]: r["count"] for r in counts}
        parts = [(a, -(-self.sizes[a] // ROWS_PER_TASK), -(-asked[a] // QUERIES_PER_TASK)) for a in asked]
        layout = self.rows.sparkSession.createDataFrame(parts, "leaf long, row_parts int, query_parts int")
        layout = F.broadcast(layout)  # one row per leaf, at most SAMPLE_ROWS / MIN_LEAF_SAMPLE of them

        def dealt(frame: DataFrame, id_name: str, own: str, other: str) -> DataFrame:
            salt = F.pmod(F.xxhash64(id_name), F.col(f"{own}_parts")).cast("int")
            frame = frame.join(layout, "leaf").withColumn(own, salt)
            frame = frame.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)))
            return frame.drop("row_parts", "query_parts")

        dim, k = self.dim, self.k

        def compare(here: pa.Table, asking: pa.Table) -> pa.Table:
            out = []
            if here.num_rows and asking.num_rows:
                ids, norms = here.column("vec_id").to_numpy(), here.column("norm").to_numpy()
                x, q = matrix(here.column("vector"), dim), matrix(asking.column("q"), dim)
                u = directions(x, norms)
                own = (asking.column(c).to_numpy() for c in ("query_id", "q_norm", "least"))
                for i, b, least, a in zip(*own, q, strict=True):
                    found, near = best_of(ids, x, norms, u, i, a, b, k, least)
                    out.append((np.full(len(found), i), found, near))
            return pa.Table.from_batches([_found(out)])

        of_rows = dealt(self.rows, "vec_id", "row", "query")
        of_queries = dealt(self.visits(queries, start, stop, False), "query_id", "query", "row")
        keys = ["leaf", "row", "query"]
        together = of_rows.groupBy(*keys).cogroup(of_queries.groupBy(*keys))
        return together.applyInArrow(compare, "query_id long, vec_id long, score double")
