"""Near-duplicate documents by min-max hashing (operator 5).

1. Equal shingle sets become classes, numbered (``rep``) so that texts that share an id stay apart; ids
   come back at the end, as the smallest of each component.
2. Bands of min-max signatures put representatives into buckets. There are as many bands of 6
   places as it takes for a pair of just the similarity asked for to share no bucket with a
   probability below 5e-6: 26 bands, of 78 hash functions, for 0.85.
3. Each member of a bucket is confirmed, on full shingle sets, against the bucket's smallest.
4. Buckets that still hold several components are searched for further links between them: in
   blocks, so that no task sees more than two blocks of a bucket. Pairs whose signatures agree in
   a share of at least ``similarity - MARGIN`` (over five standard deviations below) are
   confirmed on full sets, unless both are in one component already.

Shuffles are read, and tables landed, by as many tasks as the rows of the table before call for: a
shuffle partition of a few rows is not a task and a file of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidequote.llm.columns import free_names
from tidequote.llm.components import components
from tidequote.llm.shingles import band_keys, min_max_signatures, shingle_sets
from tidequote.sources.landing import land

ROWS_PER_BAND = 6
MISSED = 5e-6
BLOCK = 1024
MARGIN = 0.15
ROWS_PER_TASK = 4096
SHINGLES_PER_TASK = 1 << 20


def hash_functions(percent: int) -> int:
    """Half the places of the signature, as each function gives a least and a greatest value."""
    bands = np.ceil(np.log(MISSED) / np.log1p(-((percent / 100) ** ROWS_PER_BAND)))
    return max(1, int(bands)) * ROWS_PER_BAND // 2


def _sketches(docs: DataFrame, words: int, hashes: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, flat, offsets in shingle_sets(batch, words):
                keys = band_keys(min_max_signatures(flat, offsets, hashes), ROWS_PER_BAND).view(np.int64)
                raw, ends = memoryview(flat.tobytes()), (offsets * 8).tolist()
                sets = [_set_id(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                at = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1])
                yield pa.record_batch(
                    [
                        rows.column("doc_id"),
                        rows.column("text_hash"),
                        pa.array(np.diff(offsets)),
                        pa.array(sets, pa.binary()),
                        pa.ListArray.from_arrays(at, pa.array(keys.ravel())),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "set_id", "bands"],
                )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), "text")
    return own.mapInArrow(sketch, "doc_id long, text_hash long, n_shingles long, set_id binary, bands array<long>")


def _tasks(landed: DataFrame, rows: int | None = None) -> int:
    """Tasks for what follows from a landed table, by its rows and, where it has them, the set sizes ``n``."""
    shingles = F.sum("n") if "n" in landed.columns else F.lit(0)
    found = landed.agg(F.count("*").alias("rows"), shingles.alias("shingles")).first()
    return max(1, -(-found["rows"] // (rows or ROWS_PER_TASK)), -(-(found["shingles"] or 0) // SHINGLES_PER_TASK))


def _text_hash() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _set_id(members: memoryview) -> bytes:
    return hashlib.blake2b(members, digest_size=16).digest()


def _full_sets(texts: DataFrame, words: int, hashes: int) -> DataFrame:
    """(rep, full set, signature) of the ``texts`` (rep, set_id, text) that have the set of their class."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, flat, offsets in shingle_sets(batch, words):
                signatures = min_max_signatures(flat, offsets, hashes)
                sets = [flat[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
                own = [_set_id(x) == y for x, y in zip(sets, rows.column("set_id").to_pylist(), strict=True)]
                found = pa.record_batch(
                    [rows.column("rep"), pa.array(sets, pa.binary()), pa.array([s.tobytes() for s in signatures], pa.binary())],
                    names=["rep", "members", "signature"],
                )
                yield found.filter(pa.array(own, pa.bool_()))

    return texts.select("rep", "set_id", "text").mapInArrow(full, "rep long, members binary, signature binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, tasks: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, on full sets."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                linked.append(_similar(x, y, percent))
            kept = batch.filter(pa.array(linked, pa.bool_()))
            yield pa.record_batch([kept.column("a"), kept.column("b")], names=["a", "b"])

    # b first: a is the smallest of its bucket, so its rows are the ones that may be many
    own = pairs.join(sets.select(F.col("rep").alias("b"), F.col("members").alias("set_b")), "b").coalesce(tasks)
    own = own.join(sets.select(F.col("rep").alias("a"), F.col("members").alias("set_a")), "a")
    return own.select("a", "b", "set_a", "set_b").coalesce(tasks).mapInArrow(confirm, "a long, b long")


def _across_components(open_rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components within buckets, confirmed on full sets.

    ``open_rows`` (band, rep, component, n), landed, holds the buckets with two components or more. Components of a block or more have blocks of their own, the others share
    some; a task compares two blocks, and two blocks of one component are not compared. What a
    task has linked it does not compare again, so it reports fewer links than it has rows.
    """
    tasks = _tasks(open_rows)
    by_component = open_rows.groupBy("band", "component").agg(F.count("*").alias("size")).coalesce(tasks)
    pooled = F.col("size") < BLOCK
    pools = by_component.groupBy("band").agg(
        F.ceil(F.sum(F.when(pooled, F.col("size")).otherwise(0)) / BLOCK).alias("pools")
    )
    by_component = by_component.join(pools, "band").coalesce(tasks)
    many = F.when(pooled, F.col("pools")).otherwise(F.ceil(F.col("size") / BLOCK))
    salt = F.when(pooled, F.pmod(F.xxhash64("component"), many)).otherwise(F.pmod(F.xxhash64("rep"), many))
    block = F.struct(F.when(~pooled, F.col("component")).alias("of"), salt.alias("part"))
    rows = open_rows.join(by_component, ["band", "component"]).withColumn("block", block)
    rows = land(rows.select("band", "block", "rep", "component", "n").coalesce(tasks), "blocks")
    blocks = rows.select("band", "block").distinct().coalesce(tasks)
    left = blocks.select("band", F.col("block").alias("left"))
    right = blocks.select("band", F.col("block").alias("right"))
    # block pairs of a bucket; a block of one component is not compared with that component's
    matches = left.join(right, "band").where(
        "(left < right and not (left.of is not null and left.of <=> right.of)) or (left = right and left.of is null)"
    )
    # a block that meets others is not compared with itself apart: any of its pairs does that
    matches = matches.withColumn("alone", F.count("*").over(W.partitionBy("band")) == 1)
    matches = matches.where("alone or left < right").withColumn("match", F.xxhash64("band", "left", "right")).coalesce(tasks)
    ends = matches.select("band", "match", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    dealt = land(rows.join(ends, ["band", "block"]).select("match", "rep", "component", "n").coalesce(tasks), "dealt")
    tasks = _tasks(dealt, 2 * BLOCK)
    # full sets go only to rows that some signature is near enough to
    near = dealt.join(sets.select("rep", "signature"), "rep").transform(_by_match, _near, percent, dealt.schema, tasks)
    near = near.join(sets, "rep").select(*dealt.columns, "signature", "members")
    return near.transform(_by_match, _linked, percent, "a long, b long", tasks)


def _by_match(rows: DataFrame, function, percent: int, schema, tasks: int) -> DataFrame:
    """Applies ``function`` to the rows of each match, one match after the other.

    A match lies in one shuffle partition, so its rows stay together where a task reads several.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            match = table.column("match").to_numpy()
            cuts = np.flatnonzero(match[1:] != match[:-1]) + 1
            for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
                yield from function(table.slice(a, b - a), percent)
            held = table.slice(cuts[-1]) if len(cuts) else table
        if held is not None and held.num_rows:
            yield from function(held, percent)

    return rows.repartition("match").sortWithinPartitions("match").coalesce(tasks).mapInArrow(run, schema)


def _signatures(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(group.num_rows, -1)


def _partners(i: int, component: np.ndarray, n: np.ndarray, signature: np.ndarray, percent: int) -> np.ndarray:
    """Later rows of other components that may be linked with row ``i``, the likeliest first."""
    j = np.arange(i + 1, len(n))
    j = j[(component[j] != component[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
    if not len(j):
        return j
    agree = (signature[j] == signature[i]).sum(1)
    enough = int((agree >= (percent / 100 - MARGIN) * signature.shape[1]).sum())
    return j[np.argsort(-agree, kind="stable")][:enough]


def _near(group: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    component, n, signature = group.column("component").to_numpy(), group.column("n").to_numpy(), _signatures(group)
    near = np.zeros(len(n), bool)
    for i in range(len(n) - 1):
        j = _partners(i, component, n, signature, percent)
        if len(j):
            near[i] = near[j] = True
    yield from group.select(["match", "rep", "component", "n"]).filter(pa.array(near)).to_batches()


def _linked(group: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Links that join the components of a group, as far as they can be joined."""
    rep, n, signature = group.column("rep").to_numpy(), group.column("n").to_numpy(), _signatures(group)
    component = group.column("component").to_numpy().copy()
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("members")]
    found = []
    for i in range(len(rep) - 1):
        for k in _partners(i, component, n, signature, percent).tolist():
            if component[k] != component[i] and _similar(sets[i], sets[k], percent):
                found.append((rep[i], rep[k]))
                component[component == component[k]] = component[i]
    pairs = np.array(found, np.int64).reshape(-1, 2)
    yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept (it is its component's smallest).

    Two documents are linked when their sets of distinct ``words``-word shingles (bytes A-Z in
    lower case, words between 0x20 and 0x09-0x0D) have 100 * intersection >= percent * union.
    A text without words, or null, has an empty set and links with nothing. Repeated rows are
    linked by their equal sets; where an id has several texts, each row has the links of its own.
    A row whose id is null takes no part: its component_id is null and it is kept. Sets are of whole
    texts, however long. An empty table gives an empty result; only ``doc_id`` and ``text`` are read.
    """
    if not 0 < percent < 100:
        raise ValueError("percent must lie between 0 and 100")
    return _in_components(docs, words, percent).drop("text_hash")


def _in_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """As ``near_duplicates``, with the ``text_hash`` of each row."""
    hashes = hash_functions(percent)
    sketches = land(_sketches(docs, words, hashes), "sketches")
    of_docs = _tasks(sketches)
    real = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = real.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash", "n_shingles", "bands")).alias("r"))
    classes = classes.select(
        "set_id", F.monotonically_increasing_id().alias("rep"), F.col("r.n_shingles").alias("n"), "r.bands", "r.doc_id", "r.text_hash"
    )
    classes = land(classes.coalesce(of_docs), "classes")  # the numbers hold once they are written

    places = classes.select("rep", "n", F.explode("bands").alias("band"))
    heads = places.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("h"), F.count("*").alias("size")).where("size > 1")
    heads = heads.select("band", F.col("h.rep").alias("head"), F.col("h.n").alias("head_n"))
    members = land(places.join(heads, "band").coalesce(of_docs), "members")
    tasks = _tasks(members)
    alike = F.least("n", "head_n") * 100 >= F.greatest("n", "head_n") * percent
    stars = members.where(alike & (F.col("rep") != F.col("head"))).select(F.col("head").alias("a"), F.col("rep").alias("b"))
    stars = stars.distinct().coalesce(tasks)

    asked = classes.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", "set_id", "doc_id", "text_hash")
    asked = asked.coalesce(of_docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), "text")
    texts = texts.join(asked, ["doc_id", "text_hash"]).coalesce(tasks).dropDuplicates(["rep"])
    sets = land(_full_sets(texts.coalesce(tasks), words, hashes), "sets")

    links = land(_confirmed(stars, sets, percent, tasks), "links")
    roots = components(links, landed=True)
    placed = members.select("band", "rep", "n").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    placed = placed.withColumn("component", F.coalesce("component_id", "rep")).drop("component_id")
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_rows = land(placed.join(mixed.where("low < high").select("band"), "band", "left_semi").coalesce(tasks), "open")
    more = land(_across_components(open_rows, sets, percent), "more")
    roots = components(roots.unionByName(more.toDF("id", "component_id")), landed=True)

    joined = classes.join(roots.withColumnRenamed("id", "rep"), "rep", "inner")
    lowest = joined.select("component_id", "doc_id").unionByName(
        classes.join(roots.select(F.col("component_id").alias("rep")).distinct(), "rep", "left_semi").select(
            F.col("rep").alias("component_id"), "doc_id"
        )
    )
    lowest = lowest.groupBy("component_id").agg(F.min("doc_id").alias("low")).coalesce(of_docs)
    roots = roots.unionByName(lowest.select(F.col("component_id").alias("id"), "component_id")).join(lowest, "component_id")
    own = classes.select("set_id", "rep", "doc_id").join(roots.select(F.col("id").alias("rep"), "low"), "rep", "left")
    own = own.select("set_id", F.coalesce("low", "doc_id").alias("found")).coalesce(of_docs)
    key = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_id"))
    out = sketches.select("doc_id", "text_hash", "n_shingles", key.alias("set_id")).join(own, "set_id", "left").coalesce(of_docs)
    component = F.coalesce("found", "doc_id")
    return out.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the smallest ``doc_id`` stays.

    Where an id has several texts, only those in a group of a smaller id go; of rows equal in id and
    text one stays. Rows without words or without an id stay as they are, and so do an empty table and
    extra columns; a very long text is compared by its whole set.
    """
    hashed, turn = free_names(docs, "text_hash", "turn")
    dropped = _in_components(docs.select("doc_id", "text"), words, percent).where(~F.col("kept"))
    dropped = dropped.select("doc_id", F.col("text_hash").alias(hashed)).distinct()
    same = F.row_number().over(W.partitionBy("doc_id", hashed).orderBy(F.lit(0)))
    left = docs.where("doc_id is not null").withColumn(hashed, _text_hash())
    left = left.join(dropped, ["doc_id", hashed], "left_anti").withColumn(turn, same).where(F.col(turn) == 1)
    return left.select(*docs.columns).unionByName(docs.where("doc_id is null"))
