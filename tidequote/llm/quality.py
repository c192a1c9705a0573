"""Quality scores by a byte-level convolutional network (operator 1).

A text's bytes are embedded and filters of ``WIDTH`` bytes slide over all of them, two bytes at a
time. Maxima of the filters over overlapping chunks describe the chunks; a small layer gives each
chunk a vote; the least and the mean of the votes make the probability. Everything is learned by
gradient descent in numpy on a bounded sample of labelled documents, and texts are scored whole. Filters
work in tiles, but a text is widened as a whole: one takes some 17 bytes of memory a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidequote.llm.textbytes import chunks

WIDTH, STRIDE, DIM, FILTERS, HIDDEN = 8, 2, 8, 32, 16
CELL = 256  # bytes; a chunk is two neighbouring cells, so chunks overlap by half
PER_STRIDE = CELL // STRIDE
TILE_CELLS = 512
SAMPLE_PER_LABEL = 1000
SAMPLE_BYTES = 24 << 10  # longer texts are not drawn for learning; scoring has no such limit
EPOCHS = 12
BATCH = 32

Params = dict[str, np.ndarray]


def cells_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as int32 cells plus the bytes after each, first cell of each text).

    Each text fills whole cells of its own, padded by the symbol 256; an empty one has one cell.
    """
    size = np.diff(offsets)
    cells = np.maximum(1, -(-size // CELL))
    first = np.concatenate([[0], np.cumsum(cells)])
    flat = np.full(first[-1] * CELL + WIDTH, 256, np.int16)
    at = np.arange(len(data)) + np.repeat(first[:-1] * CELL - offsets[:-1], size)
    flat[at] = data
    # a filter that begins in the last bytes of a cell sees the next cell, if it is the same text's
    tail = np.lib.stride_tricks.as_strided(flat, (first[-1], CELL + WIDTH - STRIDE), (CELL * 2, 2)).copy()
    tail[first[1:] - 1, CELL:] = 256
    return tail, first


def new_params(rng: np.random.Generator) -> Params:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "embed": normal(257, DIM, scale=0.5),
        "filter": normal(WIDTH * DIM, FILTERS, scale=1 / np.sqrt(WIDTH * DIM)),
        "bias": np.zeros(FILTERS, np.float32),
        "hidden": normal(FILTERS + 1, HIDDEN, scale=1 / np.sqrt(FILTERS)),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "vote": normal(HIDDEN, scale=1 / np.sqrt(HIDDEN)),
        "out": np.array([0.5, 0.5, 0.0], np.float32),  # least vote, mean vote, bias
    }


def cell_maxima(cells: np.ndarray, p: Params, places: bool = False):
    """Maximum of each filter in each cell, before bias; with ``places`` also where it is."""
    pieces, where = [], []
    steps = WIDTH // STRIDE
    for a in range(0, len(cells), TILE_CELLS):
        own = cells[a : a + TILE_CELLS]
        x = p["embed"][own].reshape(len(own), -1, STRIDE * DIM)  # by two bytes
        x = np.concatenate([x[:, k : k + PER_STRIDE] for k in range(steps)], axis=2)
        h = (x.reshape(-1, WIDTH * DIM) @ p["filter"]).reshape(len(own), PER_STRIDE, FILTERS)
        if places:
            at = h.argmax(1)
            where.append(at)
            pieces.append(np.take_along_axis(h, at[:, None], 1)[:, 0])
        else:
            pieces.append(h.max(1))
    return (np.concatenate(pieces), np.concatenate(where)) if places else np.concatenate(pieces)


def _chunked(m: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk maxima: each cell with the next of its text; (values, from the next, next cell)."""
    after = np.arange(len(m)) + 1
    after[first[1:] - 1] -= 1
    later = m[after] > m
    return np.where(later, m[after], m), later, after


def _fill(cells: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Share of a chunk that is text: short texts reach fewer maxima."""
    own = (cells[:, :CELL] != 256).sum(1)
    both = own + np.where(after == np.arange(len(own)), 0, own[after])
    return (both / (2 * CELL)).astype(np.float32)


def votes(cells: np.ndarray, first: np.ndarray, p: Params) -> np.ndarray:
    c, _, after = _chunked(cell_maxima(cells, p) + p["bias"], first)
    c = np.concatenate([np.maximum(c, 0), _fill(cells, after)[:, None]], 1)
    return np.maximum(c @ p["hidden"] + p["hidden_bias"], 0) @ p["vote"]


def scores(data: np.ndarray, offsets: np.ndarray, p: Params) -> np.ndarray:
    """Probability of each text that its label is 1."""
    cells, first = cells_of(data, offsets)
    v = votes(cells, first, p).astype(np.float64)
    least = np.minimum.reduceat(v, first[:-1])
    mean = np.add.reduceat(v, first[:-1]) / np.diff(first)
    w = p["out"].astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(w[0] * least + w[1] * mean + w[2], -30, 30)))


def _gradients(cells: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray, p: Params) -> Params:
    m, at = cell_maxima(cells, p, places=True)
    c, later, after = _chunked(m + p["bias"], first)
    r = np.concatenate([np.maximum(c, 0), _fill(cells, after)[:, None]], 1)
    a = r @ p["hidden"] + p["hidden_bias"]
    h = np.maximum(a, 0)
    v = h @ p["vote"]
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    least = np.minimum.reduceat(v, first[:-1])
    mean = np.add.reduceat(v, first[:-1]) / n
    z = p["out"][0] * least + p["out"][1] * mean + p["out"][2]
    d = ((1 / (1 + np.exp(-z)) - y) * weight).astype(np.float32)
    g = {"out": np.array([(d * least).sum(), (d * mean).sum(), d.sum()], np.float32)}
    lowest = np.flatnonzero(v == least[owner])
    lowest = lowest[np.unique(owner[lowest], return_index=True)[1]]
    dv = (d * p["out"][1] / n)[owner].astype(np.float32)
    dv[lowest] += d * p["out"][0]
    g["vote"] = h.T @ dv
    da = dv[:, None] * p["vote"] * (a > 0)
    g["hidden"], g["hidden_bias"] = r.T @ da, da.sum(0)
    dc = (da @ p["hidden"].T)[:, :FILTERS] * (c > 0)
    dm = dc * ~later
    np.add.at(dm, after, dc * later)
    g["bias"] = dm.sum(0)
    x = p["embed"][cells]
    g["filter"], g["embed"] = np.zeros_like(p["filter"]), np.zeros_like(p["embed"])
    row = np.arange(len(cells))
    for f in range(FILTERS):
        pick = at[:, f, None] * STRIDE + np.arange(WIDTH)
        seen = x[row[:, None], pick].reshape(len(cells), -1)
        g["filter"][:, f] = dm[:, f] @ seen
        back = (dm[:, f, None] * p["filter"][:, f]).reshape(-1, DIM)
        symbols = cells[row[:, None], pick].ravel()
        for k in range(DIM):
            g["embed"][:, k] += np.bincount(symbols, back[:, k], 257)
    return g


def fit(texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Params:
    """Learns from texts with labels 0 and 1 (Adam); both labels weigh the same in all."""
    rng = np.random.default_rng(seed)
    p = new_params(rng)
    if not len(texts):
        return p
    share = np.bincount(y, minlength=2) / len(y)
    weight = 0.5 / np.maximum(share, 1e-9)[y]
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    step, steps = 0, epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            own = order[a : a + BATCH]
            data = np.frombuffer(b"".join(texts[i] for i in own), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in own])])
            cells, first = cells_of(data, offsets)
            g = _gradients(cells, first, y[own], weight[own] / len(own), p)
            step += 1
            rate = 0.01 * min(1.0, step / 20) * (1 - step / (steps + 1))
            for k in p:
                mean[k] = 0.9 * mean[k] + 0.1 * g[k]
                square[k] = 0.99 * square[k] + 0.01 * g[k] ** 2
                own_mean, own_square = mean[k] / (1 - 0.9**step), square[k] / (1 - 0.99**step)
                p[k] = (p[k] - rate * own_mean / (np.sqrt(own_square) + 1e-8)).astype(np.float32)
    return p


def held_out(id_col: str = "doc_id"):
    """Rows from which no label is learned: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, epochs: int = EPOCHS) -> Params:
    """Learns from at most ``per_label`` documents of each label, drawn by a hash of their ids.

    Only labels 0 and 1 of documents that are not held out count. The draw is made on ids, so
    texts of at most ``2 * per_label`` documents reach the driver. An id with both labels is left out, and
    of an id with several texts one is learned. Without labels, or with an empty table, the network
    stays as it was drawn: its scores are numbers from 0 to 1 that say nothing.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & ~held_out()).select("doc_id", "quality").dropna()
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    usable = usable.where("quality = other")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sized = own.where(F.octet_length("text") <= SAMPLE_BYTES).select("doc_id")
    drawn = None
    turn = F.xxhash64("doc_id", F.lit("draw"))
    for label in (0, 1):
        some = usable.where(F.col("quality") == label).join(sized, "doc_id", "left_semi")
        some = some.orderBy(turn, "doc_id").limit(per_label).select("doc_id", "quality")
        drawn = some if drawn is None else drawn.unionByName(some)
    ids = {r["doc_id"]: r["quality"] for r in drawn.collect()}
    if not ids:
        return fit([], np.empty(0, np.int64))
    rows = own.where(F.col("doc_id").isin(list(ids))).dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return fit([r["text"].encode() for r in rows], np.array([ids[r["doc_id"]] for r in rows]), epochs)


def score_quality(docs: DataFrame, params: Params) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; one pass, no shuffle.

    A null or empty text gets the score of an empty text; a very long one is scored as a whole; a null id
    is kept and not held out; repeated rows are scored one by one; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(params)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch, "t", 1 << 20):
                value = np.round(scores(data, offsets, shared.value), 6)
                yield pa.record_batch([rows.column("i"), pa.array(value)], names=["doc_id", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("t"))
    scored = own.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, params: Params) -> DataFrame:
    """The rows of ``docs`` whose text is predicted to be good, all columns as they are.

    Nulls, empty and very long texts, repeated rows, null ids and an empty table are as in ``score_quality``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(params)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch, "text", 1 << 20):
                good = np.round(scores(data, offsets, shared.value), 6) >= 0.5
                yield rows.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
