"""Cross-tokenizer alignment through inverted pair bitmaps (operator 11).

Two tokenizers cut the same bytes; tokens whose bytes overlap are linked. For every pair of ids a
block of documents holds bitmaps of its documents: plane ``k`` has a document's bit when bit ``k`` of
the number of its links of that pair is set. A bitmap is stored as sorted 16-bit numbers or as plain
bits, whichever is smaller. The planes OR-merged and popcounted give the documents of a pair, the planes
popcounted and weighted by powers of two its links. The counted pairs then go back along the
bitmaps, which return to every document the sum of its links' counts.

Blocks hold neighbouring documents of one task, so the bitmaps of a pair in the corpus are those of
its blocks side by side and a frequent pair has one row per block and plane, not one per document.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidequote.llm import bpe
from tidequote.llm.textbytes import chunks
from tidequote.sources.landing import land

LOCAL_BITS, B_BITS = 16, 23
MAX_DOCS = 1 << LOCAL_BITS
MAX_LINKS = 4 << 20
CHUNK = 1 << 20
DOC_FIELDS = ("n_a", "n_b", "n_groups", "n_links")
INDEX_SCHEMA = (
    "block long, local int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, plane int, docs long, card long, dense boolean, bits binary"
)
_TYPES = {
    "block": pa.int64(), "local": pa.int32(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
    "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "a": pa.int32(), "b": pa.int32(),
    "plane": pa.int32(), "docs": pa.int64(), "card": pa.int64(), "dense": pa.bool_(), "bits": pa.binary(),
}


class Ragged:
    """Byte strings by id, end to end."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[bpe.ragged(self.starts[ids], self.sizes[ids])]


def _with_ends(size: int, *ends: str) -> list[np.ndarray]:
    return [np.array([f"{i}{end}" for i in range(size)], object) for end in ends]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, path_a: str | None, path_b: str | None):
        import sentencepiece

        if path_a is None or path_b is None:
            import public_tokenizers

            path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
            path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
        self.a = bpe.ByteBpe(path_a)
        self.a.special = b""  # its string in a text is plain text
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        alphabet, entries = byte_alphabet(), [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            entries[i] = bytes(alphabet.get(c, 0) for c in piece)
        self.bytes_a = Ragged(entries)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.bytes_b = Ragged(
            [
                bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        self.text_a = _with_ends(len(entries), ",", "|")
        self.text_b = _with_ends(size, ",", ";")

    def encode(self, texts: list[str], data: np.ndarray, offsets: np.ndarray):
        """(usable texts, A ids, their counts, B ids, their counts) of texts that are not empty.

        ``data`` holds a space and the text, for each text. Usable are those whose B bytes are just these;
        bytes of A are always, as a byte-level vocabulary changes none.
        """
        lists = self.b.encode(texts, num_threads=1)
        counts = np.array([len(x) for x in lists], np.int64)
        ids = np.concatenate([np.array(x, np.int32) for x in lists]) if lists else np.empty(0, np.int32)
        owner = np.repeat(np.arange(len(texts)), counts)
        lengths = np.bincount(owner, self.bytes_b.sizes[ids], len(texts)).astype(np.int64)
        usable = lengths == np.diff(offsets)
        same = self.bytes_b.joined(ids[usable[owner]]) == data[np.repeat(usable, np.diff(offsets))]
        if not same.all():
            of = np.repeat(np.flatnonzero(usable), lengths[usable])
            usable[of[~same]] = False
        ids_a, counts_a = self.a.token_ids(data, offsets)
        keep_a, keep_b = np.repeat(usable, counts_a), usable[owner]
        return usable, ids_a[keep_a].astype(np.int64), counts_a[usable], ids[keep_b].astype(np.int64), counts[usable]


@lru_cache(1)
def load(path_a: str | None = None, path_b: str | None = None) -> Pair:
    return Pair(path_a, path_b)


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each."""
    n = len(offsets) - 1
    moved = offsets + np.arange(n + 1)
    out = np.full(moved[-1], 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = data
    return out, moved


def align(pair: Pair, ids_a, counts_a, ids_b, counts_b):
    """Links and groups of texts that lie end to end in both cuttings.

    Returns (text of each link, its A id, its B id, groups of each text, their strings). Between two
    neighbouring ends of any token lies exactly one overlap, and no pair of tokens has two.
    """
    ends_a, ends_b = np.cumsum(pair.bytes_a.sizes[ids_a]), np.cumsum(pair.bytes_b.sizes[ids_b])
    at_a, at_b = np.zeros(ends_a[-1] + 1, bool), np.zeros(ends_a[-1] + 1, bool)
    at_a[ends_a], at_b[ends_b] = True, True
    cuts = np.flatnonzero(at_a | at_b)
    at_a, at_b = at_a[cuts], at_b[cuts]
    of_a, of_b = np.cumsum(at_a) - at_a, np.cumsum(at_b) - at_b
    both = at_a & at_b
    group = np.cumsum(both) - both
    text_of_a = np.repeat(np.arange(len(counts_a)), counts_a)
    links = text_of_a[of_a], ids_a[of_a], ids_b[of_b]
    groups = np.bincount(links[0][both], minlength=len(counts_a))
    group_a, group_b = group[at_a], group[at_b]
    n_groups = int(both.sum())
    a_upto = np.cumsum(np.bincount(group_a, minlength=n_groups))
    b_upto = np.cumsum(np.bincount(group_b, minlength=n_groups))
    words = np.empty(len(ids_a) + len(ids_b), object)
    last_a, last_b = both[at_a], both[at_b]
    before_b = np.concatenate([[0], b_upto])[group_a]
    words[np.arange(len(ids_a)) + before_b] = np.where(last_a, pair.text_a[1][ids_a], pair.text_a[0][ids_a])
    words[np.arange(len(ids_b)) + a_upto[group_b]] = np.where(last_b, pair.text_b[1][ids_b], pair.text_b[0][ids_b])
    ends = np.cumsum(counts_a + counts_b)
    words = words.tolist()
    strings = ["".join(words[a:b])[:-1] for a, b in zip((ends - counts_a - counts_b).tolist(), ends.tolist(), strict=True)]
    return *links, groups, strings


def _batch(size: int, **columns) -> pa.RecordBatch:
    """A batch of the index; columns that are not given are null."""
    arrays = [columns[c] if c in columns else pa.nulls(size, t) for c, t in _TYPES.items()]
    return pa.record_batch(arrays, names=list(_TYPES))


def planes(links: np.ndarray, block: int, n_docs: int) -> Iterator[pa.RecordBatch]:
    """The bitmaps of a block, from its links as ``pair << LOCAL_BITS | local``."""
    keys, times = np.unique(links, return_counts=True)
    pair, local = keys >> LOCAL_BITS, (keys & (MAX_DOCS - 1)).astype(np.uint16)
    fresh = np.concatenate([[True], pair[1:] != pair[:-1]]) if len(pair) else np.empty(0, bool)
    number = np.cumsum(fresh) - 1
    pairs = pair[fresh]
    any_plane = np.bincount(number, minlength=len(pairs))  # the planes OR-merged: a bit for each key
    counted = np.zeros(len(pairs), bool)
    width = -(-n_docs // 8)
    for plane in range(int(times.max(initial=0)).bit_length()):
        bit = (times >> plane & 1).astype(bool)
        own, docs = number[bit], local[bit]
        card = np.bincount(own, minlength=len(pairs))
        used = np.flatnonzero(card)
        merged = np.where(counted[used], 0, any_plane[used])
        counted[used] = True
        wide = 2 * card[used] > width
        in_wide = wide[np.searchsorted(used, own)]
        for dense, rows, chosen in ((False, used[~wide], ~in_wide), (True, used[wide], in_wide)):
            if not len(rows):
                continue
            if dense:
                bits = np.zeros((len(rows), 8 * width), bool)
                bits[np.searchsorted(rows, own[chosen]), docs[chosen]] = True
                stored, sizes = np.packbits(bits, axis=1, bitorder="little").tobytes(), np.full(len(rows), width)
            else:
                stored, sizes = docs[chosen].tobytes(), 2 * card[rows]
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield _batch(
                len(rows),
                block=pa.array(np.full(len(rows), block)),
                a=pa.array((pairs[rows] >> B_BITS).astype(np.int32)),
                b=pa.array((pairs[rows] & ((1 << B_BITS) - 1)).astype(np.int32)),
                plane=pa.array(np.full(len(rows), plane, np.int32)),
                docs=pa.array(merged[wide == dense]),
                card=pa.array(card[rows]),
                dense=pa.array(np.full(len(rows), dense)),
                bits=pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(stored)]),
            )


def index(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """A row per document (``doc_id`` and its own counts) and a row per block, pair and plane."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(path_a, path_b)
        block, links, n_links, n_docs = TaskContext.get().partitionId() << 32, [], 0, 0
        parts = (batch.slice(a, MAX_DOCS) for batch in batches for a in range(0, batch.num_rows, MAX_DOCS))
        for part in parts:
            for rows, data, offsets in chunks(part, "t", CHUNK):
                n = rows.num_rows
                # a block takes whole chunks while it has room for them
                if n_docs and (n_docs + n > MAX_DOCS or n_links >= MAX_LINKS):
                    yield from planes(np.concatenate(links), block, n_docs)
                    block, links, n_links, n_docs = block + 1, [], 0, 0
                found = {k: np.zeros(n, np.int64) for k in DOC_FIELDS}
                digests = np.full(n, "", object)
                full = np.flatnonzero(np.diff(offsets))
                if len(full):
                    texts = rows.column("t").take(pa.array(full)).to_pylist()
                    put, ends = spaced(data, np.concatenate([[0], offsets[1:][full]]))
                    usable, ids_a, counts_a, ids_b, counts_b = pair.encode(texts, put, ends)
                    own = full[usable]
                    if len(own):
                        text, a, b, groups, strings = align(pair, ids_a, counts_a, ids_b, counts_b)
                        found["n_a"][own], found["n_b"][own], found["n_groups"][own] = counts_a, counts_b, groups
                        found["n_links"][own] = np.bincount(text, minlength=len(own))
                        digests[own] = [hashlib.sha256(s.encode()).hexdigest() for s in strings]
                        links.append((a << B_BITS | b) << LOCAL_BITS | own[text] + n_docs)
                        n_links += len(text)
                yield _batch(
                    n,
                    block=pa.array(np.full(n, block)),
                    local=pa.array(np.arange(n_docs, n_docs + n, dtype=np.int32)),
                    doc_id=rows.column("doc_id"),
                    groups_sha256=pa.array(digests, pa.string()),
                    **{k: pa.array(v) for k, v in found.items()},
                )
                n_docs += n
        if links:
            yield from planes(np.concatenate(links), block, n_docs)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("t"))
    return own.mapInArrow(build, INDEX_SCHEMA)


def pair_counts(indexed: DataFrame) -> DataFrame:
    """(a, b, docs, links, is_best): documents and links of every id pair in the corpus.

    ``is_best`` marks the pairs of a B id with the most links, ties included. A B id has one row of
    ``best``, so that table is as small as the vocabulary.
    """
    postings = indexed.where(F.col("a").isNotNull())
    links = F.sum(F.expr("shiftleft(card, plane)")).alias("links")
    pairs = land(postings.groupBy("a", "b").agg(F.sum("docs").alias("docs"), links), "pair-counts")
    best = pairs.groupBy("b").agg(F.max("links").alias("most"))
    return pairs.join(F.broadcast(best), "b").select("a", "b", "docs", "links", (F.col("links") == F.col("most")).alias("is_best"))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each block, then its bitmaps with their pairs' weights, to scored documents."""
    current, docs, scores = None, [], None

    def scored() -> Iterator[pa.RecordBatch]:
        for rows in docs:
            at = rows.column("local").to_numpy()
            own = [rows.column(c) for c in ("doc_id", *DOC_FIELDS)]
            own += [pa.array(scores[1][at]), pa.array(scores[0][at]), rows.column("groups_sha256")]
            yield pa.record_batch(own, names=["doc_id", *DOC_FIELDS, "n_best", "count_sum", "groups_sha256"])

    for batch in batches:
        block = batch.column("block").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.empty(0, np.int64)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(block)], strict=True):
            if block[a] != current:
                yield from scored()
                current, docs, scores = block[a], [], np.zeros((2, MAX_DOCS), np.int64)
            own = batch.slice(a, b - a)
            n = len(own) - own.column("a").null_count
            if n < len(own):
                docs.append(own.slice(0, len(own) - n))
                own = own.slice(len(own) - n)
            if not n:
                continue
            weight = np.stack([own.column("weight").to_numpy(), own.column("best").to_numpy()])
            dense = own.column("dense").to_numpy(zero_copy_only=False)
            bits = own.column("bits")
            sizes = pc.binary_length(bits).to_numpy()
            few = np.frombuffer(b"".join(bits.filter(pa.array(~dense)).to_pylist()), "<u2")
            times = sizes[~dense] // 2
            for k in (0, 1):
                np.add.at(scores[k], few, np.repeat(weight[k][~dense], times))
            if dense.any():
                rows = np.frombuffer(b"".join(bits.filter(pa.array(dense)).to_pylist()), np.uint8).reshape(int(dense.sum()), -1)
                for first in range(0, len(rows), 256):
                    row, doc = np.nonzero(np.unpackbits(rows[first : first + 256], axis=1, bitorder="little"))
                    for k in (0, 1):
                        np.add.at(scores[k], doc, weight[k][dense][first + row])
    yield from scored()


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A null or empty text, and one that B changes, has no tokens: zeros and an empty string. Repeated
    rows count one by one, a null id is kept, ties for the most links are all best, an empty table
    gives an empty result, and other columns are not read. A very long text is a block of its own, in
    memory as a whole. The bitmaps are written to the shared folder; joins and sums go by pair, and
    then by block, so no task gets more of a frequent pair than adaptive execution deals to it.
    """
    indexed = land(index(docs, path_a, path_b), "pair-bitmaps")
    postings = indexed.where(F.col("a").isNotNull()).select("block", "a", "b", "plane", "dense", "bits")
    # merged at every size: a broadcast of the counted pairs would not hold for a larger vocabulary of pairs
    weighed = postings.join(pair_counts(indexed).hint("merge"), ["a", "b"]).select(
        "block",
        "a",
        F.expr("shiftleft(links, plane)").alias("weight"),
        F.when(F.col("is_best"), F.expr("shiftleft(1L, plane)")).otherwise(F.lit(0).cast("long")).alias("best"),
        "dense",
        "bits",
    )
    own = indexed.where(F.col("a").isNull()).select("block", "local", "doc_id", *DOC_FIELDS, "groups_sha256")
    both = own.unionByName(weighed, allowMissingColumns=True)
    ordered = both.repartition("block").sortWithinPartitions("block", F.col("a").isNotNull())
    result = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return ordered.mapInArrow(_finish, result)
