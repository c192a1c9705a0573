"""Language-model scores of a hashed maximum-entropy model (operator 10).

Training words are counted exactly. The most frequent ``VOCABULARY`` of them are grouped into
classes by the company they keep; all others share one class, in which they keep their own
counts, and the end of a text is a class. The model is
``P(token) = P(class | features) * P(token | class)``: the first factor is a softmax over classes
with weights of hashed features (the word before, the pair before, words two and three back), the
second a softmax with one weight per word, whose best value is the logarithm of its count.

Weights are learned by distributed gradient updates: in each round all tasks start from the same
weights and update them over their share of the training texts; the updates are averaged row by
row, each task's by the tokens it saw with that feature. Every training text is used once.

Only vocabulary, classes and weights, of fixed size, are broadcast. Rare words meet their counts
in a shuffle, summed up by text and word beforehand; none of them is frequent enough to be hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidequote.llm.textbytes import mixed, words
from tidequote.sources.landing import land

VOCABULARY = 1 << 16
CLASSES = 32
ROWS = 1 << 14
ROUNDS = 4
BATCH = 8192
RATE = 0.3
SIGNATURE = 10
HELD_ENTRIES = 1 << 21
END = np.uint64(0)  # the hash that stands for the end of a text

_FEATURES = 4  # besides the bias, which is the last row of the weights
_MANY = 16


def held_out(id_col: str = "doc_id") -> Column:
    """Rows from which nothing is learned: crc32 of the id as text leaves 2 modulo 7."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c): how often each word, by its 64-bit hash, and the end occur."""

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        key, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return key, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for rows, word, _ in words(batch):
                held.append(np.unique(word, return_counts=True))
                held.append((np.array([END]), np.array([rows.num_rows])))
                if sum(len(p[0]) for p in held) > HELD_ENTRIES:
                    held = [summed(held)]
                    if len(held[0][0]) > HELD_ENTRIES // 2:
                        yield _counted(*held.pop())
        if held:
            yield _counted(*summed(held))

    parts = train.select("text").mapInArrow(count, "word long, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def _counted(key: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(key.view(np.int64)), pa.array(c.astype(np.int64))], names=["word", "c"])


class Index:
    """Numbers of the vocabulary's words, by open addressing; -1 for other words."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(6, int(4 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.number = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys))
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            free = self.number[slot] < 0
            self.keys[slot[free]], self.number[slot[free]] = keys[left[free]], left[free]
            lost = self.keys[slot] != keys[left]
            left, slot = left[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)

    def find(self, word: np.ndarray) -> np.ndarray:
        slot = (word >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[slot] == word, self.number[slot], -1)
        left = np.flatnonzero((self.keys[slot] != word) & (self.number[slot] >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            at = slot[left]
            hit = self.keys[at] == word[left]
            out[left[hit]] = self.number[at[hit]]
            left = left[~hit & (self.number[at] >= 0)]
        return out


@dataclass
class Model:
    """``keys`` are the vocabulary's hashes, the most frequent first, with their ``counts``.

    Tokens are numbered: a word of the vocabulary by its place, then rare, end and start.
    """

    keys: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int
    ends: int
    of_class: np.ndarray
    weights: np.ndarray
    moved: np.ndarray

    def __post_init__(self):
        self.index = Index(self.keys)
        n = len(self.keys)
        self.rare, self.end, self.start = n, n + 1, n + 2
        number = np.arange(n + 3, dtype=np.uint64)
        self.rows = [
            (mixed(number * np.uint64(8) + np.uint64(k)) % np.uint64(ROWS)).astype(np.uint16) for k in range(3)
        ]
        mass = np.bincount(self.of_class[:n], self.counts, CLASSES)
        self.within = np.log10(self.counts / np.maximum(mass[self.of_class[:n]], 1)) if n else np.empty(0)
        self.rare_total = self.tokens - self.ends - int(self.counts.sum()) + self.distinct - n - (self.ends > 0) + 1

    def sequence(self, word: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token numbers with the ends, their text, place in the text)."""
        size = np.bincount(owner, minlength=texts) + 1
        ids = np.full(len(word) + texts, self.end, np.int32)
        found = self.index.find(word)
        ids[np.arange(len(word)) + owner] = np.where(found < 0, self.rare, found)
        of = np.repeat(np.arange(texts), size)
        return ids, of, np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)

    def before(self, ids: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
        out = np.full(len(ids), self.start, np.int32)
        out[k:] = np.where(place[k:] >= k, ids[:-k] if k else ids, self.start)
        return out

    def features(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        """(tokens, features) of rows of the weights; small numbers, so that they sort by radix."""
        one, two, three = (self.before(ids, place, k) for k in (1, 2, 3))
        pair = mixed(two.astype(np.uint64) << np.uint64(32) | one.astype(np.uint64)) % np.uint64(ROWS)
        return np.stack([self.rows[0][one], self.rows[1][two], self.rows[2][three], pair.astype(np.uint16)], 1)


def _class_probabilities(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    z = weights[features[:, 0]]
    for k in range(1, _FEATURES):
        z += weights[features[:, k]]
    z += weights[ROWS]
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def _row_sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows, how often each occurs, sums of their values), feature by feature.

    Most rows occur a few times in a batch: their first values are added at once, then their
    second ones, and so on; the few frequent rows are summed on their own.
    """
    flat = rows.T.ravel()
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.diff(np.append(first, len(flat)))
    source = order % len(rows)
    sums = values[source[first]]
    for i in np.flatnonzero(size > _MANY):
        sums[i] = values[source[first[i] : first[i] + size[i]]].sum(0)
    left, k = np.flatnonzero((size > 1) & (size <= _MANY)), 1
    while len(left):
        sums[left] += values[source[first[left] + k]]
        k += 1
        left = left[size[left] > k]
    return ordered[first], size, sums


def update(weights: np.ndarray, moved: np.ndarray, seen: np.ndarray, features: np.ndarray, target: np.ndarray) -> None:
    """Gradient steps over tokens, in batches; each row has its own rate that falls as it moves."""
    for a in range(0, len(target), BATCH):
        own, y = features[a : a + BATCH], target[a : a + BATCH]
        error = _class_probabilities(weights, own)
        error[np.arange(len(y)), y] -= 1
        at, times, slope = _row_sums(own, error)
        at, times = np.append(at.astype(np.int64), ROWS), np.append(times, len(y))
        slope = np.concatenate([slope, error.sum(0, keepdims=True)])
        seen[at] += times
        moved[at] += np.einsum("ij,ij->i", slope, slope) / CLASSES
        slope *= (RATE / np.sqrt(moved[at] + 1.0)).astype(np.float32)[:, None]
        weights[at] -= slope


def _signatures(train: DataFrame, model: Model) -> np.ndarray:
    """For each word of the vocabulary the mean sign vector of its neighbours within two words."""
    shared = train.sparkSession.sparkContext.broadcast(model)
    n = len(model.keys)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        signs = _signs(model)
        total = np.zeros((SIGNATURE, n + 3))
        for batch in batches:
            for rows, word, owner in words(batch):
                ids, _, place = model.sequence(word, owner, rows.num_rows)
                for k in (1, 2):
                    back = model.before(ids, place, k)
                    for d in range(SIGNATURE):
                        total[d] += np.bincount(ids, signs[d][back], n + 3)
                        total[d] += np.bincount(back, signs[d][ids], n + 3)
        filled = np.flatnonzero(total[:, :n].any(0))
        columns = [pa.array(filled.astype(np.int32)), *(pa.array(total[d, filled]) for d in range(SIGNATURE))]
        yield pa.record_batch(columns, names=["word", *names])

    names = [f"d{k}" for k in range(SIGNATURE)]
    parts = train.select("text").mapInArrow(gather, "word int, " + ", ".join(f"{c} double" for c in names))
    out = np.zeros((n, SIGNATURE))
    table = parts.groupBy("word").agg(*[F.sum(c).alias(c) for c in names]).toArrow()  # at most the vocabulary
    out[table.column("word").to_numpy()] = np.stack([table.column(c).to_numpy() for c in names], 1)
    return out / np.maximum(model.counts, 1)[:, None]


def _signs(model: Model) -> np.ndarray:
    key = mixed(np.concatenate([model.keys, np.arange(3, dtype=np.uint64)]) + np.uint64(77))
    signs = np.stack([((key >> np.uint64(d)) & np.uint64(1)).astype(float) * 2 - 1 for d in range(SIGNATURE)])
    signs[:, -3:] = 0
    return signs


def _classes(signature: np.ndarray, counts: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Class of each word by weighted k-means; 0 is the rare words' class and 1 the end's."""
    k = min(CLASSES - 2, len(signature))
    if not k:
        return np.empty(0, np.int64)
    weight = np.sqrt(counts.astype(float))
    centers = signature[rng.choice(len(signature), k, replace=False, p=weight / weight.sum())]
    nearest = np.zeros(len(signature), np.int64)
    for _ in range(15):
        nearest = ((centers * centers).sum(1) - 2 * signature @ centers.T).argmin(1)
        mass = np.bincount(nearest, weight, k)
        sums = np.stack([np.bincount(nearest, weight * signature[:, d], k) for d in range(signature.shape[1])], 1)
        centers = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-12)[:, None], centers)
    return nearest + 2


def _round(train: DataFrame, model: Model, turn: int, rounds: int) -> None:
    """One round of gradient updates over the texts whose turn it is; changes ``model``."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights, moved, seen = model.weights.copy(), model.moved.copy(), np.zeros(ROWS + 1)
        for batch in batches:
            for rows, word, owner in words(batch):
                ids, _, place = model.sequence(word, owner, rows.num_rows)
                update(weights, moved, seen, model.features(ids, place), model.of_class[ids])
        at = np.flatnonzero(seen)
        step, gone = weights[at] - model.weights[at], moved[at] - model.moved[at]
        columns = [at.astype(np.int32), seen[at], gone, *step.T.astype(np.float32)]
        yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], names=["at", "seen", "gone", *names])

    names = [f"w{k}" for k in range(CLASSES)]
    own = train.where(F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(rounds)) == turn).select("text")
    schema = "at int, seen double, gone double, " + ", ".join(f"{c} float" for c in names)
    sums = [F.sum("seen").alias("seen"), F.sum("gone").alias("gone")]
    sums += [F.sum(F.col(c) * F.col("seen")).alias(c) for c in names]
    table = own.mapInArrow(learn, schema).groupBy("at").agg(*sums).toArrow()  # at most ROWS + 1
    at, seen = table.column("at").to_numpy(), table.column("seen").to_numpy()
    step = np.stack([table.column(c).to_numpy() for c in names], 1) / seen[:, None] if len(at) else np.zeros((0, CLASSES))
    model.weights[at] += step.astype(np.float32)
    model.moved[at] += table.column("gone").to_numpy()


def fit(train: DataFrame, counts: DataFrame, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> Model:
    """Learns from all rows of ``train`` (doc_id, text), whose word counts are ``counts``."""
    end = int(END)
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == end, F.col("c"))).alias("e")).first()
    top = counts.where(F.col("word") != end).orderBy(F.desc("c"), "word").limit(vocabulary).toArrow()
    keys = top.column("word").to_numpy().astype(np.int64).view(np.uint64)
    own = top.column("c").to_numpy().astype(np.int64)
    of_class = np.concatenate([np.full(len(keys), 2), [0, 1, 0]]).astype(np.int64)
    model = Model(
        keys, own, total["n"] or 0, total["v"] or 0, total["e"] or 0, of_class,
        np.zeros((ROWS + 1, CLASSES), np.float32), np.zeros(ROWS + 1),
    )
    if len(keys):
        of_class[: len(keys)] = _classes(_signatures(train, model), own, np.random.default_rng(3))
        model.__post_init__()
    for turn in range(rounds):
        _round(train, model, turn, rounds)
    return model


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per text: what the vocabulary gives, and its rare words with their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        done = TaskContext.get().partitionId() << 40
        base_of = np.concatenate([np.log10(model.counts + 1.0), [0.0, np.log10(model.ends + 1.0), 0.0]])
        within = np.concatenate([model.within, [-np.log10(model.rare_total), 0.0, 0.0]])
        for batch in batches:
            for rows, word, owner in words(batch):
                n = rows.num_rows
                ids, of, place = model.sequence(word, owner, n)
                own = within[ids]
                features, target = model.features(ids, place), model.of_class[ids]
                for a in range(0, len(ids), BATCH):
                    p = _class_probabilities(model.weights, features[a : a + BATCH])
                    y = target[a : a + BATCH]
                    own[a : a + BATCH] += np.log10(np.maximum(p[np.arange(len(y)), y], 1e-30))
                known = np.bincount(of, ids < len(model.keys), n).astype(np.int64) + (model.ends > 0)
                rare = np.flatnonzero(ids == model.rare)
                of_rare, rare_word = of[rare], word[rare - of[rare]]
                order = np.lexsort((rare_word, of_rare))
                of_rare, rare_word = of_rare[order], rare_word[order]
                new = np.ones(len(order), bool)
                new[1:] = (of_rare[1:] != of_rare[:-1]) | (rare_word[1:] != rare_word[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                cuts = pa.array(np.searchsorted(of_rare[first], np.arange(n + 1)).astype(np.int32))
                yield pa.record_batch(
                    [
                        pa.array(np.arange(done, done + n)),
                        rows.column("doc_id"),
                        pa.array(np.bincount(of, minlength=n)),
                        pa.array(known),
                        pa.array(np.bincount(of, base_of[ids], n)),
                        pa.array(np.bincount(of, own, n)),
                        pa.ListArray.from_arrays(cuts, pa.array(rare_word[first].view(np.int64))),
                        pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                    ],
                    names=["row", "doc_id", "n_tokens", "known", "base", "own", "rare", "times"],
                )
                done += n

    schema = "row long, doc_id long, n_tokens long, known long, base double, own double, rare array<long>, times array<int>"
    return docs.mapInArrow(score, schema)


def score_texts(docs: DataFrame, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``base_score`` is the add-one unigram log10 probability with counts of the training texts,
    ``score`` the model's. A null or empty text is its end alone; a null id is not held out;
    repeated rows are scored one by one and count in training one by one; with no training text
    both scores are 0 for every text; an empty table gives an empty result; only ``doc_id`` and
    ``text`` are read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    train = own.where(~held_out())
    counts = land(word_counts(train), "counts")
    model = fit(train, counts, vocabulary, rounds)
    scored = land(_scored(own, model), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r"))
    rare = rare.select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    rare = rare.join(counts, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum("times").alias("found")
    )
    total = float(np.log10(model.tokens + model.distinct + 1.0))
    more = F.coalesce("more", F.lit(0.0))
    out = scored.drop("rare", "times").join(rare, "row", "left")
    base = F.col("base") + more - F.col("n_tokens") * total
    return out.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("own") + more if model.tokens else base).alias("score"),
    )
