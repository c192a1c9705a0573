import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidequote.llm import maxent as M
from tidequote.llm.maxent import Index, score_texts


def _tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def _held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def _check(docs):
    rows = [(r.doc_id, _tokens(r.text)) for r in docs.select("doc_id", "text").collect()]
    c = Counter(t for d, tokens in rows if not _held(d) for t in tokens)
    n, total = sum(c.values()), math.log10(sum(c.values()) + len(c) + 1)
    want = sorted(
        (str(d), _held(d), len(t), sum(c[x] > 0 for x in t), n, round(sum(math.log10(c[x] + 1) - total for x in t), 4))
        for d, t in rows
    )
    got = score_texts(docs).collect()
    own = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got)
    assert [w[:5] for w in want] == [o[:5] for o in own]
    assert all(abs(a[5] - b[5]) < 1e-3 * max(1, abs(a[5]) / 1e3) for a, b in zip(want, own, strict=True))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    return got


def test_base(documents, messy):
    _check(documents)
    _check(messy)


def test_rare_words_meet_their_counts(documents, monkeypatch):
    monkeypatch.setattr(M, "HELD_ENTRIES", 50)  # counts are handed on in many parts
    rows = [(r.doc_id, _tokens(r.text)) for r in documents.select("doc_id", "text").collect()]
    c = Counter(t for d, tokens in rows if not _held(d) for t in tokens)
    total = math.log10(sum(c.values()) + len(c) + 1)
    want = {d: sum(math.log10(c[x] + 1) - total for x in t) for d, t in rows}
    for r in score_texts(documents, vocabulary=5).collect():
        assert r.base_score == pytest.approx(want[r.doc_id], rel=1e-6)


def test_nothing_to_learn(spark, nothing):
    assert score_texts(nothing).collect() == []
    held = [k for k in range(100) if _held(k)][:3]
    docs = spark.createDataFrame([(k, "some words") for k in held], "doc_id long, text string")
    assert [(r.base_score, r.score, r.n_known, r.train_tokens) for r in score_texts(docs).collect()] == [(0, 0, 0, 0)] * 3


def test_probabilities_sum_to_one(documents):
    train = documents.where(~M.held_out()).select("doc_id", "text")
    model = M.fit(train, M.word_counts(train), vocabulary=50)
    features = np.random.default_rng(1).integers(0, M.ROWS, (40, 4)).astype(np.uint16)
    assert np.allclose(M._class_probabilities(model.weights, features).sum(1), 1, atol=1e-5)
    # within classes: vocabulary words of a class, and rare words with one unseen
    for k in set(model.of_class[: len(model.keys)].tolist()):
        assert (10 ** model.within[model.of_class[: len(model.keys)] == k]).sum() == pytest.approx(1)
    counts = {r.word: r.c for r in M.word_counts(train).collect()}
    known = set(model.keys.view(np.int64).tolist()) | {int(M.END)}
    rare = [c for w, c in counts.items() if w not in known]
    assert sum((c + 1) / model.rare_total for c in rare) + 1 / model.rare_total == pytest.approx(1)


def test_row_sums():
    rng = np.random.default_rng(2)
    rows = np.minimum(rng.geometric(0.02, (500, 4)), 300).astype(np.uint16)
    values = rng.standard_normal((500, 6))
    at, times, sums = M._row_sums(rows, values)
    want = np.zeros((301, 6))
    np.add.at(want, rows.ravel(), np.repeat(values, 4, axis=0))
    assert np.allclose(want[at], sums)
    assert (np.bincount(rows.ravel(), minlength=301)[at] == times).all() and times.sum() == rows.size


def test_index():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(1, 2**63, 1000, np.uint64))
    rng.shuffle(keys)
    index = Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(np.array([0, 5, 2**64 - 1], np.uint64)) == -1).all()
    assert (Index(keys[:0]).find(keys) == -1).all()


def test_held_out_texts_are_likelier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = score_texts(docs).where("held_out").toPandas()
    assert held["score"].sum() > held["base_score"].sum()
    assert (held["score"] > held["base_score"]).mean() > 0.8


def test_classes_come_from_ten_dimensions():
    model = M.Model(np.arange(1, 6, dtype=np.uint64), np.ones(5, np.int64), 6, 6, 1, np.zeros(8, np.int64),
                  np.zeros((M.ROWS + 1, 32), np.float32), np.zeros(M.ROWS + 1))
    assert M._signs(model).shape[0] == 10
