import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidequote.llm import toxicity as T


def _joined(texts):
    texts = [t.encode() for t in texts]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def _sets(texts):
    data, offsets = _joined(texts)
    out = [set() for _ in texts]
    for owner, place in T.features(data, offsets):
        for o, p in zip(owner.tolist(), place.tolist()):
            out[o].add(p)
    return out


def test_features_stay_in_their_text():
    texts = ["you are a clown, really", "", "clown", "you", "a b c d", "é漢 über-words abcdefghij"]
    together = _sets(texts)
    assert together == [_sets([t])[0] for t in texts]
    assert together[2] <= together[0] | _sets(["clown"])[0] and not together[1]
    # words; pairs; triples; pairs with a gap; beginnings of words that are longer
    assert len(together[4]) == 4 + 3 + 2 + 2
    assert len(_sets(["abcdefghij"])[0]) == 1 + len(T.BEGINNINGS)
    assert _sets(["a b"])[0] != _sets(["b a"])[0]


def test_ftrl_is_that_of_the_paper():
    """Against a plain version with one dictionary entry per place."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 30, 8)) for _ in range(60)]
    y = (np.array([3 in r for r in rows]) ^ (rng.random(60) < 0.05)).astype(float)
    seen = np.bincount(np.concatenate(rows), minlength=30)
    z, n, bias_n = dict.fromkeys(range(30), 0.0), dict.fromkeys(range(30), 0.0), 0.0
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = np.log(share / (1 - share))

    def weight(i):
        if abs(z[i]) <= T.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * T.L1) / ((T.BETA + np.sqrt(n[i])) / T.ALPHA + T.L2)

    order = np.random.default_rng(13)
    for _ in range(2):
        for k in order.permutation(60):
            own = [int(i) for i in rows[k] if seen[i] > 1]
            p = 1 / (1 + np.exp(-(bias + sum(map(weight, own)))))
            g = p - y[k]
            for i in own:
                w = weight(i)
                z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / T.ALPHA * w
                n[i] += g * g
            bias_n += g * g
            bias -= T.ALPHA / (T.BETA + np.sqrt(bias_n)) * g
    got = T.fit(rows, y, epochs=2)
    expected = {i: weight(i) for i in range(30) if abs(z[i]) > T.L1}
    assert dict(zip(got.places.tolist(), got.values.tolist())) == pytest.approx(expected, rel=1e-5)
    assert got.bias == pytest.approx(bias)


def test_drawing_does_not_move_the_scores():
    """Toxic rows drawn twice as often with the shift for it, against all rows."""
    rng = np.random.default_rng(4)
    rows = [np.array([1, 2]) if rng.random() < 0.5 else np.array([3, 4]) for _ in range(4000)]
    y = np.array([float(rng.random() < (0.4 if 1 in r else 0.05)) for r in rows])
    kept = (y == 1) | (rng.random(4000) < 0.5)
    drawn = T.fit([r for r, k in zip(rows, kept) if k], y[kept], float(np.log(1 / 0.5)))
    for places, rate in (([1, 2], 0.4), ([3, 4], 0.05)):
        logit = drawn.bias + drawn.dense()[places].sum()
        assert 1 / (1 + np.exp(-logit)) == pytest.approx(rate, abs=0.06)


def test_scores_are_plain_sums():
    weights = T.Weights(np.arange(0, T.DIMENSIONS, 3), np.linspace(-1, 1, len(range(0, T.DIMENSIONS, 3))).astype(np.float32), -0.5)
    texts = ["one two three one two", "", "four " * 500, "über alles é"]
    table = weights.dense()
    got = T._logits(*_joined(texts), table, weights.bias)
    assert got == pytest.approx([weights.bias + sum(float(table[p]) for p in s) for s in _sets(texts)], rel=1e-6)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = T.score_toxicity(docs, T.train(docs, labels))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    toxic, clean = ([r["predicted"] for r in rows if r["toxic"] == k] for k in (1, 0))
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.02
    assert got.count() == docs.count() and got.where("score < 0 or score > 1 or predicted != int(score >= 0.3)").isEmpty()


def test_messy_rows(spark, messy):
    labels = spark.createDataFrame([(0, 1), (4, 0), (5, 1), (5, 0), (None, 1), (6, 0), (7, None), (8, 7), (8, 1)], "doc_id long, toxic int")
    got = T.score_toxicity(messy, T.train(messy, labels)).collect()
    assert len(got) == messy.count() and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1 and not [r for r in got if r["doc_id"] is None and r["held_out"]]


def test_ids_that_repeat_with_other_texts_are_all_learned(spark, monkeypatch):
    own = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2][:60]
    rows = [(i, f"plain words {i}") for i in own] + [(i, f"you clown {i}") for i in own[:30]] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in own[:30])) for i in own], "doc_id long, toxic int")
    weights = T.train(docs, labels)
    got = {r["text"]: r["s"] for r in docs.withColumn("s", F.lit(0)).collect()}
    scored = T.score_toxicity(spark.createDataFrame([(1, "clown"), (2, "words")], "doc_id long, text string"), weights)
    score = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert len(got) == 90 and score[1] > 0.6 > score[2]


def test_without_labels_or_rows(spark, nothing, messy):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    weights = T.train(messy, labels)
    assert all(r["predicted"] == 0 for r in T.score_toxicity(messy, weights).collect())
    assert T.score_toxicity(nothing, weights).collect() == []
