import zlib

import numpy as np
import pytest

from tidequote.llm import quality as Q

GOOD, BAD = b"the and of reading ", b"%%% ### &&& $$$ "


def _joined(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in Q.new_params(rng).items()}
    p["hidden_bias"] += 0.1
    texts = [bytes(rng.integers(32, 127, n).astype(np.uint8)) for n in (700, 40, 256, 3)]
    y, weight = np.array([1, 0, 0, 1]), np.ones(4)
    cells, first = Q.cells_of(*_joined(texts))

    def loss():
        s = np.clip(Q.scores(*_joined(texts), p), 1e-12, 1 - 1e-12)
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    g = Q._gradients(cells, first, y, weight, p)
    for name in ("out", "vote", "hidden", "hidden_bias", "bias", "filter", "embed"):
        flat = p[name].reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            kept = flat[i]
            flat[i] = kept + 1e-5
            up = loss()
            flat[i] = kept - 1e-5
            down = loss()
            flat[i] = kept
            assert g[name].reshape(-1)[i] == pytest.approx((up - down) / 2e-5, rel=2e-2, abs=2e-4), name


def test_scores_do_not_depend_on_neighbours():
    p = Q.new_params(np.random.default_rng(2))
    texts = [GOOD * 300, b"", BAD * 5, GOOD, BAD * 2000]
    together = Q.scores(*_joined(texts), p)
    alone = [Q.scores(*_joined([t]), p)[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6)


def test_the_whole_text_counts():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.permutation(list(GOOD * 20)).astype(np.uint8)) for _ in range(30)]
    bad = [t[:-90] + BAD * 5 + t[-10:] for t in texts]
    p = Q.fit(texts + bad, np.array([1] * 30 + [0] * 30), epochs=25)
    long = b"".join(texts) * 3
    clean, spoilt = Q.scores(*_joined([long, long + BAD * 20]), p)
    assert clean > 0.5 > spoilt


def _rows(spark, n):
    labelled = [(k, (GOOD if k % 2 else BAD).decode() * (k % 7 + 1), k % 2) for k in range(n)]
    return (
        spark.createDataFrame([r[:2] for r in labelled], "doc_id long, text string"),
        spark.createDataFrame([(r[0], r[2]) for r in labelled], "doc_id long, quality int"),
    )


def test_only_rows_not_held_out_are_learned(spark, monkeypatch):
    docs, labels = _rows(spark, 60)
    seen = {}
    monkeypatch.setattr(Q, "fit", lambda texts, y, *_: seen.update(texts=texts, y=y) or {})
    Q.train(docs, labels.unionByName(labels.selectExpr("doc_id", "null as quality")))
    kept = [k for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1]
    assert len(seen["texts"]) == len(kept)
    assert seen["y"].tolist() == [k % 2 for k in kept]


def test_the_sample_is_bounded(spark, monkeypatch):
    docs, labels = _rows(spark, 60)
    seen = {}
    monkeypatch.setattr(Q, "fit", lambda texts, y, *_: seen.update(y=y) or {})
    Q.train(docs, labels, per_label=4)
    assert sorted(seen["y"]) == [0] * 4 + [1] * 4


def test_messy_rows(spark, messy, nothing):
    p = Q.new_params(np.random.default_rng(4))
    got = Q.score_quality(messy, p).collect()
    rows = messy.select("doc_id", "text").collect()
    assert sorted((g.doc_id is None, g.doc_id or 0) for g in got) == sorted((r.doc_id is None, r.doc_id or 0) for r in rows)
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) for g in got)
    assert all(g.held_out == (g.doc_id is not None and zlib.crc32(str(g.doc_id).encode()) % 3 == 1) for g in got)
    assert len({g.score for g in got if g.doc_id in (1, 2)}) == 1
    kept = Q.keep_good(messy, p)
    assert kept.columns == messy.columns
    good = sum(g.predicted for g in got)
    assert kept.count() == good
    assert Q.score_quality(nothing, p).collect() == []
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert set(Q.train(messy, labels)) == set(p)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = Q.score_quality(docs, Q.train(docs, labels)).where("held_out").join(labels, "doc_id").toPandas()
    assert (scored["predicted"] == scored["quality"]).mean() > 0.93
    again = Q.train(docs, labels)
    assert all((again[k] == v).all() for k, v in Q.train(docs, labels).items())
