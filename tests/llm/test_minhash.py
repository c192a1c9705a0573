import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidequote.llm import minhash, textbytes
from tidequote.llm.components import components, smallest_reachable
from tidequote.llm.minhash import hash_functions, keep_one, near_duplicates
from tidequote.llm.shingles import min_max_signatures, shingle_sets
from tidequote.sources.landing import land


def _set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)])


def _brute(rows, words, percent):
    """By all pairs: (doc_id, set size, smallest reachable), as a bag."""
    sets = [_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None:
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    root[find(i)] = find(j)
    low = defaultdict(lambda: float("inf"))
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low[find(i)], doc)
    return Counter((d, len(s), None if d is None else low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def _variants(seed, groups, members, words, edits):
    """Groups of near copies of one text, some of which share a passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = rng.choices(vocabulary, k=words // 2)
    rows = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=words)
        if g % 2:
            base[: len(passage)] = passage
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 100_003, " ".join(text)))
    return rows


def _check(spark, docs, words=3, percent=85):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = near_duplicates(docs, words, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _brute(rows, words, percent)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_table(spark, documents):
    _check(spark, documents)
    _check(spark, documents, 5, 80)


def test_messy(spark, messy, nothing):
    _check(spark, messy)
    assert near_duplicates(nothing).collect() == []


@pytest.mark.parametrize("block", [3, 1024])
def test_chains_and_passages(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = _variants(block, 12, 25, 60, 5)
    random.Random(1).shuffle(rows)
    _check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_threshold_is_exact(spark):
    base = [f"v{k}" for k in range(37 * 3)]
    rows = [(0, " ".join(base))]
    for n in range(1, 40):
        rows.append((n, " ".join(base[: -n] + [f"x{n}"] * n)))
    _check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    flat = np.concatenate([both, a, both, b])
    s = min_max_signatures(flat, np.array([0, 800, 800, 1600]), 500)
    assert abs((s[0] == s[2]).mean() - 0.6) < 0.06
    assert not s[1].any()


def test_bands_suffice():
    for percent in (80, 85, 95):
        bands = 2 * hash_functions(percent) // minhash.ROWS_PER_BAND
        assert (1 - (percent / 100) ** minhash.ROWS_PER_BAND) ** bands <= minhash.MISSED


def test_keep_one(messy, documents, nothing):
    for docs in (messy, documents):
        marks = {r.doc_id: r.kept for r in near_duplicates(docs, 5, 80).collect()}
        got = keep_one(docs, 5, 80)
        assert got.columns == docs.columns
        rows = got.collect()
        seen = Counter((r.doc_id, r.text) for r in rows if r.doc_id is not None)
        assert set(seen.values()) == {1}
        assert {d for d, _ in seen} == {d for d, kept in marks.items() if kept and d is not None}
        assert sum(r.doc_id is None for r in rows) == docs.where("doc_id is null").count()
    assert keep_one(nothing, 5, 80).collect() == []


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = np.random.default_rng(2)
    n = 400
    order = rng.permutation(n)
    pairs = {
        "chain": [(int(order[k]), int(order[k + 1])) for k in range(n - 1) if k % 97],
        "star": [(0, k) for k in range(1, n)] + [(k, 0) for k in range(n)],
        "random": [tuple(map(int, rng.integers(0, n, 2))) for _ in range(330)],
        "none": [],
    }[shape]
    links = spark.createDataFrame(pairs + [(None, 3), (5, 5)], "a long, b long")
    got = {r.id: r.component_id for r in components(links).collect()}
    if pairs:
        v, root = smallest_reachable(*np.array(pairs).T)
        assert got == {int(a): int(b) for a, b in zip(v, root, strict=True) if a != b}
    else:
        assert got == {}


def test_rounds_of_few_links_are_few_files(spark, monkeypatch):
    """With 24 shuffle partitions that nothing merges, only the first round has a file for each."""
    files = []

    def counted(df, name):
        landed = land(df, name)
        files.append((name, len(landed.inputFiles())))
        return landed

    monkeypatch.setattr("tidequote.llm.components.land", counted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        links = spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long")
        assert {r.component_id for r in components(links).collect()} == {0}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [n for _, n in files[1:]] == [1] * (len(files) - 1) and len(files) > 3


@pytest.fixture
def many_partitions(spark):
    """24 shuffle partitions that nothing merges."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _counted(monkeypatch, modules):
    files = []

    def counted(df, name):
        landed = land(df, name)
        files.append((name, len(landed.inputFiles())))
        return landed

    for module in modules:
        monkeypatch.setattr(f"tidequote.llm.{module}.land", counted)
    return files


def test_few_rows_are_few_files(spark, monkeypatch, many_partitions):
    """Of 24 shuffle partitions none is a file of its own, in any step or in the result; the rows are the same."""
    files = _counted(monkeypatch, ["minhash", "components"])
    docs = spark.createDataFrame(_variants(5, 6, 25, 60, 5), "doc_id long, text string").coalesce(1)
    _check(spark, docs)
    assert {"classes", "members", "sets", "links", "stars", "open", "dealt", "more"} <= {name for name, _ in files}
    assert {n for _, n in files} == {1}
    assert near_duplicates(docs).rdd.getNumPartitions() == 1


@pytest.mark.parametrize("limit", ["ROWS_PER_TASK", "SHINGLES_PER_TASK"])
def test_more_rows_or_longer_texts_are_more_tasks(spark, monkeypatch, many_partitions, limit):
    """Tasks follow the rows and the sizes of sets, and matches that share a task stay whole."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, limit, 64)
    files = _counted(monkeypatch, ["minhash"])
    _check(spark, spark.createDataFrame(_variants(6, 6, 25, 60, 5), "doc_id long, text string"))
    assert dict(files)["sets"] > 8


def test_words_are_hashed_in_small_memory():
    """A chunk's arrays and the powers kept are of half a megabyte of text, not of two."""
    texts = [f"word{k} other{k % 7} " * 40 for k in range(4000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    textbytes._powers.clear()
    tracemalloc.start()
    got = [flat for _, flat, _ in shingle_sets(batch, 3)]
    most = tracemalloc.get_traced_memory()[1] - sum(f.nbytes for f in got)
    tracemalloc.stop()
    assert most < 50 << 20
    assert sum(p.nbytes for p in textbytes._powers.values()) <= 16 * textbytes.WORD_BYTES
    one_by_one = [flat for k in range(len(texts)) for _, flat, _ in shingle_sets(batch.slice(k, 1), 3)]
    assert np.array_equal(np.concatenate(got), np.concatenate(one_by_one))


def test_an_id_with_several_texts(spark):
    """A link goes to the text, not to whatever text its id has."""
    words = [f"w{i}" for i in range(40)]
    first, second = " ".join(words[:12]), " ".join(words[20:33])
    near = second + " more"
    rows = [(1, first), (1, second), (3, near), (3, "a text of its own that nothing is near to"), (7, first), (7, first), (8, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = {t: len(t.split()) - 2 for _, t in rows}
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    alone = rows[3][1]
    want = [(i, sizes[t], 3 if t == alone else 1, i == (3 if t == alone else 1)) for i, t in rows]
    assert got == sorted(want)
    kept = sorted((r["doc_id"], r["text"]) for r in keep_one(docs).collect())
    assert kept == sorted([(1, first), (1, second), (3, alone)])
