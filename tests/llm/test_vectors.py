import numpy as np
import pytest

from tidequote.llm import gridorder, treesearch
from tidequote.llm.components import smallest_reachable
from tidequote.llm.gridorder import near_vectors
from tidequote.llm.treesearch import grow_tree, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def _vectors(seed, n, dim=16, labels=3, spread=0.08):
    """Clusters of near vectors, exact copies among them."""
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((max(2, n // 25), dim))
    x = centers[rng.integers(0, len(centers), n)] + spread * rng.standard_normal((n, dim)) * rng.integers(0, 3, (n, 1))
    x *= rng.uniform(0.1, 30, (n, 1))
    label = rng.integers(0, labels, n)
    return [(int(k) * 3 % 10_007, [float(v) for v in np.float32(row)], int(lab)) for k, (row, lab) in enumerate(zip(x, label, strict=True))]


ODD = [
    (20_000, None, 1),
    (20_001, [0.0] * 16, 1),
    (20_002, [NAN] + [1.0] * 15, 1),
    (20_003, [INF] + [1.0] * 15, 1),
    (20_004, [None] + [1.0] * 15, 1),
    (20_005, [], 1),
    (20_006, [1.0] * 16, None),
    (20_007, [1.0, 2.0], 1),
    (20_008, [2.0, 4.0], 1),
    (20_009, [1e-30] * 16, 2),
    (20_010, [-0.0] * 15 + [1.0], 2),
    (20_011, [0.0] * 15 + [2.0], 2),
    (20_012, [3e38] * 16, 2),
    (None, [1.0] * 16, 2),
    (20_013, [1.0] * 16, 2),
    (20_013, [1.0] * 16, 2),
]


def _usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def _unit(v):
    x = np.array(v, np.float64)
    return x / np.linalg.norm(x)


def _brute(rows, cosine=0.93):
    at = [k for k, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and _usable(v)]
    n, pairs = [0] * len(rows), []
    for a in at:
        for b in at:
            if a != b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                if _unit(rows[a][1]) @ _unit(rows[b][1]) >= cosine:
                    n[a] += 1
                    pairs.append((rows[a][0], rows[b][0]))
    low = dict(zip(*(x.tolist() for x in smallest_reachable(*np.array(pairs).T)), strict=True)) if pairs else {}
    return sorted((str(i), n[k], str(low.get(i, i))) for k, (i, _, _) in enumerate(rows))


def _check(spark, rows):
    got = near_vectors(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rep", "2 as size")).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == _brute(rows)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("block,fan", [(7, 2), (16, 3), (1024, 8)])
def test_links(spark, monkeypatch, block, fan):
    monkeypatch.setattr(gridorder, "BLOCK", block)
    monkeypatch.setattr(gridorder, "FAN", fan)
    monkeypatch.setattr(gridorder, "ROWS_PER_RANGE", 5 * block)
    _check(spark, _vectors(block, 260) + ODD)


def test_hot_label_and_copies(spark, monkeypatch):
    monkeypatch.setattr(gridorder, "BLOCK", 32)
    rows = [(i, v, 1) for i, v, _ in _vectors(9, 150)]
    rows += [(30_000 + k, rows[3][1], 1) for k in range(120)]
    _check(spark, rows)


def test_threshold(spark):
    at = [np.arccos(0.93) * s for s in (0, 0.999999, 1.000001, 1.999998, 3.1)]
    _check(spark, [(k, [float(np.cos(a)), float(np.sin(a))], 1) for k, a in enumerate(at)])


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_vectors(empty).collect() == []
    assert nearest(empty).collect() == []
    odd = spark.createDataFrame(ODD[:7], SCHEMA)
    assert sorted((r.vec_id, r.n_links) for r in near_vectors(odd).collect()) == [(20_000 + k, 0) for k in range(7)]


def test_grid_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    _check(spark, [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()])


def _true(rows, k, every):
    ids = [i for i, v, _ in rows if i is not None and v and len(v) == 16 and _usable(v)]
    u = {i: _unit(v) for i, v, _ in rows if i in set(ids)}
    out = {}
    for q in ids:
        if q % every == 0:
            near = sorted(((-round(float(u[q] @ u[i]), 9), i) for i in u if i != q))[:k]
            out[q] = near
    return out


@pytest.mark.parametrize("leaf,per_task", [(8, 7), (256, 2048)])
def test_nearest(spark, monkeypatch, leaf, per_task):
    monkeypatch.setattr(treesearch, "LEAF_ROWS", leaf)
    monkeypatch.setattr(treesearch, "ROWS_PER_TASK", per_task)
    monkeypatch.setattr(treesearch, "QUERIES_PER_TASK", per_task)
    rows = _vectors(4, 900) + [(50_000 + k, _vectors(4, 900)[0][1], 2) for k in range(60)]
    seen = set()
    rows = [r for r in rows if not (r[0] in seen or seen.add(r[0]))] + ODD
    got = nearest(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rank", "2 as leaf"), every=5).collect()
    true = _true(rows, 5, 5)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert set(found) == set(true)
    assert all(f == sorted(f) and len(set(f)) == 5 for f in found.values())
    # directions that differ by rounding only are as near as each other
    hits = sum(sum(-near >= -true[q][-1][0] - 1e-6 for near, _ in f) for q, f in found.items())
    assert hits >= 0.95 * 5 * len(true)


def test_all_when_few(spark):
    rows = _vectors(5, 4)
    got = nearest(spark.createDataFrame(rows, SCHEMA), every=1).collect()
    assert len(got) == 4 * 3


def test_tree_holds_every_leaf():
    rng = np.random.default_rng(3)
    u = rng.standard_normal((500, 8))
    u /= np.linalg.norm(u, axis=1)[:, None]
    tree = grow_tree(np.concatenate([u, u[:50]]), 10)
    for row in u[:20]:
        assert sorted(tree.visits(row)) == list(range(tree.leaves))
    assert set(tree.assign(u)) <= set(range(tree.leaves))
    assert np.mean([next(tree.visits(x)) == leaf for x, leaf in zip(u, tree.assign(u), strict=True)]) > 0.5


def test_search_recall_of_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = table.toPandas()
    u = np.stack(rows["embedding"]).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    ids = rows["vec_id"].to_numpy()
    got = nearest(table).toPandas().groupby("query_id")["vec_id"].apply(set)
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        near = u @ u[i]
        near[i] = -9
        want = set(ids[np.lexsort((ids, -near.round(12)))[:5]])
        hits, total = hits + len(want & got[ids[i]]), total + 5
    assert hits >= 0.93 * total


def test_every_length_has_its_own_neighbours(spark):
    """Two embedding models in one table, and a few vectors of a third length."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.standard_normal(4)], 1) for i in range(0, 400)]
    rows += [(i, [float(x) for x in rng.standard_normal(6)], 1) for i in range(1000, 1300)]
    rows += [(5000 + i, [float(i + 1), 1.0], 1) for i in range(3)]
    rows += [(1050, [9.0] * 4, 1)]  # an id with vectors of two lengths is one row
    got = {}
    for r in nearest(spark.createDataFrame(rows, SCHEMA)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {i for i in [*range(0, 400, 50), *range(1000, 1300, 50), 5000]}
    hits = 0
    of = {i: _unit(v) for i, v, _ in rows[:-1]}
    for q, found in got.items():
        others = {i: u for i, u in of.items() if i != q and len(u) == len(of[q])}
        want = sorted(others, key=lambda i: (-round(float(of[q] @ others[i]), 12), i))[:5]
        if q != 1050:
            hits += len(set(want) & set(found))
            assert len(found) == len(want)
    assert hits >= 0.95 * (5 * (len(got) - 2) + 2) and got[5000] == [5001, 5002]


def test_an_id_with_several_vectors(spark):
    """Each row has the links of its own vector; components go through the rows, not the id."""
    at = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [(1, at(0.0), 1), (1, at(2.0), 1), (2, at(0.0), 1), (3, at(0.2), 1), (4, at(-0.2), 1), (9, at(2.1), 1), (8, at(2.1), 1), (8, at(4.0), 1)]
    _check_rows(spark, rows)


def _check_rows(spark, rows):
    u = [_unit(v) for _, v, _ in rows]
    n, root = [], list(range(len(rows)))
    for i in range(len(rows)):
        links = [j for j in range(len(rows)) if j != i and u[i] @ u[j] >= 0.93]
        n.append(len(links))
        for j in links:
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    low = {r: min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in root}
    want = sorted((rows[i][0], n[i], low[root[i]], rows[i][0] == low[root[i]]) for i in range(len(rows)))
    got = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want
