from __future__ import annotations

import brute
import numpy as np
import pytest
from samples import SF
from pyspark.sql import functions as F

from ledgerline.llm import lattice, vp_trees
from ledgerline.llm.lattice import near_duplicate_vectors, nearest_e8, shortest_e8
from ledgerline.llm.vp_trees import Search, Tree, nearest

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, node string"


def edge_vectors():
    r = np.random.default_rng(4)
    rows = []
    for k in range(60):
        base = r.standard_normal(16)
        rows.append((3 * k, base.tolist(), k % 3))
        rows.append((3 * k + 1, (base + 0.05 * r.standard_normal(16)).tolist(), k % 3))
    same = rows[5][1]
    rows += [(1_000 + k, same, 1) for k in range(40)] + [(1_000, same, 1), (1_100, same, None), (1_101, same, 0)]
    rows += [(1_200, None, 1), (1_201, [], 1), (1_202, [0.0] * 16, 1), (1_203, [0.0] * 16, 1), (1_204, [-0.0] * 16, 1)]
    rows += [(1_205, [NAN, *same[1:]], 1), (1_206, [INF, *same[1:]], 1), (1_207, [None, *same[1:]], 1)]
    rows += [(1_208, same[:8], 1), (1_209, same[:8], 1), (1_210, [1.0, 0.0] * 8, 2), (1_211, [1.0, -0.0] * 8, 2)]
    return [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v], p) for i, v, p in rows]


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(*r, "odd", "odd", "odd") for r in edge_vectors()]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_e8():
    steps = shortest_e8()
    assert len({tuple(s) for s in steps}) == 240 and set((steps**2).sum(1)) == {8}
    x = np.random.default_rng(1).standard_normal((300, 8)) * 2
    own = nearest_e8(x)
    near = ((2 * x - own) ** 2).sum(1)
    # No neighbouring lattice point is nearer, and the point is in the lattice.
    assert all((near <= ((2 * x - own - s) ** 2).sum(1) + 1e-9).all() for s in steps)
    assert ((own % 2 == own[:, :1] % 2).all(1) & (own.sum(1) % 4 == 0)).all()


@pytest.mark.parametrize("crowded", [False, True])
def test_links(vectors, crowded, monkeypatch):
    if crowded:
        monkeypatch.setattr(lattice, "CELL_ROWS", 3)
        monkeypatch.setattr(lattice, "BLOCK", 4)
    got = sorted(tuple(r) for r in near_duplicate_vectors(vectors).collect())
    assert got == sorted(brute.linked_vectors(edge_vectors()))


def test_recall_at_the_threshold(spark):
    """Pairs just above it, one by one, in as many dimensions as the table has."""
    r = np.random.default_rng(6)
    rows = []
    for k in range(400):
        u, w = r.standard_normal((2, 64))
        u /= np.linalg.norm(u)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        rows += [(2 * k, u.tolist(), 0), (2 * k + 1, (0.932 * u + np.sqrt(1 - 0.932**2) * w).tolist(), 0)]
    got = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert got.where("n_links > 0").count() / 800 >= 0.95


def test_text_labels(spark):
    rows = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.01], "a"), (3, [1.0, 0.0], "b"), (4, [1.0, 0.0], None)]
    got = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]


def expected_nearest(rows, k, asks):
    rows = [(i, np.array(v, float)) for i, v, _ in rows if brute.usable(v) and i is not None]
    out = []
    for q, x in rows:
        if asks(q):
            found = [(-(x * y).sum(), i) for i, y in rows if i != q and len(x) == len(y)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)]
    return out


def rounded(rows):
    return sorted((q, rank, i, round(s, 9)) for q, rank, i, s in rows)


def test_factor_one_is_exact(vectors):
    got = nearest(vectors, F.col("vec_id") % 10 == 0, factor=1.0, shard_rows=40, k=20)
    expected = {(q, r): (i, s) for q, r, i, s in expected_nearest(edge_vectors(), 20, lambda q: q % 10 == 0)}
    rows = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got.where("query_id <> 1000").collect()}
    assert len(rows) == sum(q != 1_000 for q, _ in expected)
    for key, (i, s) in rows.items():
        assert (i, round(s, 9)) == (expected[key][0], round(expected[key][1], 9)), key


def test_repeated_id_asks_twice_but_is_not_its_own_neighbour(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (None, [3.0, 0.0])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 1.0), (0, 2, 2, 0.5)]


def test_recall_of_the_relaxed_search(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    expected = {(q, i) for q, _, i, _ in expected_nearest(rows, 20, lambda q: q % 20 == 0)}
    got = {(r.query_id, r.vec_id) for r in nearest(table, F.col("vec_id") % 20 == 0, shard_rows=100).collect()}
    assert len(got) == len(expected) and len(got & expected) / len(expected) >= 0.95


def unequal_norms(r):
    x = r.standard_normal((vp_trees.SHARD_ROWS, 64))
    return x * r.lognormal(0, 0.5, (len(x), 1))


def clusters(r):
    centres = 3 * r.standard_normal((40, 64))
    return centres[r.integers(0, 40, vp_trees.SHARD_ROWS)] + 0.3 * r.standard_normal((vp_trees.SHARD_ROWS, 64))


def low_rank(r):
    return r.standard_normal((vp_trees.SHARD_ROWS, 4)) @ r.standard_normal((4, 64))


@pytest.mark.parametrize("make", [unequal_norms, clusters, low_rank])
def test_recall_at_the_default_factor(make):
    """Unequal norms and clusters, in a whole shard."""
    x = make(np.random.default_rng(11))
    largest = np.sqrt((x * x).sum(1).max())
    tree = Tree(np.hstack([x, np.sqrt(np.maximum(largest**2 - (x * x).sum(1), 0))[:, None]]))
    search = Search(tree, x, np.arange(len(x)), largest, vp_trees.K + 1, vp_trees.FACTOR)
    scores, _ = search.run(x[:100])
    assert np.allclose(scores, -np.sort(-(x[:100] @ x.T), axis=1)[:, : vp_trees.K + 1])


def test_larger_factors_look_at_less():
    r = np.random.default_rng(8)
    x = np.concatenate([c + 0.1 * r.standard_normal((200, 4)) for c in 3 * r.standard_normal((8, 4))])
    largest = np.sqrt((x * x).sum(1).max())
    tree = Tree(np.hstack([x, np.sqrt(largest**2 - (x * x).sum(1))[:, None]]))
    looked = []
    for factor in (1.0, 4.0, 50.0):
        search = Search(tree, x, np.arange(len(x)), largest, 10, factor)
        seen, improve = [0], search._improve
        search._improve = lambda active, rows: (seen.__setitem__(0, seen[0] + len(active) * len(rows)), improve(active, rows))
        scores, _ = search.run(x[:50])
        looked.append(seen[0])
        if factor == 1.0:
            assert np.allclose(scores, -np.sort(-(x[:50] @ x.T), axis=1)[:, :10])
    assert looked[0] < 50 * len(x) and looked == sorted(looked, reverse=True)


def test_empty(vectors):
    none = vectors.limit(0)
    assert nearest(none, F.col("vec_id") % 20 == 0).count() == 0
    assert near_duplicate_vectors(none).count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_lengths_never_meet(spark, conf, adaptive):
    """A vector of another length changes nothing for the others, in whichever task it is."""
    conf(spark__sql__adaptive__enabled=adaptive)
    r = np.random.default_rng(9)
    rows = [(k, r.standard_normal(16).astype(np.float32).tolist(), k % 2) for k in range(400)]
    rows += [(1_000 + k, rows[k][1], k % 2) for k in range(30)]
    rows += [(2_000, r.standard_normal(24).tolist(), 0), (2_001, [1, 0.5, *[0.0] * 6], 0), (2_002, [1, 0.5, *[0.0] * 10], 0)]
    rows += [(2_003, [2.0, 1.0, *[0.0] * 6], 0)]
    rows = [(i, [float(np.float32(x)) for x in v], p) for i, v, p in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(7)
    got = {r.id: (r.n_links, r.component) for r in near_duplicate_vectors(table).collect()}
    assert got == {i: (n, c) for i, n, c, _ in brute.linked_vectors(rows)}
    assert got[2_001] == (1, 2_001) and got[2_003] == (1, 2_001) and got[2_002] == (0, 2_002)
