"""Tiles of packed blocks: best columns by strips, and plans that do not deal rows to every block."""

import numpy as np

from loomgraph.operators import lsh, simjoin, sparse_knn, tiles


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _brute(ids, sim, k):
    return {i: sorted(((-sim[r, c], j) for c, j in enumerate(ids) if j != i))[:k] for r, i in enumerate(ids)}


def test_meet_equals_brute_force_with_ties(monkeypatch):
    monkeypatch.setattr(tiles, "STRIP_ROWS", 3)
    monkeypatch.setattr(tiles, "STRIP_COLS", 5)
    rng = np.random.default_rng(1)
    rows = rng.integers(-1, 2, (40, 4)).astype(float)
    ids = rng.permutation(100)[:40].astype(np.int64)
    one, two = (tiles.Dense(ids[h][np.argsort(ids[h])], rows[h][np.argsort(ids[h])]) for h in (slice(0, 17), slice(17, 40)))
    a, b = tiles.Best(one.ids, 3), tiles.Best(two.ids, 3)
    one.meet(one, a, None), two.meet(two, b, None), one.meet(two, a, b)
    want = _brute(list(ids), rows @ rows.T, 3)
    for found in (a, b):
        for i, score, dst in zip(found.ids, found.score, found.dst):
            assert [(-s, d) for s, d in zip(score, dst)] == want[i]


def test_vectors_are_not_dealt_to_every_block(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).standard_normal(4)]) for i in range(60)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    plan = _plan(simjoin.knn_edges(v, 3, block_rows=8))
    assert "CartesianProduct" in plan and plan.count("Exchange hashpartitioning") == 1  # the ranking
    assert "CoGroup" not in _plan(lsh.knn_lsh(v, 3, block_rows=8))
    found = {tuple(r) for r in lsh.knn_lsh(v, 3, bands=2, rows=2).collect()}
    assert found == {tuple(r) for r in lsh.knn_lsh(v, 3, bands=2, rows=2, block_rows=8).collect()}


def test_left_and_right_tables(spark):
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal((7, 3)), rng.standard_normal((30, 3))
    frame = [spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "id long, v array<double>") for m in (a, b)]
    got = simjoin.topk_join(*frame, 4, simjoin.SQEUCLIDEAN, block_rows=4).collect()
    dist = ((a[:, None] - b[None]) ** 2).sum(2)
    assert {(r["src"], r["rank"]): r["dst"] for r in got} == {
        (i, n + 1): int(j) for i in range(7) for n, j in enumerate(np.argsort(dist[i])[:4])}


def test_sparse_products_equal_dense(monkeypatch):
    rng = np.random.default_rng(3)
    m = rng.random((23, 30)) * (rng.random((23, 30)) < np.linspace(0.02, 0.9, 30))
    def rows(x):
        import pyarrow as pa
        at = [np.flatnonzero(r) for r in x]
        part = pa.table({"id": pa.array(np.arange(len(x))), "tids": pa.array([list(a) for a in at], pa.list_(pa.int64())),
                         "weights": pa.array([list(r[a]) for a, r in zip(at, x)], pa.list_(pa.float64()))})
        return sparse_knn.Rows.load(*sparse_knn._pack(part))
    for dear in (0, 8, 10 ** 6):
        monkeypatch.setattr(sparse_knn, "DEAR", dear)
        assert np.allclose(sparse_knn.products(rows(m[:9]), rows(m[9:]), most=7), m[:9] @ m[9:].T)


def test_sparse_entries_are_shuffled_once(spark):
    v = spark.createDataFrame([(i, t, 1.0) for i in range(40) for t in range(i % 5, 9)], "id long, tid long, weight double")
    plan = _plan(sparse_knn.topk_sparse(v, 3, block_postings=20))
    assert "CartesianProduct" in plan and "Generate" not in plan


def test_null_and_uneven_vectors_are_refused():
    import pyarrow as pa
    import pytest
    for bad in ([[1.0, 2.0], None], [[1.0], [1.0, 2.0, 3.0]]):
        with pytest.raises(ValueError):
            tiles.Dense.of(pa.array([1, 2]), pa.array(bad, pa.list_(pa.float64())))
