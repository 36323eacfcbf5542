"""The index in cells: recall, exactness with all cells, pruning, odd vectors."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.operators import cell_index as ci

SCHEMA = "id long, v array<float>"


def frame(spark, v, ids=None):
    ids = range(len(v)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in w]) for i, w in zip(ids, v)], SCHEMA)


def exact(v, q, k, own=None):
    d = np.round(((v - q) ** 2).sum(axis=1), 6)
    return [(i, d[i]) for i in sorted(range(len(v)), key=lambda i: (d[i], i)) if i != own][:k]


def by_query(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query, []).append((r["rank"], r.id, r.dist))
    return {q: [(i, d) for _, i, d in sorted(x)] for q, x in out.items()}


def test_recall_and_exact_search(spark, monkeypatch):
    monkeypatch.setattr(ci, "PART", 100)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    v = np.array([r.embedding for r in rows.orderBy("vec_id").collect()], np.float64)
    index = ci.build(rows, 32, "vec_id", "embedding")
    asked = rows.where("vec_id % 25 = 0")
    want = {q: exact(v, v[q], 5, q) for q in range(0, len(v), 25)}
    some = ci.search(index, asked, 5, 20, "vec_id", "embedding", exclude_self=True)
    got = by_query(some.collect())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    all_cells = by_query(ci.search(index, asked, 5, 32, "vec_id", "embedding", exclude_self=True).collect())
    assert {q: [i for i, _ in x] for q, x in all_cells.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(d == pytest.approx(e) for q in want for (_, d), (_, e) in zip(all_cells[q], want[q]))


def test_other_cells_are_not_read(spark):
    rng = np.random.default_rng(2)
    v = np.repeat(np.eye(8) * 10, 40, axis=0) + 0.1 * rng.normal(size=(320, 8))
    index = ci.build(frame(spark, v), 8)
    hits = ci.search(index, frame(spark, v[:1]), 3, 1)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*cell#\d+ = \d", plan)
    assert [i for i, _ in by_query(hits.collect())[0]] == [i for i, _ in exact(v.astype(np.float32).astype(float), v[0].astype(np.float32), 3)]


def test_hot_vector_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ci, "PART", 50)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(1000 + i, [0.0, float(i)]) for i in range(100)]
    rows += [(2000, None), (2001, [nan, 0.0]), (2002, [inf, 0.0]), (2003, [None, 0.0])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", cell int, part string")
    index = ci.build(table, 4)
    got = by_query(ci.search(index, table, 3, 4).collect())
    assert len(got) == 400
    assert got[5] == [(0, 0.0), (1, 0.0), (2, 0.0)] and [i for i, _ in got[1050]] == [1050, 1049, 1051]
    assert ci.search(ci.build(table.where("false"), 4), table, 3, 4).count() == 0
    assert ci.search(index, table.where("id = 2000"), 3, 4).count() == 0
