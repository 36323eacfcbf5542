"""Dense text vectors and ROUGE-2 of groups against direct versions."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from loomgraph.operators import dense, simjoin
from loomgraph.operators import rouge as rg

SF = "/root/testdata/sf0.001"


def test_dense_vectors_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.lit(1).alias("embedding"))
    docs = docs.unionByName(spark.createDataFrame([(-1, None, 1), (-2, "", 1)], docs.schema))
    got = {r.doc_id: np.array(r.embedding) for r in
           dense.transform(docs, dense.fit(docs, "doc_id", "text", 64), "doc_id", "text").collect()}
    again = {r.doc_id: r.embedding for r in
             dense.transform(docs, dense.fit(docs.repartition(5), "doc_id", "text", 64), "doc_id", "text").collect()}
    hashing = HashingTF(numFeatures=64, inputCol="a", outputCol="b")
    terms = {r.doc_id: re.findall(r"[^\W_]+", (r.text or "").lower()) for r in docs.collect()}
    alone = spark.createDataFrame([([t],) for t in set().union(*terms.values())], "a array<string>")
    cell = {r.a[0]: int(r.b.indices[0]) for r in hashing.transform(alone).collect()}
    cells = {i: Counter(map(cell.get, x)) for i, x in terms.items()}
    df = Counter(c for x in cells.values() for c in x)
    assert set(got) == set(cells) == set(again)
    for i, x in cells.items():
        v = np.zeros(64)
        for c, n in x.items():
            v[c] = n * math.log((len(cells) + 1) / (df[c] + 1))
        v = v / (np.linalg.norm(v) or 1)
        assert np.allclose(got[i], v, atol=1e-9) and np.allclose(again[i], v, atol=1e-9)
    none = docs.limit(0)
    assert dense.transform(none, dense.fit(none, "doc_id", "text"), "doc_id", "text").columns == ["doc_id", "embedding"]


def test_dense_neighbours_are_those_of_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) > 40")
    vectors = dense.transform(docs, dense.fit(docs, "doc_id", "text"), "doc_id", "text")
    rows = {r.doc_id: np.array(r.embedding) for r in vectors.collect()}
    got = {}
    for r in simjoin.knn_edges(vectors, 5, "doc_id", "embedding").collect():
        got.setdefault(r.src, []).append((r.rank, r.sim))
    for i, x in rows.items():
        best = sorted((round(float(x @ y), 6) for j, y in rows.items() if j != i), reverse=True)[:5]
        assert np.allclose([s for _, s in sorted(got[i])], best, atol=2e-6)


def test_rouge_2_of_a_group_sees_over_text_borders(spark):
    rows = [(0, 3, "c d"), (0, 1, "A b"), (0, 2, "!!"), (0, 9, "e"), (1, 1, "x"), (2, 4, "?"), (None, 1, "n n")]
    rows += [(3, i, f"w{i % 7} w{i % 3}") for i in range(9000)]
    members = spark.createDataFrame(rows, "k long, id long, t string")
    preds = spark.createDataFrame([(0, "a b c d e f"), (1, "x"), (3, "w1 w1 w2 w2 w3 w0")], "k long, p string")
    got = {r.k: (r.precision, r.recall) for r in rg.rouge_n_by_group(preds, members, "k", "p", "t", 2, "id").collect()}
    texts = {0: "a b c d e", 1: "x", 2: "", 3: " ".join(t for k, _, t in rows if k == 3)}
    for k, ref in texts.items():
        pred = {0: "a b c d e f", 1: "x", 3: "w1 w1 w2 w2 w3 w0"}.get(k, "")
        a, b = (Counter(zip(x.split(), x.split()[1:])) for x in (pred, ref))
        hit = sum((a & b).values())
        assert np.allclose(got[k], (hit / (a.total() or 1), hit / (b.total() or 1)))


def test_single_precision_never_decides_a_rank():
    """Products that differ by less than single precision rank by double precision, and a row that
    meets its own id keeps out of its neighbours."""
    from loomgraph.operators import tiles
    rng = np.random.default_rng(9)
    rows = np.tile(rng.random(40), (300, 1)) + rng.random((300, 40)) * 4e-6
    rows[250:] = rng.standard_normal((50, 40))
    rows[-1] = 0
    rows /= np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-300)
    ids = np.sort(rng.permutation(1000)[:300]).astype(np.int64)
    block = tiles.Dense(ids, rows)
    assert block.single()[0].dtype == np.float32
    best = tiles.Best(ids, 4)
    block.meet(block, best, None)
    s = np.round(np.einsum("ik,jk->ij", rows, rows), 6)
    for r, (score, dst) in enumerate(zip(best.score, best.dst)):
        want = sorted((-s[r, c], int(j)) for c, j in enumerate(ids) if c != r)[:4]
        assert [(-x, d) for x, d in zip(score, dst)] == want


def test_a_norm_is_summed_once_a_row(spark):
    """Before, the norm stood inside the lambda, so it was summed again for every element."""
    from loomgraph.functions.vectors import l2_normalize
    rows = [(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [1.0, None])]
    frame = spark.createDataFrame(rows, "i int, v array<float>").select("i", l2_normalize("v").alias("u"))
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") <= 1
    got = {r.i: r.u for r in frame.collect()}
    assert got[0] == [0.6, 0.8] and got[1] == [0.0, 0.0] and got[2] is None and got[3] == [] and got[4] == [1.0, None]
