"""Hard negatives against all pairs; pruning that must lose nothing."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.llm.hard_negatives import Bucket, mine

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor_step=10, positives=5, negatives=10, low=30, high=90):
    ok = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(np.float64)).astype(np.int64), lab) for i, v, lab in rows
          if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = float("inf")
    out = []
    for a, (i, v, lab) in enumerate(ok):
        if i is None or i % anchor_step:
            continue
        scored = sorted((-int(v @ w), j if j is not None else last, b) for b, (j, w, _) in enumerate(ok) if b != a and len(w) == len(v))
        pos = [s for s in scored if ok[s[2]][2] == lab][:positives]
        neg = [s for s in scored if ok[s[2]][2] != lab]
        for p, j, _ in pos:
            fit = [s for s in neg if low * -p <= -100 * s[0] <= high * -p][:negatives]
            out += [(i, j, r, m, -p, -s) for r, (s, m, _) in enumerate(fit, 1)]
    return sorted(out)


def got(frame, **kw):
    last = float("inf")
    return sorted(tuple(last if x is None else x for x in r) for r in
                  mine(frame, F.col("vec_id") % 10 == 0, F.col("label"), **kw)
                  .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("kind", ["round", "spread", "clustered"])
def test_equals_all_pairs(spark, kind, monkeypatch):
    import loomgraph.llm.hard_negatives as hn
    rng = np.random.default_rng(3)
    n = 2600  # three buckets of 1024 rows: two rounds
    v = rng.normal(size=(n, 8))
    if kind == "clustered":
        v = rng.normal(size=(20, 8))[rng.integers(0, 20, n)] + 0.1 * v
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if kind == "spread":
        v *= rng.lognormal(0, 1.5, n)[:, None]
    monkeypatch.setattr(hn, "ASKS", 100)
    rows = [(int(i), [float(x) for x in w], int(rng.integers(0, 4))) for i, w in enumerate(v)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(frame, bucket_values=1) == brute(rows)


def test_hot_vector_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    hot = [0.5, 0.25, -0.75]
    rows = [(i, hot, i % 3) for i in range(900)]
    rows += [(1000 + i, [float(x) for x in rng.normal(size=3)], int(i % 3)) for i in range(900)]
    rows += [(5000, None, 1), (5010, [nan, 1.0, 1.0], 1), (5020, [inf, 0.0, 0.0], 1), (5030, [None, 1.0, 1.0], 1),
             (5040, [1.0, 1.0, 1.0], None), (5050, [0.0, 0.0, 0.0], 1), (None, [2.0, 0.0, 0.0], 2), (5060, [1.0, 2.0], 0),
             (5061, [1.0, 1.0], 0), (5062, [0.5, 0.5], 1), (5070, [], 0), (5071, [], 0), (5072, [], 1)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", bucket string, row int")
    assert got(frame, bucket_values=1) == brute(rows)


def test_empty_and_single(spark):
    frame = spark.createDataFrame([(0, [1.0], 1)], SCHEMA)
    assert got(frame) == [] and got(frame.where("false")) == []


def test_lists_prune_without_loss():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(4000, 6))
    v = np.floor(256 * v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.int64)  # one bucket: similar lengths
    b = Bucket(np.arange(4000), np.arange(4000), np.zeros(4000, int), v)
    pruned = 0
    for q in v[:200]:
        length = float(np.sqrt((q.astype(float) ** 2).sum()))
        score = v @ q
        need = float(np.sort(score)[-10])
        least = float(b.cosine(np.array([need]), np.array([length]))[0])
        near = b.candidates(q / length, least, 4) if least <= 1 else np.array([], int)
        if near is not None:
            pruned += 1
            assert set(np.flatnonzero(score >= need)) <= set(near.tolist())
            assert len(near) < 2000
    assert pruned > 20
