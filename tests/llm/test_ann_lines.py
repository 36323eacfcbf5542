"""Neighbour search against brute force; line alignment against a direct version."""

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loomgraph.llm.ann_graph import nearest
from loomgraph.llm.line_align import line_dedup, patience


def exact(ids, v, k):
    norm = np.linalg.norm(v, axis=1)
    out = {}
    for i in range(len(v)):
        if ids[i] % 50 == 0:
            s = (v * v[i]).sum(axis=1) / (norm * norm[i])
            out[ids[i]] = [c for _, c in sorted((-s[j], ids[j]) for j in range(len(v)) if ids[j] != ids[i])[:k]]
    return out


def test_recall_and_scores(spark):
    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids, v = t["vec_id"].to_pylist(), np.array(t["embedding"].to_pylist(), dtype=np.float64)
    want = exact(ids, v, 5)
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in nearest(frame, F.col("vec_id") % 50 == 0, shard_rows=700).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    place = {c: i for i, c in enumerate(ids)}
    for q, rows in got.items():
        assert [r for r, _, _ in sorted(rows)] == [1, 2, 3, 4, 5]
        for _, c, s in rows:
            a, b = v[place[q]], v[place[c]]
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
    hits = sum(len(set(want[q]) & {c for _, c, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_recall_of_full_shards(spark):
    """The shipped settings on a shard and a half."""
    rng = np.random.default_rng(8)
    n = 24_576
    v = rng.normal(size=(n, 64)).astype(np.float32)
    frame = spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(v)], "vec_id long, embedding array<float>")
    got = {}
    for r in nearest(frame.repartition(8), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    sim = unit[::50] @ unit.T
    sim[np.arange(len(sim)), np.arange(0, n, 50)] = -1
    want = np.argsort(-sim, axis=1)[:, :5]
    assert sum(len(got[50 * i] & set(w.tolist())) for i, w in enumerate(want)) >= 0.9 * want.size


def test_many_vectors_of_equal_cosine(spark):
    """Vectors on a circle around the query: the smallest ids of a tie win."""
    rows = [(0, [1.0, 0.0, 0.0])]
    for i in range(1, 101):
        a = 2 * np.pi * i / 100
        rows.append((i, [3.0, 4.0 * round(float(np.cos(a)), 3), 4.0 * round(float(np.sin(a)), 3)]))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["rank"], r.vec_id, r.score) for r in nearest(frame, F.col("vec_id") == 0).collect())
    v = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    score = v[1:, 0] / np.linalg.norm(v[1:], axis=1)
    want = sorted(range(1, 101), key=lambda i: (-score[i - 1], i))[:5]
    assert [i for _, i, _ in got] == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 0.0]), (100, [0.0, 0.0]),
            (150, [1.0, 1.0, 1.0]), (0, [1.0, 0.0])] + [(1000 + i, [1.0, 0.0]) for i in range(300) if i % 50]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, v string, shard int")
    got = {}
    for r in nearest(frame, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    assert sorted(got) == [0, 50]
    assert [c for _, c, _ in sorted(got[0])] == [1, 50, 1001, 1002, 1003]
    assert [c for _, c, _ in sorted(got[50])] == [0, 1, 1001, 1002, 1003]
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in nearest(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1)]
    assert nearest(few.where("vec_id > 5"), F.lit(True)).count() == 0


def longest_common(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n[i + 1][j + 1] = n[i][j] + 1 if x == y else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


def test_patience():
    assert patience(list("abcd"), list("abxcd")) == [0, 1, 3, 4]
    assert patience(list("xaybz"), list("paqbr")) == [1, 3]
    assert patience(list("abab"), list("baba")) == []
    rng = random.Random(4)
    for _ in range(300):
        a = rng.sample(range(40), rng.randrange(20))
        b = rng.sample(range(40), rng.randrange(20))
        got = patience(a, b)
        at = [a.index(b[k]) for k in got]
        assert at == sorted(at) and len(got) == longest_common(a, b)  # all items unique: the longest run
    a = [rng.randrange(6) for _ in range(60)]
    assert patience(a, a) == list(range(60))


def direct(rows):
    """Every document aligned with every earlier one."""
    strip = " \t\n\x0b\f\r"
    seqs = [[x for x in (t or "").split("\n") if x.strip(strip)] for _, t in rows]
    plain = [[x.strip(strip) for x in s] for s in seqs]
    first = {}
    for (i, _), k in zip(rows, map(tuple, plain)):
        if k:
            first[k] = min(i, first.get(k, i))
    holders = {}
    for k in first:
        for x in set(k):
            holders.setdefault(x, []).append(k)
    out = []
    for (i, _), s, k in zip(rows, seqs, map(tuple, plain)):
        met = {o for x in set(k) for o in holders[x] if first[o] < i}
        cut = {n for o in met for n in patience(list(o), list(k))}
        out.append((i, len(s), len(cut), hashlib.sha256("\n".join(x for n, x in enumerate(s) if n not in cut).encode()).hexdigest()))
    return sorted(out)


def check_lines(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, seq string, u int")
    got = line_dedup(frame).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256)).collect()
    assert sorted(map(tuple, got)) == direct(rows)


def test_line_dedup(spark):
    rng = random.Random(9)
    vocab = [f"line {i}" for i in range(60)] + ["", "  ", "é\t", " line 1 "]
    rows = [(i, "\n".join(rng.choices(vocab, k=rng.randrange(8)))) for i in range(150)]
    base = [f"page {i}" for i in range(30)]
    for i in range(60):
        page = list(base)
        page[rng.randrange(30)] = f"edit {i}"
        rows.append((200 + i, "\n".join(page)))
    rows += [(400, None), (401, ""), (402, "\n \n"), (403, rows[160][1]), (404, rows[160][1] + "\n"), (405, "boiler"),
             (406, "boiler"), (405, "boiler"), (407, "z\n" * 3000)]
    rng.shuffle(rows)
    check_lines(spark, rows)


def test_line_dedup_real_and_empty(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    check_lines(spark, [tuple(r) for r in docs])
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    null = spark.createDataFrame([(None, "a\nb"), (1, "a\nb")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_removed) for r in line_dedup(null).collect()) == [("1", 0), ("None", 2)]


def all_pairs(rows):
    """A line goes when any earlier document aligns with it."""
    seqs = {}
    for i, t in sorted(rows):
        seqs.setdefault(tuple(x.strip() for x in t.split("\n") if x.strip()), i)
    out = {}
    for b, i in seqs.items():
        out[i] = len({k for a, j in seqs.items() if j < i for k in patience(list(a), list(b))})
    return out


def whole(spark, rows):
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: r.n_removed for r in got}


def test_line_held_by_many_documents(spark):
    rows = [(i, f"own {i}\na passage that all of them hold\nmore {i}") for i in range(130)]
    assert whole(spark, rows) == {i: int(i > 0) for i in range(130)}


def test_later_holders_align_what_the_first_does_not(spark):
    rows = [(1, "two\none"), (2, "one\nx\ntwo"), (3, "one\ny\ntwo")]
    assert whole(spark, rows)[3] == 2


def test_every_earlier_holder_counts(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = []
        for i in range(400):
            n = rng.randrange(1, 9)
            rows.append((i, "\n".join(rng.choices(["=", "-", "*"] + [f"l{k}" for k in range(12)], k=n)
                                     + [f"own {i}"] * rng.randrange(2))))
        rows += [(400 + i, f"a{i}\n=\nb{i}\n=\nc{i}") for i in range(60)] + [(500, "=\nz"), (501, "=\nw\nv\n=")]
        rng.shuffle(rows)
        rows = [(i, t) for i, (_, t) in enumerate(rows)]
        expected = all_pairs(rows)
        got = whole(spark, rows)
        assert {i: got[i] for i in expected} == expected


def test_shared_lines_in_an_order_the_first_lacks(spark, monkeypatch):
    """A hot pair of lines does not make the documents' pairs."""
    import loomgraph.llm.line_align as la
    seen = []
    real = la.materialize
    monkeypatch.setattr(la, "materialize", lambda df, name, *a: seen.append((name, t := real(df, name, *a))) or t)
    rows = [(0, "two\none")] + [(i, f"one\nown {i}\ntwo\npair {i // 2}") for i in range(1, 201)]
    got = whole(spark, rows)
    assert got == {i: r[2] for i, r in zip(range(201), direct(rows))}
    assert all(t.count() < 2000 for name, t in seen if name in ("line-listed", "line-ordered", "line-orders"))
