"""Merkle manifest against a plain tree, with blocks small enough for several rounds."""

import hashlib

import pytest
from pyspark.sql import functions as F

from loomgraph.llm.manifest import folded, manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Root and, per node, the list of (left, right) sibling strings."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            first = at[i] // 3 * 3
            run = nodes[first:first + 3]
            p.append(("".join(run[:at[i] - first]), "".join(run[at[i] - first + 1:])))
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        at = [a // 3 for a in at]
    return nodes[0], paths


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs, inner = [], []
    for s in names:
        of = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        sub, paths = climb([leaf(r) for r in of])
        subs.append(sub)
        inner += [(r[0], leaf(r), sub, p, len(subs) - 1) for r, p in zip(of, paths)]
    root, upper = climb(subs)
    return sorted(((i if i is not None else -1), lf, sub, root, tuple(p + upper[k])) for i, lf, sub, p, k in inner)


def read(frame):
    return sorted(((r.doc_id if r.doc_id is not None else -1), r.leaf, r.subroot, r.root,
                   tuple((s["left"], s["right"]) for s in r.path)) for r in frame.collect())


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def table(sizes, long_text=""):
    rows = []
    for s, n in sizes.items():
        rows += [(1000 * len(rows) + i, s, "en", 3, f"té\n{i}{long_text}") for i in range(n)]
    return rows


@pytest.mark.parametrize("block_levels", [1, 2, 7])
def test_equals_plain_tree(spark, block_levels):
    rows = table({"b": 1, "a": 61, "é": 4, None: 10, "z": 27, "c": 28, "d": 3, "e": 2, "f": 9, "g": 13})
    rows += [(None, "a", None, None, None), (None, "a", None, None, ""), (5, "é", "x", 1, "twice"), (5, "é", "x", 1, "twice"),
             (6, "", "en", 0, "é" * 50_000)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", ordinal int, block int").repartition(5)
    got = manifest(frame, block_levels=block_levels)
    assert read(got) == plain(rows)
    assert got.where(folded(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3}, {"a": 4}, {"a": 1, "b": 1}, {"a": 10, "b": 1, "c": 2, "d": 19}])
def test_small_shapes(spark, sizes):
    rows = table(sizes)
    assert read(manifest(spark.createDataFrame(rows, SCHEMA), block_levels=1)) == plain(rows)


def test_tampering_shows(spark):
    rows = table({"a": 20, "b": 5}) + [(77_000, "b", "en", 1, None), (77_001, "b", "en", 1, "no line feed")]
    frame = spark.createDataFrame(rows, SCHEMA)
    out = manifest(frame, F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")),
                   block_levels=1)
    out = out.withColumn("ok", folded(F.col("leaf_now"), F.col("path")) == F.col("root")).collect()
    ok = {r.doc_id: r.ok for r in out}
    for i, _, _, _, text in rows:
        assert ok[i] == (i % 2 == 1 or text is None or "\n" not in text)


def test_empty_table(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0
