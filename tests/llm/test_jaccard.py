"""Jaccard components against all pairs."""

import random

from loomgraph.llm import jaccard_join
from loomgraph.llm.jaccard_join import components, jaccard_components


def direct(rows, words=5, percent=75):
    def shingles(text):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        if len(w) < words:
            return {tuple(w)} if w else set()
        return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    tried = set()
    for own in holders.values():
        for k, i in enumerate(own):
            for j in own[:k]:
                if (j, i) not in tried:
                    tried.add((j, i))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        up[top(i)] = top(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[top(i)] = min(best.get(top(i), d), d)
    return sorted(((d, len(sets[i]), best.get(top(i))) for i, (d, _) in enumerate(rows)), key=str)


def check(spark, rows, **kw):
    frame = spark.createDataFrame([(d, t, 1, b"") for d, t in rows], "doc_id long, text string, n int, unit binary")
    got = sorted((tuple(r) for r in jaccard_components(frame, **kw).collect()), key=str)
    assert got == direct(rows)
    return got


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 7)
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(400)] + ["É", "ß", "Ab"]
    rows = []
    for family in range(12):
        base = rng.choices(vocab, k=rng.randrange(1, 80))
        for _ in range(rng.choice([1, 2, 5, 30])):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < .2:
                w += rng.choices(vocab, k=rng.randrange(10))
            rows.append((0, rng.choice([" ", "\n", "\t "]).join(w).swapcase()))
    line = " ".join(rng.choices(vocab, k=30))
    rows += [(0, line + " " + " ".join(rng.choices(vocab, k=rng.randrange(60)))) for _ in range(60)]
    rows += [(0, t) for t in (None, "", " \n", "a", "A", "a b", "a b c d e", "A b c d e", "a b c d", "x " * 900)]
    rows += [rng.choice(rows) for _ in range(60)]
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    rows += [(3, "zz yy xx ww vv uu"), (3, rows[5][1])]
    got = check(spark, rows, block_bytes=4000)
    assert len({c for _, _, c in got}) < len(rows) - 100


def test_null_ids(spark):
    got = check(spark, [(None, "a b c d e f"), (7, "a b c d e f"), (9, "A b c d e f"), (None, "q r"), (None, None)])
    assert (9, 2, 7) in got


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in docs], block_bytes=100_000)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "u long, v long")
    got = {r.u: r.label for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
