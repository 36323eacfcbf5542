"""Window removal against a direct count of all windows."""

import random

import numpy as np
from pyspark.sql import functions as F

from loomgraph.llm import shingles
from loomgraph.llm.substring_dedup import substring_dedup

LAST = 1 << 62


def direct(rows, window):
    """Kept words per row, by a dictionary of every window's first place."""
    order = sorted(range(len(rows)), key=lambda i: (LAST if rows[i][0] is None else rows[i][0], (rows[i][1] or "").encode()))
    words = [(t or "").encode().split() for _, t in rows]
    seen, out = set(), [None] * len(rows)
    for i in order:
        w = words[i]
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            seen.add(key)
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def compare(spark, rows, window, **kw):
    frame = spark.createDataFrame([(i, t, "x", k, b"z") for k, (i, t) in enumerate(rows)],
                                  "doc_id long, text string, _t string, _block int, n_words binary")
    got = {r._block: r for r in substring_dedup(frame, window, carry=("_block",), **kw).collect()}
    want = direct(rows, window)
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        r = got[k]
        assert r.doc_id == i and (r.n_words, r.n_removed, r.text) == want[k], (k, rows[k])


def test_against_direct_count(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(12)] + ["é", "ß\x1c", "中"]
    text = lambda n, v=vocab: rng.choice([" ", "\n", "\t "]).join(rng.choices(v, k=n))
    rows = [(i, text(rng.randrange(0, 60), vocab[:3] if i % 7 == 0 else vocab)) for i in range(200)]
    shared = text(40)
    rows += [(500 + i, text(10) + " " + shared + " " + text(i)) for i in range(40)]
    rows += [(900, None), (901, ""), (902, " \n "), (903, "a " * 5000), (904, rows[3][1]), (904, rows[4][1]),
             (904, rows[3][1]), (None, shared), (None, None), (None, shared + " end")]
    rng.shuffle(rows)
    compare(spark, rows, 5, block_bytes=3000)
    compare(spark, rows, 20, block_bytes=1000)
    compare(spark, rows, 20)


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = [tuple(r) for r in docs]
    compare(spark, rows, 20, block_bytes=100_000)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup(none).count() == 0
    assert substring_dedup(none.where(F.col("text") == "x")).columns == ["doc_id", "text", "n_words", "n_removed"]


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    x = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    small, none = rng.integers(0, 9, 77, dtype=np.uint8), np.zeros(0, "<u4")
    a, b, c = shingles.unpacked(shingles.packed(shingles.gaps(x), small, none))
    assert (shingles.ungapped(a) == x).all() and (b == small).all() and len(c) == 0


def test_words_of_blocks():
    texts = [b"", b"  A bc\x0bD ", b"bc", b"A bc D"]
    w = shingles.Words(texts)
    assert w.count.tolist() == [0, 3, 1, 3] and w.first.tolist()[1:] == [0, 3, 4]
    assert w.hash[1] == w.hash[3] == w.hash[5] and w.runs(3)[0] == w.runs(3)[4]
    assert w.whole(3).tolist() == [True, False, False, False, True]
    low = shingles.Words([b"A\xc3\x80 a\xc3\x80"], lower=True)
    assert low.hash[0] == low.hash[1]


def test_a_cell_on_a_range_border_is_counted_once(spark):
    import numpy as np

    from loomgraph.llm.blocktable import Grid, repeated_cells
    border = -(-(1 << 64) // 3)  # of ranges 0 and 1 of 3, inside a cell of 16 bits
    table = spark.createDataFrame([(0,), (1,)], "_block int")

    def items(block):
        b = block.column("_block")[0].as_py()
        return np.array([border - (1 << 33) if b == 0 else border + (1 << 33)], np.uint64)
    found = repeated_cells(table, Grid(3, 16), items).collect()
    assert sorted(r._block for r in found) == [0, 1] and len({r._range for r in found}) == 1
