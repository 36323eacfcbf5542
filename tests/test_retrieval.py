"""Budgets, complete retrieval, answers and exact sparse neighbours."""

import random

from pyspark.sql import functions as F

from loomgraph.operators import condense as cd
from loomgraph.operators import retrieve as rt
from loomgraph.operators import simjoin, sparse_knn
from loomgraph.operators import tfidf as tv


def test_no_summary_exceeds_its_budget(spark):
    rows = [(g, r, " ".join(f"w{g}_{r}_{i}" for i in range(n)))
            for g, sizes in enumerate([[300], [3, 300, 2], [5, 5, 5], [0, 4], [10, 1, 1]]) for r, n in enumerate(sizes)]
    frame = spark.createDataFrame(rows, "g int, r int, text string")
    for budget in (1, 5, 10, 256):
        out = cd.budget_select(frame, ["g"], [F.col("r")], F.lit(budget), "r", "text", max_budget=budget).collect()
        words = {x.g: x.summary.split() for x in out}
        for g in range(5):
            whole = " ".join(t for k, _, t in sorted(rows) if k == g).split()
            assert words[g] == whole[:budget]


def space_of(spark, texts):
    return tv.tfidf(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_every_query_gets_k_rows_and_an_answer(spark):
    space = space_of(spark, ["alpha beta", "beta gamma", "delta epsilon zeta", "eta theta"])
    summaries = spark.createDataFrame([(c, t) for c, t in zip("abcd", ["alpha beta", "beta gamma", "delta", ""])],
                                      "community string, summary string")
    queries = spark.createDataFrame([(1, "alpha"), (2, "nothing known"), (3, ""), (4, "delta theta")], "item_id long, text string")
    asked = queries.select(F.col("item_id").alias("query"))
    vec = tv.embed_queries(space, queries, "item_id", "text")
    index = rt.build_index(space, summaries)
    keys = summaries.select(F.col("community").alias("id"))
    for k, n in ((3, 3), (9, 4)):
        hits = rt.l2_search(asked, vec, index, keys, k).collect()
        by = {}
        for h in hits:
            by.setdefault(h.query, []).append((h["rank"], h.id, h.dist))
        assert {q: len(x) for q, x in by.items()} == dict.fromkeys((1, 2, 3, 4), n)
        assert [c for _, c, _ in sorted(by[2])] == list("abcd")[:n] and all(d == 2 for _, _, d in by[2])
        assert sorted(by[1])[0][1] == "a" and sorted(by[4])[0][1] == "c"
    reranked = rt.cosine_rerank(rt.l2_search(asked, vec, index, keys, 2), 2)
    members = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 3)], "id string, doc_id long")
    sents = spark.createDataFrame([(0, 0, "alpha beta " * 100), (1, 0, "beta gamma"), (2, 0, "delta epsilon zeta")],
                                  "doc_id long, pos long, sentence string")
    got = {r.query: r.answer for r in rt.answer(asked, vec, reranked, members, sents, space, 150).collect()}
    assert len(got[1].split()) == 150 and got[4] == "delta epsilon zeta"
    assert got[2] == got[3] == cd.NO_SUMMARY


def brute_neighbours(space, ids, k):
    vec = {i: {} for i in ids}
    for r in space.vectors.collect():
        vec[r.id][r.term] = r.weight
    out = {}
    for i in ids:
        sims = [(-round(sum(w * vec[j].get(t, 0.0) for t, w in vec[i].items()), 6), j) for j in ids if j != i]
        out[i] = [(j, -s) for s, j in sorted(sims) if s < 0][:k]
    return out


def test_neighbours_are_exact_at_any_block_size(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "of", f"w{rng.randrange(60)}", f"r{rng.randrange(400)}"]) for _ in range(rng.randrange(1, 30)))
             for _ in range(150)]
    texts += [texts[3]] * 40 + [texts[7]] * 2 + ["the of", "the of", "the of the"] + ["alone once"] + ["...", ""]
    order = list(range(len(texts)))
    rng.shuffle(order)
    frame = spark.createDataFrame([(i, texts[j]) for i, j in enumerate(order)], "doc_id long, text string")
    space = tv.tfidf(frame)
    want = brute_neighbours(space, range(len(texts)), 5)
    assert space.vocabulary.where("term = 'the'").first().df > 50
    for postings in (1 << 17, 300):
        got = {i: [] for i in want}
        for r in sparse_knn.topk_texts(space, frame, 5, block_postings=postings).collect():
            got[r.src].append((r["rank"], r.dst, r.sim))
        for i, rows in got.items():
            assert [r for r, _, _ in sorted(rows)] == list(range(1, len(rows) + 1))
            assert [(j, s) for _, j, s in sorted(rows)] == want[i], i
    assert sparse_knn.topk_texts(space, frame, 1000).where("src = 0").count() <= len(texts) - 1
    empty = tv.tfidf(frame.where("false"))
    assert sparse_knn.topk_texts(empty, frame.where("false"), 5).count() == 0


def test_alignment_counts_repeated_keys(spark):
    import pytest
    one = spark.createDataFrame([(1,), (2,)], "id long")
    twice = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    assert simjoin.align_by_key(one, one, "id").count() == 2
    with pytest.raises(ValueError, match="0 keys have no partner, 1 occur"):
        simjoin.align_by_key(one, twice, "id")


def test_fixed_tiles_do_not_change_ranks(spark):
    v = spark.createDataFrame([(i, [float(i % 3 + 1), float(i % 2)]) for i in range(40)], "vec_id long, embedding array<float>")
    a, b = (sorted(map(tuple, simjoin.knn_edges(v, 4, block_rows=n).collect())) for n in (7, 256))
    assert a == b
