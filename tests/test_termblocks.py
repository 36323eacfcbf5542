"""Scores and vectors from blocks of texts, against plain loops; linear scores."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from loomgraph.functions import text as tx
from loomgraph.operators import chunks as ch
from loomgraph.operators import condense as cd
from loomgraph.operators import lcs
from loomgraph.operators import rouge as rg
from loomgraph.operators import tfidf as tv


def terms(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def some_texts(n):
    rng = random.Random(n)
    return [rng.choice(["", " ", None, "...", "Été, l'an 2", "the THE the"])
            if i % 9 == 0 else " ".join(rng.choice(["the", "of,", f"w{rng.randrange(40)}", f"R{rng.randrange(300)}!"])
                                        for _ in range(rng.randrange(1, 25))) for i in range(n)]


def test_scores_with_repeated_and_null_keys(spark):
    texts = some_texts(160)
    rows = [(None if i % 31 == 5 else i // 4, i % 4 if i % 13 else 0, "x", t) for i, t in enumerate(texts)]
    got = cd.sentence_scores(spark.createDataFrame(rows, "doc long, pos long, more string, sentence string"), ["doc", "pos"])
    assert got.columns == ["doc", "pos", "more", "sentence", "score"]
    held = {}
    for d, p, _, t in rows:
        held.setdefault((d, p), []).extend(terms(t))
    df = Counter(t for words in held.values() for t in set(words))
    idf = {t: math.log((len(rows) + 1) / (n + 1)) for t, n in df.items()}
    want = {k: sum(idf[t] for t in w) / len(w) if w and k[0] is not None else 0.0 for k, w in held.items()}
    out = got.collect()
    assert Counter((r.doc, r.pos, r.sentence) for r in out) == Counter((d, p, t) for d, p, _, t in rows)
    for r in out:
        assert r.score == pytest.approx(want[r.doc, r.pos], abs=2e-9)
    # the texts move once; a term moves once a block, never once an occurrence
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" in plan and "Generate" not in plan


def test_vectors_with_repeated_and_null_ids(spark):
    texts = some_texts(90)
    rows = [(None if i % 17 == 3 else i // 2, t) for i, t in enumerate(texts)]
    space = tv.tfidf(spark.createDataFrame(rows, "doc_id long, text string"))
    held = {}
    for d, t in rows:
        held.setdefault(d, Counter()).update(terms(t))
    df = Counter(t for c in held.values() for t in c)
    want = {}
    for d, c in held.items():
        w = {t: n * math.log((len(rows) + 1) / (df[t] + 1)) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want |= {(d, t): x / norm for t, x in w.items() if norm}
    tid = {r.term: r.tid for r in space.vocabulary.collect()}
    got = space.vectors.collect()
    assert len(got) == len(want) and {r.term: r.df for r in space.vocabulary.collect()} == df
    for r in got:
        assert r.weight == pytest.approx(want[r.id, r.term], abs=1e-12)
        assert r.tid == (tid[r.term] if df[r.term] > 1 else None)


def test_rouge_counts_are_linear(spark):
    """A pair of 100,000 tokens: the position of each in the sorted tokens took hours."""
    rng = random.Random(1)
    a, b = ([f"t{rng.randrange(50000)}" for _ in range(100000)] for _ in range(2))
    pairs = spark.createDataFrame([(1, " ".join(a), " ".join(b)), (2, None, "x"), (3, "A b, a-b", "b a b"), (4, "a", "a")],
                                  "id long, pred string, ref string")
    for n in (1, 2):
        at = time.time()
        got = {r.id: r for r in rg.rouge_n(pairs, ["id"], "pred", "ref", n).collect()}
        assert time.time() - at < 60
        grams = [Counter(zip(*(t[i:] for i in range(n)))) for t in (a, b)]
        assert got[1].precision == sum((grams[0] & grams[1]).values()) / (100000 - n + 1)
        assert got[2].fmeasure == 0.0 and got[4].fmeasure == (1.0 if n == 1 else 0.0)
        assert (got[3].precision, got[3].recall) == ((0.75, 1.0) if n == 1 else (2 / 3, 1.0))


def test_large_pairs_have_the_same_lengths(monkeypatch):
    rng = np.random.default_rng(3)
    xs = [rng.integers(0, k, n) for n, k in ((300, 4), (1, 3), (700, 900), (90, 2), (0, 1), (400, 5))]
    ys = [rng.integers(0, k, n) for n, k in ((500, 4), (900, 3), (600, 900), (2000, 2), (9, 1), (400, 5))]
    xs.append(ys[0][::3])  # a subsequence
    ys.append(ys[0])
    large = lcs.lcs_lengths(xs, ys)
    monkeypatch.setattr(lcs, "LARGE", 1 << 60)
    assert large.tolist() == lcs.lcs_lengths(xs, ys).tolist()
    monkeypatch.undo()
    long = [rng.integers(0, 60, 40000) for _ in range(2)]
    at = time.time()
    assert 5000 < lcs.lcs_lengths(long[:1], long[1:])[0] < 40000 and time.time() - at < 20


def test_long_pieces_are_compared_in_bounded_time(spark):
    """Pieces of 4,000 characters near the threshold: the table as nested arrays took minutes."""
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    far = "".join(rng.choice("abcdefgh ") if rng.random() < 0.25 else c for c in base)
    near = "".join(rng.choice("abcdefgh ") if rng.random() < 0.05 else c for c in base)
    text = f"{base}. {far}! {near}? {base}."
    rows = spark.createDataFrame([(1, text), (2, None), (3, "A b. a B! c")], "id long, t string")
    at = time.time()
    got = {r.id: r.d for r in rows.select("id", ch.dedup_sentences("t").alias("d")).collect()}
    assert time.time() - at < 60
    assert got[1].startswith(base) and near not in got[1] and got[2] is None and got[3] == "A b. a B! c"
    assert ch.taken_pieces([["abc", "abc", "xyz"], [], ["q"]], 90) == [[0, 2], [], [0]]


def test_taken_pieces_in_small_steps(monkeypatch):
    rng = random.Random(4)
    texts = [[rng.choice(["the cat sat", "the cat sat.", "a dog", "rain"]) for _ in range(rng.randrange(6))] for _ in range(20)]
    whole = ch.taken_pieces(texts, 90)
    monkeypatch.setattr(ch, "TRIED", 1)
    assert ch.taken_pieces(texts, 90) == whole


def test_packs_carry_their_scores(spark):
    rows = [(g, i, "w " * (i % 5), float(i)) for g in ("a", "b", None) for i in range(60)]
    s = spark.createDataFrame(rows, "g string, o long, t string, score double")
    packed = cd.scored_packs(s, "g", "o", "t", 7)
    assert {(r.g, r.o): r.score for r in packed.collect()} == {(g, o): x for g, o, _, x in rows if g}
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    twice = cd.scored_packs(s.unionAll(s), "g", "o", "t", 7)
    assert twice.count() == 4 * 120 and "Join" in twice._jdf.queryExecution().executedPlan().toString()


def test_parts_are_joined_in_order(spark):
    rows = [(g, i, f"{g}{i}") for g in "ab" for i in range(50)]
    random.Random(5).shuffle(rows)
    got = cd.joined_in_parts(spark.createDataFrame(rows, "g string, o long, t string"), "g", "o", "t", 7).collect()
    assert {r.g: (r.t, r.n) for r in got} == {g: (" ".join(f"{g}{i}" for i in range(50)), 50) for g in "ab"}


def test_word_count_reads_its_text_once(spark):
    texts = ["", " ", "a", " a b\x1cc\n", "one two  three ", None, "　", ". ,"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", tx.word_count("t").alias("n"))
    assert {r.i: r.n for r in df.collect()} == {i: None if t is None else len(t.split()) for i, t in enumerate(texts)}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
