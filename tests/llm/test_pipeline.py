"""The pipeline's stages, each on its own input, against direct versions; and
the classifiers' held-out accuracy."""

import zlib

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from loomgraph.llm.queries import QUERIES
from test_jaccard import direct as near_direct
from test_substrings import direct as passage_direct

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's output, written and read again as the next one's input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


# 40 toxic documents in four languages are few to learn from: larger tables do better (below)
def test_toxic_documents_go(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = texts(stages[0]), texts(stages[1])
    gone = set(before) - set(after)
    known = [i for i in before if i in labels]
    caught = sum(labels[i] for i in gone if i in labels)
    assert caught >= 0.6 * sum(labels[i] for i in known)
    assert sum(labels[i] == 0 for i in gone if i in labels) <= 0.01 * len(known)
    assert stages[1].columns == stages[0].columns


def test_copies_go(stages):
    import re
    before, after = texts(stages[1]), texts(stages[2])
    first = {}
    for i, t in sorted(before.items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    assert set(after) == set(first.values())


def test_near_copies_go(stages):
    before, after = texts(stages[2]), texts(stages[3])
    found = near_direct(sorted(before.items()))
    assert set(after) == {i for i, _, c in found if i == c}


def test_passages_go(stages):
    before, after = texts(stages[3]), texts(stages[4])
    rows = sorted(before.items())
    for (i, t), (_, gone, kept) in zip(rows, passage_direct(rows, 20)):
        assert after[i] == (kept if gone else t)
    assert stages[4].columns == stages[0].columns
    assert stages[4].where(F.col("n_chars") != F.length("text")).count() == 0


def test_packing_holds_all(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(texts(stages[4]))
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) == -(-total // 2048)


def test_odd_tables_pass_through(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id string, unit binary"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    odd = [(1, None, None, None, None, "a", b""), (2, "", "en", None, 0, None, None), (2, "", "en", None, 0, None, None),
           (3, "x " * 9000, "en", "s", 18000, "b", b"1"), (None, "one two", None, "s", 7, "c", b"2")]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in cp.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert sorted(docs.columns) == sorted(c.split()[0] for c in schema.split(", "))
        ids = {r.doc_id for r in cp.pack(spark, docs, str(tmp_path)).collect()}
        assert ids == ({1, 3, None} if rows else set())


def test_rows_not_ids_are_kept(spark, tmp_path):
    a, b = ("one two three four five six seven eight nine ten eleven twelve " + x for x in ("thirteen", "other words here to differ"))
    near = a + " fourteen"
    rows = [(3, b, "x"), (5, a, "x"), (5, b, "x"), (None, a, "x"), (None, "own text", "x"), (7, "own text two", "x"),
            (7, "own text two", "x"), (9, near, "x"), (5, near, "y"), (None, None, "x"), (8, "", "x"), (8, "", "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    frame.repartition(3).write.parquet(str(tmp_path / "t"))
    for docs in (frame, spark.read.parquet(str(tmp_path / "t"))):
        got = cp.drop_copies(spark, docs, "")
        assert got.columns == docs.columns
        left = sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in got.collect())
        assert left == sorted([((False, 3), b), ((False, 5), a), ((False, 5), near), ((True, 0), "own text"), ((False, 7), "own text two"),
                               ((False, 8), "")])
        got.write.mode("overwrite").parquet(str(tmp_path / "u"))
        rest = cp.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "u")), "").collect()
        assert len(rest) == 5 and sum(r.doc_id == 5 for r in rest) == 1


def test_run_equals_its_stages(spark, stages):
    rows = cp.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, rows.select(*key).collect())) == sorted(map(tuple, stages[5].select(*key).collect()))


def test_held_out_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = QUERIES["op5_compression_language"](spark, "/root/testdata/sf0.1").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op7_crf_toxicity"](spark, sf).join(labels, "doc_id", "left").collect()
    held = [r for r in rows if r.held_out and r.toxic is not None]
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_language_and_toxicity_of_odd_tables(spark):
    from loomgraph.llm import language_id, toxicity
    odd = spark.createDataFrame([(1, None, "en", 5), (2, "", "en", 5), (3, "123 !!", None, 5), (None, "the of", "en", 5),
                                 (4, "the and of " * 3000, "en", 5), (4, "der die das", "de", 5)],
                                "doc_id long, text string, lang string, score int")
    known = language_id.fit(odd, F.lit(True))
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(odd, known).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (4, "en"), (4, "de")}
    assert {r.lang_pred for r in language_id.identify(odd, {}).collect()} == {"und"}
    none = odd.where("doc_id > 9")
    assert language_id.fit(none, F.lit(True)) == {} and language_id.identify(none, known).count() == 0
    labels = spark.createDataFrame([(1, 1), (4, 0), (9, None), (4, 0)], "doc_id long, toxic int")
    tagger = toxicity.train(*toxicity.sample(odd, labels, F.lit(True)))
    assert toxicity.tag(odd, tagger).count() == 6 and toxicity.tag(none, tagger).count() == 0
    assert toxicity.reject(odd, tagger).columns == odd.columns


def test_spans_and_marginals():
    import itertools

    import numpy as np

    from loomgraph.llm import toxicity as tx
    rng = np.random.default_rng(0)
    plain = lambda: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(8))
    rows = [(f"{plain()} {'idiot ' if i % 3 == 0 else ''}{plain()}", int(i % 3 == 0)) for i in range(300)]
    tagger = tx.train(rows, {0: 200, 1: 100})
    (score, spans), (clean, none) = tagger.scores(["well, IDIOT! fine", "well fine"])
    assert score > 0.5 > clean and none == [] and [s[:2] for s in spans] == [(6, 12)]
    e, trans = rng.normal(size=(5, 1)), rng.normal(size=(2, 2))
    fwd, bwd = tx.recursions(e, np.array([5]), trans)
    odds = (fwd * bwd)[:, 0]
    weight = {y: np.exp(sum(e[t, 0] * y[t] for t in range(5)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
              for y in itertools.product((0, 1), repeat=5)}
    for t in range(5):
        p = sum(w for y, w in weight.items() if y[t]) / sum(weight.values())
        assert abs(odds[t] / (1 + odds[t]) - p) < 1e-9
