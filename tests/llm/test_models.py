"""Language and toxicity predictions against direct versions, row by row."""

import numpy as np
import zstandard as zstd
from pyspark.sql import functions as F

from loomgraph.llm import language_id, toxicity
from loomgraph.llm.queries import fold

SF = "/root/testdata/sf0.01"


def test_language_by_plain_compression(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = language_id.fit(docs, fold(4) != 2)
    total = sum(n for _, n in known.values())
    texts = {r.doc_id: r.text for r in docs.where("doc_id % 4 = 0").collect()}
    texts |= {-1: "ß", -2: "a", -3: "12 .", -4: None, -5: "the " * 9000}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in language_id.identify(frame, known).collect():
        text = texts[r.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        size = {}
        for lang, (content, n) in known.items():
            d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            c = zstd.ZstdCompressor(level=6, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
            size[lang] = len(c.compress(language_id.plain(text))) + np.log2(total / n) / 8
        low = sorted(size.items(), key=lambda x: (x[1], x[0]))
        assert r.lang_pred == low[0][0]
        assert abs(r.margin - (low[1][1] / low[0][1] - 1)) < 1e-9 and r.rejected == (r.margin < 0.005)
        assert abs(r.score - 1 / sum(np.exp(-50 * (s / low[0][1] - 1)) for s in size.values())) < 1e-9


def marginals(tagger, words):
    """Log-space forward and backward of one chain."""
    e = [0.0 + tagger.weights[toxicity.cells(toxicity.word(w))].sum() + tagger.bias for w in words]
    e = np.clip(np.array([[0.0, x] for x in e]), -25, 25)
    fwd, bwd = [e[0]], [np.zeros(2)]
    for x in e[1:]:
        fwd.append(x + np.logaddexp.reduce(fwd[-1][:, None] + tagger.trans, axis=0))
    for x in e[:0:-1]:
        bwd.append(np.logaddexp.reduce(tagger.trans + (x + bwd[-1])[None, :], axis=1))
    both = np.array(fwd) + np.array(bwd[::-1])
    return np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1]))


def test_toxicity_by_direct_recursions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    tagger = toxicity.train(*toxicity.sample(docs, labels, fold(5) != 0), rounds=10)
    some = docs.where("doc_id % 12 = 0")
    texts = {r.doc_id: r.text for r in some.collect()}
    got = {r.doc_id: r for r in toxicity.tag(some, tagger).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        words = text.split()
        p = marginals(tagger, words) if words else np.zeros(0)  # one chain, whatever its length
        top = [*np.sort(p)[::-1][:2], 0.0, 0.0][:2]
        z = tagger.document @ np.array([1.0, top[0], top[1], np.log1p(p[p > 0.01].sum())])
        assert abs(got[i].score - 1 / (1 + np.exp(-z))) < 1e-6
        assert len(got[i].spans) == int((np.diff(np.append(False, p >= 0.5).astype(int)) == 1).sum())
        assert all(s.p >= 0.5 and text[s.begin:s.end].strip() for s in got[i].spans)


def test_chains_of_any_length():
    """Blocks change nothing: odds of long chains, cut or not, and of strong
    transitions equal the recursions in logarithms."""
    rng = np.random.default_rng(3)
    for trans in (np.zeros((2, 2)), np.array([[3.0, -4.0], [-4.0, 3.0]]), rng.normal(size=(2, 2)) * 3):
        sizes = [0, 1, 127, 128, 129, 0, 256, 1000, 5, 12_345, 384]
        e = rng.normal(size=sum(sizes)) * 4
        fwd, bwd = toxicity.Chains(sizes).odds(e, trans)
        at = 0
        for n in sizes:
            x, f, b = e[at:at + n], [], []
            for t in range(n):
                f.append(x[t] + (0 if t == 0 else np.logaddexp(trans[0, 1], trans[1, 1] + f[-1])
                                 - np.logaddexp(trans[0, 0], trans[1, 0] + f[-1])))
            for t in range(n - 1, -1, -1):
                g = 0 if t == n - 1 else x[t + 1] + b[-1]
                b.append(0.0 if t == n - 1 else np.logaddexp(trans[1, 0], trans[1, 1] + g)
                         - np.logaddexp(trans[0, 0], trans[0, 1] + g))
            assert np.allclose(np.log(fwd[at:at + n]), f, atol=1e-6)
            assert np.allclose(np.log(bwd[at:at + n]), b[::-1], atol=1e-6)
            at += n


def test_sample_of_a_repeated_id_is_bounded(spark):
    docs = spark.range(3000).select((F.col("id") % 2).alias("doc_id"), F.concat(F.lit("w "), F.col("id")).alias("text"))
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int")
    rows, sizes = toxicity.sample(docs, labels, F.lit(True), toxic_docs=10, clean_docs=30)
    assert len(rows) == 40 and sizes == {0: 1, 1: 1}
