"""Sparse TF-IDF vectors in long form and sparse similarities.

A vector is a set of rows ``(id, term, weight)`` over every term of its text.
Weights are ``tf * ln((N + 1) / (df + 1))``, L2-normalised per id. Exact
neighbours of these vectors: :mod:`loomgraph.operators.sparse_knn`.

Joins against the vocabulary are left to Spark: AQE turns them into
broadcast joins when the runtime size of the vocabulary is under the
broadcast threshold and keeps a shuffled join (with skew splitting) when it
is not.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.operators import termblocks as tb
from loomgraph.session import materialize

# Fixed value: a term is a maximal run of letters and digits of the lower-cased text.
TERM = r"[\p{L}\p{N}]+"
NO_TERM = r"[^\p{L}\p{N}]+"


def terms(text) -> F.Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(TERM), 0)


def spaced_terms(text) -> F.Column:
    """The :func:`terms` joined by a space, as a text."""
    t = F.col(text) if isinstance(text, str) else text
    return F.trim(F.regexp_replace(F.lower(t), NO_TERM, " "))


def term_frequencies(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term, tf)``; aggregated per id, so rows of one id never move
    far: with the input partitioned by id the aggregation needs no
    exchange."""
    toks = df.select(F.col(id_col).alias("id"), F.explode(terms(text_col)).alias("term"))
    return toks.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


@dataclass
class SparseSpace:
    vectors: DataFrame  # (id, term, weight, tid), unit length per id; tid null if no other id has the term
    vocabulary: DataFrame  # (term, tid, df, idf); tid numbers the terms
    n_docs: int


def tfidf(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          input_is_table: bool = False) -> SparseSpace:
    """TF-IDF vectors of ``text_col`` keyed by ``id_col``.
    The input texts, the terms of each block of texts, the vocabulary and the
    vectors are each written once as tables in the checkpoint folder. Texts are
    shuffled in blocks (:mod:`loomgraph.operators.termblocks`), a term once a block;
    single postings are not shuffled. The texts without an id are one vector,
    which may be of any size: their postings are."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if not input_is_table:  # a computed input is written once, then read twice
        docs = materialize(docs, "corpus")
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    rows = tb.placed(docs.where("id is not null"), ["id"], spaced_terms("text"), size.chars or 0).drop("text")
    loose = term_frequencies(docs.where("id is null"), "id", "text")
    counts = materialize(tb.block_counts(rows, ["id"]).unionByName(
        loose.select(F.lit(-1).cast("long").alias("_block"), "term", F.lit(1).cast("long").alias("n"))), "block-terms")
    vocab = (counts.groupBy("term").agg(F.sum("n").alias("df"))
             .withColumn("idf", F.log((F.lit(size.n) + 1.0) / (F.col("df") + 1.0)))
             .withColumn("tid", F.monotonically_increasing_id()))
    vocab = materialize(vocab, "vocabulary")
    shared = vocab.withColumn("tid", F.expr("if(df >= 2, tid, null)"))
    by_block = counts.where("_block >= 0").join(shared, "term").select("_block", "term", "idf", "tid")
    vectors = rows.groupBy("_block").cogroup(by_block.groupBy("_block")).applyInArrow(
        _block_vectors, T.StructType([docs.schema["id"], *(T.StructField(c, t) for c, t in (
            ("term", T.StringType()), ("weight", T.DoubleType()), ("tid", T.LongType())))]))
    vectors = vectors.unionByName(weigh(loose, shared, "tid"))
    return SparseSpace(materialize(vectors, "tfidf"), vocab, size.n)


def _block_vectors(t: pa.Table, vocab: pa.Table) -> pa.Table:
    at, code, words, of_row = tb.occurrences(t, ["id"])
    width = max(len(words), 1)
    both, tf = np.unique(at * width + code, return_counts=True)
    at, code = both // width, both % width
    place = pc.index_in(words, value_set=vocab.column("term").combine_chunks())
    w = tf * vocab.column("idf").take(place).to_numpy()[code] if len(words) else np.zeros(0)
    norm = np.sqrt(np.bincount(at, weights=w * w, minlength=t.num_rows))
    some = norm[at] > 0
    at, code, w = at[some], code[some], w[some]
    first = np.zeros(t.num_rows, np.int64)
    first[of_row[::-1]] = np.arange(t.num_rows)[::-1]
    tid = vocab.column("tid").take(place).take(pa.array(code)) if len(words) else pa.array([], pa.int64())
    return pa.table([t.column("id").take(pa.array(first[at])), words.take(pa.array(code)), pa.array(w / norm[at]), tid],
                    ["id", "term", "weight", "tid"])


def weigh(tf: DataFrame, vocab: DataFrame, *carry: str) -> DataFrame:
    """tf * idf over the vocabulary, L2-normalised per id (also E2 for
    queries: the same vocabulary and idf give one vector space). Columns ``carry``
    of the vocabulary come along."""
    w = tf.join(vocab.select("term", "idf", *carry), "term").select(
        "id", "term", (F.col("tf") * F.col("idf")).alias("w"), *carry)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return (w.withColumn("norm", norm).where(F.col("norm") > 0)
            .select("id", "term", (F.col("w") / F.col("norm")).alias("weight"), *carry))


def embed_queries(space: SparseSpace, queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Query texts as vectors of the corpus space."""
    return weigh(term_frequencies(queries, id_col, text_col), space.vocabulary)


def cross_similarities(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cosine of every (left id, right id) sharing a term: ``(src, dst, sim)``."""
    p = left.select("term", F.col("id").alias("src"), F.col("weight").alias("wa"))
    q = right.select("term", F.col("id").alias("dst"), F.col("weight").alias("wb"))
    return (p.join(q, "term").groupBy("src", "dst")
            .agg(F.sum(F.col("wa") * F.col("wb")).alias("sim")))
