"""Sparse TF-IDF queries over cleaned documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.operators import dense
from loomgraph.operators import sentences as st
from loomgraph.operators import simjoin
from loomgraph.operators import sparse_knn
from loomgraph.operators import tfidf as tv
from loomgraph.plans import sql_text as S
from loomgraph.plans import stages
from loomgraph.plans.registry import register
from loomgraph.session import materialize
from loomgraph.sources.tables import read_table

K = 5


def good_docs(spark, sf_dir):
    return stages.good_docs(spark, sf_dir)


def doc_space(spark, sf_dir):
    """The document TF-IDF space, built once per query (its tables are
    written once; graph, index and queries share them)."""
    return stages.cached("doc_space", spark, sf_dir,
                         lambda: tv.tfidf(good_docs(spark, sf_dir), "doc_id", "text", input_is_table=True))


def doc_pairs(spark, sf_dir):
    """The exact ``K`` nearest other documents of each: ``(src, dst, sim, rank)``."""
    def build():
        return materialize(sparse_knn.topk_texts(doc_space(spark, sf_dir), good_docs(spark, sf_dir), K), "doc_pairs")
    return stages.cached("doc_pairs", spark, sf_dir, build)


def sql_space(corpus_cte: str, id_col: str = "doc_id") -> str:
    """CTEs ``tf, voc, vec(id, term, weight)`` over ``corpus(id, text)``."""
    return f"""{corpus_cte},
toks AS (SELECT {id_col} AS id, unnest(regexp_extract_all(lower(text), {S.q(tv.TERM)})) AS term FROM corpus),
tf AS (SELECT id, term, count(*) AS tf FROM toks GROUP BY id, term),
nd AS (SELECT count(*) AS n FROM corpus),
voc AS (SELECT term, df, ln((n + 1.0) / (df + 1.0)) AS idf
        FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) d, nd),
w AS (SELECT id, term, tf * idf AS w FROM tf JOIN voc USING (term)),
nrm AS (SELECT id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY id),
vec AS (SELECT id, term, w / nrm AS weight FROM w JOIN nrm USING (id) WHERE nrm > 0)"""


DOC_SPACE_SQL = "WITH " + sql_space(f"""{S.clean_docs_cte()},
corpus AS (SELECT doc_id, text FROM clean WHERE {S.good_line('text')})""")

PAIRS_SQL = DOC_SPACE_SQL + f""",
pairs AS (SELECT a.id AS src, b.id AS dst, round(sum(a.weight * b.weight), 6) AS sim
          FROM vec a JOIN vec b ON a.term = b.term AND a.id <> b.id GROUP BY a.id, b.id),
knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS rnk
                       FROM pairs WHERE sim > 0)
        WHERE rnk <= {K})"""


@register("tfidf", sql=DOC_SPACE_SQL + """
SELECT id AS doc_id, term, round(weight, 6) AS weight FROM vec""")
def q_tfidf(spark, sf_dir):
    v = doc_space(spark, sf_dir).vectors
    return v.select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


@register("tfidf_pairs", sql=PAIRS_SQL + """
SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b, sim FROM knn""")
def q_tfidf_pairs(spark, sf_dir):
    """J2 (sparse) as pairs: each neighbouring pair once, with its cosine."""
    p = doc_pairs(spark, sf_dir)
    return p.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "sim").distinct()


@register("tfidf_knn", sql=PAIRS_SQL + """
SELECT src, dst, sim, CAST(rnk AS BIGINT) AS rank FROM knn""")
def q_tfidf_knn(spark, sf_dir):
    return doc_pairs(spark, sf_dir).select("src", "dst", "sim", F.col("rank").cast("long"))


@register("query_vectors", sql=DOC_SPACE_SQL + """,
qt AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '""" + tv.TERM + """')) AS term FROM benchmark),
qtf AS (SELECT item_id, term, count(*) AS tf FROM qt GROUP BY item_id, term),
qw AS (SELECT item_id, term, tf * idf AS w FROM qtf JOIN voc USING (term)),
qn AS (SELECT item_id, sqrt(sum(w * w)) AS nrm FROM qw GROUP BY item_id)
SELECT item_id, term, round(w / nrm, 6) AS weight FROM qw JOIN qn USING (item_id) WHERE nrm > 0""")
def q_query_vectors(spark, sf_dir):
    space = doc_space(spark, sf_dir)
    bench = read_table(spark, sf_dir, "benchmark")
    qv = tv.embed_queries(space, bench, "item_id", "text")
    return qv.select(F.col("id").alias("item_id"), "term", F.round("weight", 6).alias("weight"))


DENSE_DIM = 256


def dense_vectors(spark, sf_dir):
    """Dense vectors of the good documents: ``(doc_id, embedding)``."""
    def build():
        good = good_docs(spark, sf_dir)
        model = dense.fit(good, "doc_id", "text", DENSE_DIM)
        return materialize(dense.transform(good, model, "doc_id", "text"), "dense")
    return stages.cached("dense_vectors", spark, sf_dir, build)


@register("dense_tfidf")
def q_dense_tfidf(spark, sf_dir):
    """E1 dense: hashed TF-IDF vectors of 256 cells (no SQL for the hash; tested
    against a direct computation)."""
    return dense_vectors(spark, sf_dir)


@register("dense_knn")
def q_dense_knn(spark, sf_dir):
    """J2 over the dense text vectors: the exact ``K`` nearest by cosine (tested
    against all pairs)."""
    return simjoin.knn_edges(dense_vectors(spark, sf_dir), K, "doc_id", "embedding")
