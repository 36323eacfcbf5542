"""Queries over the ``embeddings`` table: kNN graph slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions.vectors import l2_norm, l2_normalize, sum_array

from loomgraph.operators import cell_index, simjoin
from loomgraph.operators.embed import embedding_stats
from loomgraph.operators.graph import weighted_degree
from loomgraph.plans.registry import register
from loomgraph.sources.tables import read_table

K_GRAPH = 5

# DuckDB: unit vectors (zero vectors unchanged) and exact directed top-k.
SQL_UNIT = """
unit AS (
  SELECT vec_id AS id,
         CASE WHEN nrm > 0 THEN list_transform(e, lambda x: x / nrm) ELSE e END AS u
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
               sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS nrm
        FROM embeddings))"""

SQL_KNN = f"""
WITH {SQL_UNIT},
pairs AS (
  SELECT a.id AS src, b.id AS dst, round(list_dot_product(a.u, b.u), 6) AS s
  FROM unit a JOIN unit b ON a.id <> b.id),
ranked AS (
  SELECT src, dst, s, row_number() OVER (PARTITION BY src ORDER BY s DESC, dst) AS rnk
  FROM pairs)"""


def knn(spark, sf_dir, k=K_GRAPH):
    return simjoin.knn_edges(read_table(spark, sf_dir, "embeddings"), k)


@register("knn_edges", sql=SQL_KNN + f"""
SELECT src, dst, round(s, 6) AS sim, CAST(rnk AS BIGINT) AS rank
FROM ranked WHERE rnk <= {K_GRAPH}""")
def q_knn_edges(spark, sf_dir):
    return knn(spark, sf_dir)


SQL_UNDIRECTED = SQL_KNN + f""",
und AS (
  SELECT least(src, dst) AS src, greatest(src, dst) AS dst, max(round(s, 6)) AS weight
  FROM ranked WHERE rnk <= {K_GRAPH} GROUP BY 1, 2)"""


@register("knn_undirected", sql=SQL_UNDIRECTED + "\nSELECT src, dst, weight FROM und")
def q_knn_undirected(spark, sf_dir):
    return simjoin.undirected(knn(spark, sf_dir))


@register("weighted_degree", sql=SQL_UNDIRECTED + """,
ends AS (SELECT src AS node, weight FROM und UNION ALL SELECT dst AS node, weight FROM und)
SELECT node, count(*) AS degree, round(sum(weight), 6) AS strength
FROM ends GROUP BY node""")
def q_weighted_degree(spark, sf_dir):
    return weighted_degree(simjoin.undirected(knn(spark, sf_dir)))


@register("pair_sample", sql=f"""
WITH {SQL_UNIT},
head AS (SELECT * FROM unit ORDER BY id LIMIT 5)
SELECT a.id AS i, b.id AS j, round(list_dot_product(a.u, b.u), 6) AS sim
FROM head a JOIN head b ON a.id < b.id""")
def q_pair_sample(spark, sf_dir):
    return simjoin.pair_sample(read_table(spark, sf_dir, "embeddings"), 5)


@register("embedding_stats", sql="""
WITH v AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)
SELECT (SELECT count(*) FROM embeddings) AS n_rows,
       (SELECT CAST(max(len(embedding)) AS BIGINT) FROM embeddings) AS dim,
       round(min(x), 6) AS min_value, round(max(x), 6) AS max_value,
       round(avg(x), 6) AS mean_value
FROM v""")
def q_embedding_stats(spark, sf_dir):
    return embedding_stats(read_table(spark, sf_dir, "embeddings"), "embedding")


@register("l2_normalize", sql=f"""
WITH {SQL_UNIT}
SELECT id AS vec_id, round(sqrt(list_sum(list_transform(u, lambda x: x * x))), 6) AS norm,
       round(u[1], 6) AS first_value, round(list_sum(u), 6) AS value_sum
FROM unit""")
def q_l2_normalize(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    u = e.select("vec_id", l2_normalize("embedding").alias("u"))
    return u.select("vec_id", F.round(l2_norm("u"), 6).alias("norm"),
                    F.round(F.element_at("u", 1), 6).alias("first_value"),
                    F.round(sum_array("u"), 6).alias("value_sum"))


def _edge_vectors(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    a = e.select(F.col("vec_id").alias("src"), F.col("embedding").alias("va"))
    b = e.select(F.col("vec_id").alias("dst"), F.col("embedding").alias("vb"))
    return knn(spark, sf_dir).select("src", "dst").join(a, "src").join(b, "dst")


SQL_EDGE_VECS = SQL_KNN + f""",
ev AS (SELECT r.src, r.dst, CAST(a.embedding AS DOUBLE[]) AS va, CAST(b.embedding AS DOUBLE[]) AS vb
       FROM ranked r JOIN embeddings a ON a.vec_id = r.src JOIN embeddings b ON b.vec_id = r.dst
       WHERE r.rnk <= {K_GRAPH})"""


@register("cosine_pairs", sql=SQL_EDGE_VECS + """,
n AS (SELECT src, dst, list_dot_product(va, vb) AS d,
             sqrt(list_sum(list_transform(va, lambda x: x * x))) AS na,
             sqrt(list_sum(list_transform(vb, lambda x: x * x))) AS nb FROM ev)
SELECT src, dst, round(CASE WHEN na > 0 AND nb > 0 THEN d / (na * nb) ELSE 0.0 END, 6) AS cos FROM n""")
def q_cosine_pairs(spark, sf_dir):
    """P14 on the raw vectors of every kNN edge (the column expression
    against the BLAS tiles)."""
    from loomgraph.functions.vectors import cosine
    return _edge_vectors(spark, sf_dir).select("src", "dst", F.round(cosine("va", "vb"), 6).alias("cos"))


@register("l2_pairs", sql=SQL_EDGE_VECS + """
SELECT src, dst, round(list_sum(list_transform(list_zip(va, vb), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), 6)
       AS sq_dist FROM ev""")
def q_l2_pairs(spark, sf_dir):
    """Squared L2 distance of every kNN edge's raw vectors."""
    from loomgraph.functions.vectors import squared_l2
    return _edge_vectors(spark, sf_dir).select("src", "dst", F.round(squared_l2("va", "vb"), 6).alias("sq_dist"))


@register("align_check", sql=f"""
WITH {SQL_UNIT}
SELECT e.vec_id, CAST(e.label AS BIGINT) AS label, round(sqrt(list_sum(list_transform(u.u, lambda x: x * x))), 6) AS norm
FROM embeddings e JOIN unit u ON u.id = e.vec_id""")
def q_align_check(spark, sf_dir):
    """Vectors and their rows aligned 1:1 by key; any row without a
    partner on either side raises instead of being dropped."""
    e = read_table(spark, sf_dir, "embeddings")
    u = e.select("vec_id", l2_normalize("embedding").alias("u"))
    j = simjoin.align_by_key(e.select("vec_id", F.col("label").cast("long").alias("label")), u, "vec_id")
    return j.select("vec_id", "label", F.round(l2_norm("u"), 6).alias("norm"))


@register("knn_lsh")
def q_knn_lsh(spark, sf_dir):
    """Approximate top-k by random-hyperplane LSH with tiled buckets
    (rows-only oracle; recall against the exact join is tested)."""
    from loomgraph.operators.lsh import knn_lsh
    return knn_lsh(read_table(spark, sf_dir, "embeddings"), K_GRAPH)


CELLS, PROBES = 32, 20


def searched(spark, sf_dir, probes):
    e = read_table(spark, sf_dir, "embeddings")
    index = cell_index.build(e, CELLS, "vec_id", "embedding")
    hits = cell_index.search(index, e.where("vec_id % 50 = 0"), K_GRAPH, probes, "vec_id", "embedding", exclude_self=True)
    return hits.select("query", "id", "dist", F.col("rank").cast("long").alias("rank"))


@register("cell_search")
def q_cell_search(spark, sf_dir):
    """S11 + J3 for large tables: every 50th vector against an index of cells, of
    which each query probes some (recall tested)."""
    return searched(spark, sf_dir, PROBES)


@register("cell_search_all", sql="""
SELECT query, id, dist, rank FROM (
  SELECT a.vec_id AS query, b.vec_id AS id, round(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i:
           (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE)) ^ 2)), 6) AS dist,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY dist, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0) WHERE rank <= 5""")
def q_cell_search_all(spark, sf_dir):
    """The same with all cells probed, which is the exact search."""
    return searched(spark, sf_dir, CELLS)
