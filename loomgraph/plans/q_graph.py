"""Graph queries on the kNN graph of ``embeddings``.

The exactly checkable ones use a fixed labelling, the table's ``label``
column; ``louvain`` computes communities (checked by invariants).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text as tx
from loomgraph.operators import graph as g
from loomgraph.operators import simjoin
from loomgraph.operators.louvain import louvain, one_sweep
from loomgraph.plans import sql_text as S
from loomgraph.plans.q_vectors import K_GRAPH, SQL_UNDIRECTED
from loomgraph.plans.registry import register
from loomgraph.sources.tables import read_table

SQL_LABELS = SQL_UNDIRECTED + """,
lab AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS community FROM embeddings),
inner_e AS (SELECT ls.community, und.src, und.dst, und.weight FROM und
            JOIN lab ls ON und.src = ls.id JOIN lab ld ON und.dst = ld.id
            WHERE ls.community = ld.community),
sizes AS (SELECT community, count(*) AS size FROM lab GROUP BY community),
ideg AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM inner_e UNION ALL SELECT dst FROM inner_e)
         GROUP BY id),
cent AS (SELECT lab.id, lab.community, CAST(coalesce(ideg.degree, 0) AS BIGINT) AS degree,
                CAST(sizes.size AS BIGINT) AS size,
                CASE WHEN sizes.size <= 1 THEN 1.0 ELSE coalesce(ideg.degree, 0) / (sizes.size - 1) END AS centrality
         FROM lab JOIN sizes USING (community) LEFT JOIN ideg USING (id))"""


def graph_and_labels(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings")
    und = simjoin.undirected(simjoin.knn_edges(emb, K_GRAPH))
    labels = emb.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("community"))
    return und, labels


@register("graph_vertices", sql=f"""
WITH v AS (SELECT doc_id AS id, {S.node_text("coalesce(text, '')")} AS text FROM documents)
SELECT id, text FROM v WHERE text <> ''""")
def q_graph_vertices(spark, sf_dir):
    """N1 vertices: non-empty node texts (P5); a blank text is no vertex."""
    d = read_table(spark, sf_dir, "documents")
    v = d.select(F.col("doc_id").alias("id"), tx.node_text(F.coalesce("text", F.lit(""))).alias("text"))
    return v.where(F.col("text") != "")


@register("induced_edges", sql=SQL_LABELS + "\nSELECT community, src, dst, weight FROM inner_e")
def q_induced_edges(spark, sf_dir):
    und, labels = graph_and_labels(spark, sf_dir)
    return g.induced_edges(und, labels)


@register("community_sizes", sql=SQL_LABELS + "\nSELECT community, size FROM sizes")
def q_community_sizes(spark, sf_dir):
    _, labels = graph_and_labels(spark, sf_dir)
    return g.community_sizes(labels)


@register("community_order", sql=SQL_LABELS + """
SELECT community, first_node, CAST(row_number() OVER (ORDER BY first_node) AS BIGINT) AS position
FROM (SELECT community, min(id) AS first_node FROM lab GROUP BY community)""")
def q_community_order(spark, sf_dir):
    _, labels = graph_and_labels(spark, sf_dir)
    return g.community_order(labels)


@register("degree_centrality", sql=SQL_LABELS + """
SELECT id, community, degree, size, round(centrality, 6) AS centrality FROM cent""")
def q_degree_centrality(spark, sf_dir):
    und, labels = graph_and_labels(spark, sf_dir)
    c = g.degree_centrality(und, labels)
    return c.withColumn("centrality", F.round("centrality", 6))


@register("top_fraction_nodes", sql=SQL_LABELS + """,
cranked AS (SELECT id, community, size,
                   row_number() OVER (PARTITION BY community ORDER BY centrality DESC, id) AS rnk FROM cent)
SELECT id, community, CAST(rnk AS BIGINT) AS rank FROM cranked WHERE rnk <= floor(size * 9 / 10)""")
def q_top_fraction_nodes(spark, sf_dir):
    und, labels = graph_and_labels(spark, sf_dir)
    return g.top_fraction(g.degree_centrality(und, labels)).select("id", "community", "rank")


@register("modularity_fixed_labels", sql=SQL_LABELS + """,
ends AS (SELECT src AS node, dst AS other, weight FROM und UNION ALL SELECT dst, src, weight FROM und),
lab_e AS (SELECT l1.community AS c, l2.community AS c_other, weight FROM ends
          JOIN lab l1 ON ends.node = l1.id JOIN lab l2 ON ends.other = l2.id),
per_c AS (SELECT c, sum(weight) AS tot, sum(CASE WHEN c = c_other THEN weight ELSE 0 END) AS inside
          FROM lab_e GROUP BY c)
SELECT round(sum(inside) / sum(tot) - sum(tot * tot) / (sum(tot) * sum(tot)), 6) AS modularity FROM per_c""")
def q_modularity_fixed_labels(spark, sf_dir):
    und, labels = graph_and_labels(spark, sf_dir)
    return g.modularity(und, labels)


@register("louvain_one_level", sql=SQL_UNDIRECTED + ",\n" + S.louvain_sweep("SELECT vec_id AS u FROM embeddings") + """
SELECT u AS id, c AS community FROM swept""")
def q_louvain_one_level(spark, sf_dir):
    """N2, one sweep of the first level: the round the whole job repeats."""
    und, labels = graph_and_labels(spark, sf_dir)
    return one_sweep(und, labels.select("id"))


@register("louvain", sql=S.recursive(SQL_UNDIRECTED) + ",\n" + S.louvain("SELECT vec_id AS u FROM embeddings") + """
SELECT u AS id, c AS community FROM swept""")
def q_louvain(spark, sf_dir):
    """Louvain communities of the kNN graph, ``(id, community)``."""
    und, labels = graph_and_labels(spark, sf_dir)
    return louvain(und, labels.select("id"))
