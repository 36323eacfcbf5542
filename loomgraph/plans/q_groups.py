"""Counts, member lists, bounds and defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text as tx
from loomgraph.operators.chunks import ordinal_in_group
from loomgraph.plans import sql_text as S
from loomgraph.plans import stages
from loomgraph.plans.q_chunks import CHUNK_SIZE, CHUNKS_SQL, doc_chunks
from loomgraph.plans.q_condense import NODES_SQL, doc_nodes
from loomgraph.plans.q_vectors import K_GRAPH, SQL_KNN, knn
from loomgraph.operators import simjoin
from loomgraph.plans.registry import register
from loomgraph.sources.tables import read_table

# user parameters of the bounded run: documents, sentences and chunks each have their own
HEAD_DOCS, HEAD_SENTENCES, HEAD_CHUNKS = 300, 2000, 150


def head(df, order: list[str], n: int):
    """First ``n`` rows in a total order: every task keeps its own ``n`` best."""
    return df.orderBy(*order).limit(n)


@register("missing_community", sql="""
SELECT d.doc_id, CAST(coalesce(l.quality, -1) AS BIGINT) AS community
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q_missing_community(spark, sf_dir):
    """Rows without a community get -1."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (read_table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")
            .select("doc_id", F.coalesce(F.col("quality"), F.lit(-1)).cast("long").alias("community")))


@register("graph_counts", sql=SQL_KNN + f""",
und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM ranked WHERE rnk <= {K_GRAPH})
SELECT (SELECT count(*) FROM embeddings) AS n_nodes, (SELECT count(*) FROM und) AS n_edges""")
def q_graph_counts(spark, sf_dir):
    """A4: vertices and undirected edges of the kNN graph."""
    nodes = read_table(spark, sf_dir, "embeddings").select(F.lit(1).alias("n"), F.lit(0).alias("e"))
    edges = simjoin.undirected(knn(spark, sf_dir)).select(F.lit(0).alias("n"), F.lit(1).alias("e"))
    return nodes.unionByName(edges).agg(F.sum("n").cast("long").alias("n_nodes"), F.sum("e").cast("long").alias("n_edges"))


@register("community_members", sql=f"""WITH {NODES_SQL}
SELECT community, row_number() OVER (PARTITION BY community ORDER BY id) - 1 AS ordinal, id FROM nodes""")
def q_community_members(spark, sf_dir):
    """A2: the ordered members of each community, one row per member, so a
    community of any size is never one cell."""
    nodes = doc_nodes(spark, sf_dir).select("community", "id")
    return ordinal_in_group(nodes, "community", "id").select("community", F.col("ordinal").cast("long"), "id")


@register("community_tokens", sql=f"""WITH {NODES_SQL}
SELECT community, count(*) AS n_members, CAST(sum({S.word_count('text')}) AS BIGINT) AS n_tokens
FROM nodes GROUP BY community""")
def q_community_tokens(spark, sf_dir):
    """A5: word totals per community."""
    return (doc_nodes(spark, sf_dir).groupBy("community")
            .agg(F.count(F.lit(1)).alias("n_members"), F.sum(tx.word_count("text")).cast("long").alias("n_tokens")))


@register("bounded_heads", sql=CHUNKS_SQL + f"""
SELECT * FROM (SELECT 'documents' AS stage, doc_id, CAST(0 AS BIGINT) AS part FROM documents ORDER BY doc_id LIMIT {HEAD_DOCS})
UNION ALL
SELECT * FROM (SELECT 'sentences' AS stage, doc_id, CAST(pos AS BIGINT) AS part FROM sents ORDER BY doc_id, pos LIMIT {HEAD_SENTENCES})
UNION ALL
SELECT * FROM (SELECT 'chunks' AS stage, doc_id, chunk AS part FROM chunks ORDER BY doc_id, chunk LIMIT {HEAD_CHUNKS})""")
def q_bounded_heads(spark, sf_dir):
    """S1 + L1: heads of documents, sentences and chunks, each with its own
    bound and an explicit order (the bound is the feature here)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    sents = stages.sentences(spark, sf_dir).select("doc_id", "pos")
    chunks = doc_chunks(spark, sf_dir).select("doc_id", "chunk")
    parts = [("documents", head(docs, ["doc_id"], HEAD_DOCS), F.lit(0)),
             ("sentences", head(sents, ["doc_id", "pos"], HEAD_SENTENCES), F.col("pos")),
             ("chunks", head(chunks, ["doc_id", "chunk"], HEAD_CHUNKS), F.col("chunk"))]
    a, b, c = (df.select(F.lit(name).alias("stage"), "doc_id", part.cast("long").alias("part")) for name, df, part in parts)
    return a.unionByName(b).unionByName(c)
