"""Condensing queries: extractive chunk summaries and
community summaries of the document graph, communities = ``source``."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text as tx
from loomgraph.operators import chunks as ch
from loomgraph.operators import condense as cd
from loomgraph.operators import graph as g
from loomgraph.operators import sentences as st
from loomgraph.operators import simjoin
from loomgraph.operators import tfidf as tv
from loomgraph.operators.louvain import louvain
from loomgraph.plans import q_sparse
from loomgraph.plans import sql_text as S
from loomgraph.plans import stages
from loomgraph.plans.q_chunks import CHUNK_SIZE, CHUNKS_SQL
from loomgraph.plans.registry import register
from loomgraph.session import materialize
from loomgraph.sources.tables import read_table

SUMMARY_BUDGET = 256


def chunked_sentences(spark, sf_dir):
    """Sentences with their chunk, a table: scores, chunk texts and budgets read it."""
    return materialize(ch.assign_chunks(stages.sentences(spark, sf_dir), CHUNK_SIZE).drop("ordinal"), "chunked", codec="zstd")


def extractive(spark, sf_dir):
    s = chunked_sentences(spark, sf_dir)
    return cd.extractive_chunks(s, materialize(ch.chunk_texts(s), "chunks", codec="zstd"))


EXTRACTIVE_SQL = CHUNKS_SQL + f""",
nsent AS (SELECT count(*) AS n FROM sents),
stoks AS (SELECT DISTINCT doc_id, pos, term FROM
          (SELECT doc_id, pos, unnest(regexp_extract_all(lower(sentence), {S.q(tv.TERM)})) AS term FROM sents)),
stoks_all AS (SELECT doc_id, pos, unnest(regexp_extract_all(lower(sentence), {S.q(tv.TERM)})) AS term FROM sents),
sidf AS (SELECT term, ln((n + 1.0) / (count(*) + 1.0)) AS idf FROM stoks, nsent GROUP BY term, n),
sc AS (SELECT doc_id, pos, round(avg(idf), 9) AS score FROM stoks_all JOIN sidf USING (term) GROUP BY doc_id, pos),
srows AS (SELECT o.doc_id, o.pos, o.sentence, o.ordinal // {CHUNK_SIZE} AS chunk,
                 coalesce(sc.score, 0.0) AS score, {S.word_count('o.sentence')} AS nw
          FROM ords o LEFT JOIN sc USING (doc_id, pos)),
bud AS (SELECT doc_id, chunk, n_tokens, least(512, greatest(30, least(n_tokens, 1024) * 8 // 10)) AS max_len
        FROM (SELECT doc_id, chunk, {S.word_count('text')} AS n_tokens FROM chunks)),
rk AS (SELECT r.*, b.max_len,
              row_number() OVER (PARTITION BY r.doc_id, r.chunk ORDER BY score DESC, pos) AS rk,
              sum(nw) OVER (PARTITION BY r.doc_id, r.chunk ORDER BY score DESC, pos
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
       FROM srows r JOIN bud b ON r.doc_id = b.doc_id AND r.chunk = b.chunk),
picked AS (SELECT doc_id, chunk, string_agg({S.budget_cut('sentence', 'max_len')}, ' ' ORDER BY pos) AS summary
           FROM rk WHERE nw > 0 AND run - nw < max_len GROUP BY doc_id, chunk),
ext AS (SELECT b.doc_id, b.chunk, CAST(b.n_tokens AS BIGINT) AS n_tokens,
               CASE WHEN b.n_tokens < 10 THEN '' ELSE coalesce(p.summary, '') END AS summary
        FROM bud b LEFT JOIN picked p ON b.doc_id = p.doc_id AND b.chunk = p.chunk)"""


@register("extractive_chunks", sql=EXTRACTIVE_SQL + "\nSELECT doc_id, chunk, n_tokens, summary FROM ext")
def q_extractive_chunks(spark, sf_dir):
    return extractive(spark, sf_dir)


# ------------------------------------------------ document graph, communities

def doc_nodes(spark, sf_dir):
    """Good documents as graph nodes: ``(id, community, text)`` with the P5
    node text and ``source`` as the community."""
    good = stages.good_docs(spark, sf_dir)
    src = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return good.join(src, "doc_id").select(F.col("doc_id").alias("id"), F.col("source").alias("community"),
                                           tx.node_text("text").alias("text"))


NODES_BODY = f"""nodes AS (SELECT c.doc_id AS id, d.source AS community, {S.node_text('c.text')} AS text
          FROM clean c JOIN documents d ON c.doc_id = d.doc_id WHERE {S.good_line('c.text')})"""
NODES_SQL = f"{S.clean_docs_cte()},\n{NODES_BODY}"


@register("community_texts", sql=f"""WITH {NODES_SQL}
SELECT community, part, string_agg(text, ' ' ORDER BY id) AS text, count(*) AS n_members
FROM (SELECT *, (row_number() OVER (PARTITION BY community ORDER BY id) - 1) // 1000 AS part FROM nodes
      WHERE {S.strip('text')} <> '') GROUP BY community, part""")
def q_community_texts(spark, sf_dir):
    return cd.community_texts(doc_nodes(spark, sf_dir))


def doc_graph(spark, sf_dir):
    """Undirected top-k TF-IDF graph of the good documents (N1, sparse J2)."""
    return simjoin.undirected(q_sparse.doc_pairs(spark, sf_dir), weight="sim")


COMMUNITY_SQL = q_sparse.PAIRS_SQL + f""",
und AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, max(sim) AS weight FROM knn GROUP BY 1, 2),
{NODES_BODY},
inner_e AS (SELECT ls.community, und.src, und.dst FROM und JOIN nodes ls ON und.src = ls.id
            JOIN nodes ld ON und.dst = ld.id WHERE ls.community = ld.community),
sizes AS (SELECT community, count(*) AS size FROM nodes GROUP BY community),
ideg AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM inner_e UNION ALL SELECT dst FROM inner_e)
         GROUP BY id),
cent AS (SELECT nodes.id, nodes.community, nodes.text, sizes.size,
                CASE WHEN sizes.size <= 1 THEN 1.0 ELSE coalesce(ideg.degree, 0) / (sizes.size - 1) END AS centrality
         FROM nodes JOIN sizes USING (community) LEFT JOIN ideg USING (id)),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY community ORDER BY centrality DESC, id) AS rank
                       FROM cent) WHERE rank <= floor(size * 9 / 10)),
crk AS (SELECT *, {S.word_count('text')} AS nw FROM top WHERE {S.strip('text')} <> ''),
crun AS (SELECT *, row_number() OVER (PARTITION BY community ORDER BY rank) AS rk,
                sum(nw) OVER (PARTITION BY community ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
         FROM crk),
cpick AS (SELECT community, string_agg({S.budget_cut('text', SUMMARY_BUDGET)}, ' ' ORDER BY rank) AS summary FROM crun
          WHERE nw > 0 AND run - nw < {SUMMARY_BUDGET} GROUP BY community),
csum AS (SELECT c.community, CASE WHEN coalesce(trim(p.summary), '') = '' THEN '{cd.NO_SUMMARY}' ELSE p.summary END AS summary
         FROM (SELECT DISTINCT community FROM nodes) c LEFT JOIN cpick p USING (community))"""


#: modularity a sweep must add: on the documents of sf0.01 the partition has 0.7243
#: of the 0.7259 that 1e-6 reaches, in about half the rounds
MIN_GAIN = 1e-3


def computed_nodes(spark, sf_dir):
    """Good documents with communities computed on their own graph: the
    Louvain partition of the top-k TF-IDF graph of the same documents."""
    def build():
        good = stages.good_docs(spark, sf_dir)
        labels = louvain(doc_graph(spark, sf_dir), good.select(F.col("doc_id").alias("id")), min_gain=MIN_GAIN)
        return materialize(good.withColumnRenamed("doc_id", "id").join(labels, "id")
                           .select("id", "community", tx.node_text("text").alias("text")), "nodes")
    return stages.cached("computed_nodes", spark, sf_dir, build)


COMPUTED_BODY = S.louvain(f"SELECT doc_id AS u FROM clean WHERE {S.good_line('text')}", min_gain=MIN_GAIN) + f""",
nodes AS (SELECT c.doc_id AS id, s.c AS community, {S.node_text('c.text')} AS text
          FROM clean c JOIN swept s ON s.u = c.doc_id WHERE {S.good_line('c.text')})"""


def computed(sql: str) -> str:
    """An oracle over ``source`` communities, over computed ones instead."""
    return S.recursive(sql.replace(NODES_BODY, COMPUTED_BODY))


def community_summaries(spark, sf_dir, nodes=None):
    nodes = materialize(doc_nodes(spark, sf_dir), "nodes") if nodes is None else nodes
    und = doc_graph(spark, sf_dir)
    labels = nodes.select("id", "community")
    central = g.top_fraction(g.degree_centrality(und, labels)).join(nodes.select("id", "text"), "id")
    return cd.community_summaries(central, labels, budget=SUMMARY_BUDGET)


@register("top_fraction_docs", sql=COMMUNITY_SQL + """
SELECT id, community, CAST(rank AS BIGINT) AS rank FROM top""")
def q_top_fraction_docs(spark, sf_dir):
    nodes = doc_nodes(spark, sf_dir)
    und = doc_graph(spark, sf_dir)
    return g.top_fraction(g.degree_centrality(und, nodes.select("id", "community"))).select("id", "community", "rank")


@register("community_summary", sql=COMMUNITY_SQL + "\nSELECT community, summary FROM csum")
def q_community_summary(spark, sf_dir):
    return community_summaries(spark, sf_dir)


@register("community_summary_computed", sql=computed(COMMUNITY_SQL) + "\nSELECT community, summary FROM csum")
def q_community_summary_computed(spark, sf_dir):
    """M3 over computed communities."""
    return community_summaries(spark, sf_dir, computed_nodes(spark, sf_dir))


FLAT_PACK = 500
FLAT_OUT = 256


@register("flat_reduce", sql="WITH RECURSIVE " + CHUNKS_SQL[len("WITH "):] + f""",
{NODES_BODY},
nsent AS (SELECT count(*) AS n FROM sents),
stoks AS (SELECT DISTINCT doc_id, pos, term FROM
          (SELECT doc_id, pos, unnest(regexp_extract_all(lower(sentence), {S.q(tv.TERM)})) AS term FROM sents)),
stoks_all AS (SELECT doc_id, pos, unnest(regexp_extract_all(lower(sentence), {S.q(tv.TERM)})) AS term FROM sents),
sidf AS (SELECT term, ln((n + 1.0) / (count(*) + 1.0)) AS idf FROM stoks, nsent GROUP BY term, n),
sc AS (SELECT doc_id, pos, round(avg(idf), 9) AS score FROM stoks_all JOIN sidf USING (term) GROUP BY doc_id, pos),
cs AS (SELECT n.community, s.doc_id, s.pos, s.sentence, {S.word_count('s.sentence')} AS ntok,
              coalesce(sc.score, 0.0) AS score,
              row_number() OVER (PARTITION BY n.community ORDER BY s.doc_id, s.pos) AS rn
       FROM sents s JOIN nodes n ON n.id = s.doc_id LEFT JOIN sc ON sc.doc_id = s.doc_id AND sc.pos = s.pos),
pk AS (
  SELECT community, rn, CAST(0 AS BIGINT) AS chunk, ntok AS used FROM cs WHERE rn = 1
  UNION ALL
  SELECT cs.community, cs.rn,
         CASE WHEN pk.used + cs.ntok > {FLAT_PACK} AND pk.used > 0 THEN pk.chunk + 1 ELSE pk.chunk END,
         CASE WHEN pk.used + cs.ntok > {FLAT_PACK} AND pk.used > 0 THEN cs.ntok ELSE pk.used + cs.ntok END
  FROM pk JOIN cs ON cs.community = pk.community AND cs.rn = pk.rn + 1),
prow AS (SELECT cs.*, pk.chunk FROM cs JOIN pk ON pk.community = cs.community AND pk.rn = cs.rn),
prk AS (SELECT *, row_number() OVER (PARTITION BY community, chunk ORDER BY score DESC, doc_id, pos) AS rk,
               sum(ntok) OVER (PARTITION BY community, chunk ORDER BY score DESC, doc_id, pos
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM prow),
psum AS (SELECT community, chunk, string_agg({S.budget_cut('sentence', FLAT_OUT, 'ntok')}, ' ' ORDER BY doc_id, pos) AS summary
         FROM prk WHERE ntok > 0 AND run - ntok < {FLAT_OUT} GROUP BY community, chunk)
SELECT community, string_agg(summary, ' ' ORDER BY chunk) AS summary, count(*) AS n_packs
FROM psum GROUP BY community""")
def q_flat_reduce(spark, sf_dir):
    """M5 per community (``source``) over the member documents' sentences."""
    s = q_chunk_sentences(spark, sf_dir)
    scored = cd.sentence_scores(s, ["doc_id", "pos"])
    nodes = doc_nodes(spark, sf_dir).select(F.col("id").alias("doc_id"), "community")
    rows = scored.join(nodes, "doc_id").withColumn("o", F.struct("doc_id", "pos"))
    return cd.flat_reduce(rows.select("community", "o", "sentence", "score"), "community", "o",
                          "sentence", FLAT_PACK, FLAT_OUT)


def q_chunk_sentences(spark, sf_dir):
    return stages.sentences(spark, sf_dir)


@register("tree_reduce")
def q_tree_reduce(spark, sf_dir):
    """M4 per community (``source``): pack at 450 tokens, condense, repeat
    (rows-only oracle; rounds are bounded)."""
    s = q_chunk_sentences(spark, sf_dir)
    scored = cd.sentence_scores(s, ["doc_id", "pos"])
    nodes = doc_nodes(spark, sf_dir).select(F.col("id").alias("doc_id"), "community")
    rows = scored.join(nodes, "doc_id").withColumn("o", F.struct("doc_id", "pos"))
    return cd.tree_reduce(rows.select("community", "o", "sentence", "score"), "community", "o", "sentence")
