"""Chunking, budgets and duplicate queries over document sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text as tx
from loomgraph.operators import chunks as ch
from loomgraph.operators import neardup
from loomgraph.operators import sentences as st
from loomgraph.plans import sql_text as S
from loomgraph.plans import stages
from loomgraph.plans.registry import register
from loomgraph.sources.tables import read_table, spread

CHUNK_SIZE = 4
PACK_TOKENS = 50

SENTS_SQL = f"WITH {S.clean_docs_cte()}, {S.sentences_cte()}"


def sentences(spark, sf_dir):
    return stages.sentences(spark, sf_dir)


def doc_chunks(spark, sf_dir):
    return ch.chunks_per_document(sentences(spark, sf_dir), CHUNK_SIZE)


CHUNKS_SQL = SENTS_SQL + f""",
ords AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS ordinal FROM sents),
chunks AS (SELECT doc_id, CAST(ordinal // {CHUNK_SIZE} AS BIGINT) AS chunk, count(*) AS n_sentences,
                  string_agg(sentence, ' ' ORDER BY pos) AS text
           FROM ords GROUP BY doc_id, ordinal // {CHUNK_SIZE})"""


@register("chunks_per_doc", sql=CHUNKS_SQL + "\nSELECT doc_id, chunk, n_sentences, text FROM chunks")
def q_chunks_per_doc(spark, sf_dir):
    return doc_chunks(spark, sf_dir)


@register("chunks_corpus", sql=SENTS_SQL + f""",
ords AS (SELECT *, row_number() OVER (ORDER BY doc_id, pos) - 1 AS ordinal FROM sents)
SELECT CAST(ordinal // {CHUNK_SIZE} AS BIGINT) AS chunk, count(*) AS n_sentences,
       string_agg(sentence, ' ' ORDER BY ordinal) AS text
FROM ords GROUP BY ordinal // {CHUNK_SIZE}""")
def q_chunks_corpus(spark, sf_dir):
    return ch.chunks_corpus(sentences(spark, sf_dir), CHUNK_SIZE)


@register("token_pack", sql="WITH RECURSIVE" + SENTS_SQL[len("WITH"):] + f""",
s AS (SELECT doc_id, pos, sentence, {S.word_count('sentence')} AS ntok,
             row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rn FROM sents),
r AS (
  SELECT doc_id, rn, CAST(0 AS BIGINT) AS chunk, ntok AS used FROM s WHERE rn = 1
  UNION ALL
  SELECT s.doc_id, s.rn,
         CASE WHEN r.used + s.ntok > {PACK_TOKENS} AND r.used > 0 THEN r.chunk + 1 ELSE r.chunk END,
         CASE WHEN r.used + s.ntok > {PACK_TOKENS} AND r.used > 0 THEN s.ntok ELSE r.used + s.ntok END
  FROM r JOIN s ON s.doc_id = r.doc_id AND s.rn = r.rn + 1)
SELECT s.doc_id, r.chunk, count(*) AS n_sentences, CAST(sum(s.ntok) AS BIGINT) AS n_tokens,
       string_agg(s.sentence, ' ' ORDER BY s.pos) AS text
FROM r JOIN s ON s.doc_id = r.doc_id AND s.rn = r.rn
GROUP BY s.doc_id, r.chunk""")
def q_token_pack(spark, sf_dir):
    p = ch.token_pack(sentences(spark, sf_dir), "doc_id", "pos", "sentence", PACK_TOKENS)
    return p.select("doc_id", "chunk", "n_sentences", F.col("n_tokens").cast("long"), "text")


@register("length_budget", sql=CHUNKS_SQL + f""",
nt AS (SELECT doc_id, chunk, {S.word_count('text')} AS n_tokens FROM chunks),
b AS (SELECT *, greatest(30, least(n_tokens, 1024) * 8 // 10) AS t FROM nt)
SELECT doc_id, chunk, n_tokens, CAST(least(512, t) AS BIGINT) AS max_len, CAST(t * 6 // 10 AS BIGINT) AS min_len,
       CASE WHEN n_tokens < 10 THEN 1 ELSE 0 END AS skipped
FROM b""")
def q_length_budget(spark, sf_dir):
    c = doc_chunks(spark, sf_dir).select("doc_id", "chunk", tx.word_count("text").alias("n_tokens"))
    mx, mn = ch.length_budget("n_tokens")
    return c.select("doc_id", "chunk", "n_tokens", mx, mn,
                    F.when(F.col("n_tokens") < 10, 1).otherwise(0).alias("skipped"))


@register("reduction_targets", sql=SENTS_SQL + f""",
t AS (SELECT doc_id, CAST(sum({S.word_count('sentence')}) AS BIGINT) AS total FROM sents GROUP BY doc_id)
SELECT doc_id, total, greatest(60, CAST(floor(CAST(total AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS BIGINT)) AS target FROM t""")
def q_reduction_targets(spark, sf_dir):
    """The words each document's kept sentences are to be reduced to."""
    t = sentences(spark, sf_dir).groupBy("doc_id").agg(F.sum(tx.word_count("sentence")).cast("long").alias("total"))
    return t.select("doc_id", "total", ch.reduction_target("total").alias("target"))


@register("fuzzy_dedup_in_text")
def q_fuzzy_dedup_in_text(spark, sf_dir):
    """G5 on every chunk text: ``(doc_id, chunk, text)`` with near-repeated
    sentences removed (rows-only oracle; unit-tested against brute force)."""
    c = doc_chunks(spark, sf_dir)
    return c.select("doc_id", "chunk", ch.dedup_sentences(F.coalesce(F.col("text"), F.lit(""))).alias("text"))


@register("clean_summaries")
def q_clean_summaries(spark, sf_dir):
    """T4 (P4 -> G5 -> F2) applied to the chunk texts as summaries."""
    c = doc_chunks(spark, sf_dir).select("doc_id", "chunk", F.col("text").alias("summary"))
    return ch.clean_summaries(c, "summary")


@register("near_dup_exact", sql=f"""
WITH {S.clean_docs_cte()},
k AS (SELECT doc_id AS id, lower(text) AS norm FROM clean),
reps AS (SELECT norm, min(id) AS rep, count(*) AS cluster_size FROM k GROUP BY norm)
SELECT id, rep, cluster_size FROM k JOIN reps USING (norm)""")
def q_near_dup_exact(spark, sf_dir):
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return ch.exact_duplicate_clusters(d, "doc_id", "text")


@register("near_dup_sentences")
def q_near_dup_sentences(spark, sf_dir):
    """Clusters of near-duplicate sentences of the whole corpus, each row
    with the first sentence of its cluster (tested against all pairs)."""
    return neardup.near_duplicates(sentences(spark, sf_dir), ["doc_id", "pos"], "sentence")
