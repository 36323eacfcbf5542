"""Queries over ``documents``: cleaning, filters, sentence split."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text as tx
from loomgraph.functions.stopwords import ENGLISH_STOPWORDS
from loomgraph.operators import sentences as st
from loomgraph.plans import sql_text as S
from loomgraph.plans.registry import register
from loomgraph.sources.tables import read_table, spread

LATIN = (0x41, 0x24F)


def docs(spark, sf_dir):
    """Documents spread over the cores: per-row regex work dominates."""
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def cleaned(spark, sf_dir):
    return st.clean_documents(docs(spark, sf_dir))


@register("english_fix", sql=f"""
SELECT doc_id, {S.english_fix("coalesce(text, '')")} AS text FROM documents""")
def q_english_fix(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select("doc_id", tx.english_fix(F.coalesce("text", F.lit(""))).alias("text"))


@register("clean_text", sql=f"WITH {S.clean_docs_cte()} SELECT doc_id, text FROM clean")
def q_clean_text(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register("good_lines", sql=f"""
WITH {S.clean_docs_cte()}
SELECT doc_id, {S.word_count('text')} AS n_words, {S.letter_count('text')} AS n_letters,
       CAST(length(text) AS BIGINT) AS n_chars
FROM clean WHERE {S.good_line('text')}""")
def q_good_lines(spark, sf_dir):
    g = st.good_documents(docs(spark, sf_dir))
    return g.select("doc_id", tx.word_count("text").alias("n_words"),
                    tx.letter_count("text").alias("n_letters"),
                    F.length("text").cast("long").alias("n_chars"))


@register("sentences", sql=f"""
WITH {S.clean_docs_cte()}, {S.sentences_cte()}
SELECT doc_id, pos, sentence FROM sents""")
def q_sentences(spark, sf_dir):
    return st.corpus_sentences(docs(spark, sf_dir))


@register("sentence_counts", sql=f"""
WITH {S.clean_docs_cte()}, {S.sentences_cte()},
np AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_pieces FROM exploded GROUP BY doc_id),
ns AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_sentences FROM sents GROUP BY doc_id)
SELECT np.doc_id, np.n_pieces, coalesce(ns.n_sentences, 0) AS n_sentences
FROM np LEFT JOIN ns ON np.doc_id = ns.doc_id""")
def q_sentence_counts(spark, sf_dir):
    """Pieces and kept sentences per good document, counted with array
    functions on the document row (no explode, no shuffle)."""
    good = st.good_documents(docs(spark, sf_dir))
    return good.select("doc_id", *_piece_counts("text"))


def _piece_counts(text_col):
    parts = tx.sentence_split(text_col)
    kept = F.filter(F.transform(parts, tx.strip),
                    lambda p: (p != F.lit("")) & tx.good_line(p, stripped=True))
    return (F.size(parts).cast("long").alias("n_pieces"), F.size(kept).cast("long").alias("n_sentences"))


@register("stage_counts", sql=f"""
WITH {S.clean_docs_cte()}, {S.sentences_cte()}
SELECT (SELECT count(*) FROM documents) AS n_docs,
       (SELECT count(*) FROM good) AS n_docs_kept,
       (SELECT count(*) FROM exploded) AS n_pieces,
       (SELECT count(*) FROM sents) AS n_sentences""")
def q_stage_counts(spark, sf_dir):
    """A1: row counts before and after each stage, as one aggregate over
    per-document counts (one pass, partial aggregation on every task)."""
    c = st.clean_documents(docs(spark, sf_dir)).withColumn("good", tx.good_line("text", stripped=True))
    n_pieces, n_sent = _piece_counts("text")
    per_doc = c.select("good", F.when(F.col("good"), n_pieces).otherwise(F.lit(0)).alias("p"),
                       F.when(F.col("good"), n_sent).otherwise(F.lit(0)).alias("s"))
    return per_doc.agg(F.count(F.lit(1)).alias("n_docs"),
                       F.count_if("good").alias("n_docs_kept"),
                       F.sum("p").cast("long").alias("n_pieces"),
                       F.sum("s").cast("long").alias("n_sentences"))


@register("stopwords_removed", sql=f"""
WITH {S.clean_docs_cte()},
toks AS (SELECT doc_id, {S.whitespace_tokens('text')} AS w FROM clean)
SELECT doc_id, array_to_string(list_filter(w, lambda x: NOT list_contains(
    [{', '.join(S.q(w) for w in sorted(set(ENGLISH_STOPWORDS)))}], lower(x))), ' ') AS text
FROM toks""")
def q_stopwords_removed(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return c.select("doc_id", tx.remove_stopwords("text", ENGLISH_STOPWORDS).alias("text"))


@register("node_text", sql=f"""
SELECT doc_id, {S.node_text("coalesce(text, '')")} AS text FROM documents""")
def q_node_text(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select("doc_id", tx.node_text(F.coalesce("text", F.lit(""))).alias("text"))


@register("script_clean", sql=f"""
SELECT doc_id, {S.script_clean("coalesce(text, '')", 0x900, 0x97F)} AS text FROM documents""")
def q_script_clean(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select("doc_id", tx.script_clean(F.coalesce("text", F.lit(""))).alias("text"))


@register("script_clean_latin", sql=f"""
SELECT doc_id, {S.script_clean("coalesce(text, '')", *LATIN)} AS text FROM documents""")
def q_script_clean_latin(spark, sf_dir):
    d = docs(spark, sf_dir)
    lo, hi = (chr(c) for c in LATIN)
    return d.select("doc_id", tx.script_clean(F.coalesce("text", F.lit("")), lo, hi).alias("text"))


@register("summary_fix", sql=f"""
SELECT doc_id, {S.summary_fix("coalesce(text, '')")} AS text FROM documents""")
def q_summary_fix(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select("doc_id", tx.summary_fix(F.coalesce("text", F.lit(""))).alias("text"))


@register("good_summaries", sql=f"""
WITH f AS (SELECT doc_id, {S.summary_fix("coalesce(text, '')")} AS text FROM documents)
SELECT doc_id, {S.word_count('text')} AS n_words FROM f WHERE {S.good_summary('text')}""")
def q_good_summaries(spark, sf_dir):
    d = docs(spark, sf_dir)
    f = d.select("doc_id", tx.summary_fix(F.coalesce("text", F.lit(""))).alias("text"))
    f = st.keep_rows(f, lambda r: tx.good_summary(r["text"], stripped=True))
    return f.select("doc_id", tx.word_count("text").alias("n_words"))
