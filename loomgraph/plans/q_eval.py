"""Evaluation, retrieval and training-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgraph.functions import text as tx
from loomgraph.operators import hooks
from loomgraph.operators import retrieve as rt
from loomgraph.operators import rouge as rg
from loomgraph.operators import sentences as st
from loomgraph.operators import tfidf as tv
from loomgraph.operators import trainprep as tp
from loomgraph.operators.condense import NO_SUMMARY
from loomgraph.plans import q_condense, q_sparse
from loomgraph.plans import sql_text as S
from loomgraph.plans import stages
from loomgraph.plans.registry import register
from loomgraph.session import materialize
from loomgraph.sources.tables import read_table, spread

K_RET = 5
K_RERANK = 3
ANSWER_BUDGET = 150
PROMPT_TOKENS = 512
INPUT_LEN = 512
LABEL_LEN = 128
HEAD_PERCENT = 5


def _grams_sql(e: str, n: int) -> str:
    t = f"regexp_extract_all(lower(coalesce({e}, '')), {S.q(rg.TOKEN)})"
    if n == 1:
        return t
    return (f"list_transform([{t}], lambda t: list_transform(range(len(t) - 1), "
            f"lambda i: t[i + 1] || ' ' || t[i + 2]))[1]")


def rouge_sql(pairs_cte_sql: str, key: list[str], n: int) -> str:
    """CTE ``rscore(key..., p, r, f)`` of ROUGE-n over ``rpairs(key..., pred, ref)``."""
    k = ", ".join(key)
    return pairs_cte_sql + f""",
rg_g AS (SELECT {k}, {_grams_sql('pred', n)} AS gp, {_grams_sql('ref', n)} AS gr FROM rpairs),
rg_cp AS (SELECT {k}, gram, count(*) AS cp FROM (SELECT {k}, unnest(gp) AS gram FROM rg_g) GROUP BY {k}, gram),
rg_cr AS (SELECT {k}, gram, count(*) AS cr FROM (SELECT {k}, unnest(gr) AS gram FROM rg_g) GROUP BY {k}, gram),
rg_ov AS (SELECT {k}, sum(least(cp, cr)) AS hit FROM rg_cp JOIN rg_cr USING ({k}, gram) GROUP BY {k}),
rg_s AS (SELECT {k}, len(gp) AS np, len(gr) AS nr, coalesce(rg_ov.hit, 0) AS hit
         FROM rg_g LEFT JOIN rg_ov USING ({k})),
rg_sc AS (SELECT {k}, CASE WHEN np > 0 THEN hit / np ELSE 0.0 END AS p,
                 CASE WHEN nr > 0 THEN hit / nr ELSE 0.0 END AS r FROM rg_s),
rscore AS (SELECT {k}, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM rg_sc)"""


def rounded(df, key):
    return df.select(*key, *[F.round(c, 6).alias(c) for c in ("precision", "recall", "fmeasure")])


# ------------------------------------------------------------------ ROUGE (V5)

CHUNK_PAIRS_SQL = q_condense.EXTRACTIVE_SQL + """,
rpairs AS (SELECT e.doc_id, e.chunk, e.summary AS pred, c.text AS ref
           FROM ext e JOIN chunks c ON e.doc_id = c.doc_id AND e.chunk = c.chunk)"""
CHUNK_KEY = ["doc_id", "chunk"]


def chunk_pairs(spark, sf_dir):
    s = q_condense.chunked_sentences(spark, sf_dir)
    from loomgraph.operators import chunks as ch
    from loomgraph.operators import condense as cd
    chunks = materialize(ch.chunk_texts(s), "chunks", codec="zstd")
    ext = cd.extractive_chunks(s, chunks)
    return ext.join(chunks.select("doc_id", "chunk", F.col("text").alias("ref")), CHUNK_KEY).select(
        *CHUNK_KEY, F.col("summary").alias("pred"), "ref")


for _n in (1, 2):
    def _q(spark, sf_dir, n=_n):
        return rounded(rg.rouge_n(chunk_pairs(spark, sf_dir), CHUNK_KEY, "pred", "ref", n), CHUNK_KEY)
    _q.__doc__ = f"V1: ROUGE-{_n} of every extractive chunk summary against its chunk (V5 aligned by key)."
    register(f"rouge{_n}", sql=rouge_sql(CHUNK_PAIRS_SQL, CHUNK_KEY, _n) + """
SELECT doc_id, chunk, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS fmeasure FROM rscore""")(_q)


def rouge_l_sql(pairs_cte_sql: str, key: list[str]) -> str:
    """CTE ``rscore`` of ROUGE-L over ``rpairs`` (texts of one line) whose
    predictions are extracts: tokens that occur in the reference in this order
    are their own longest common subsequence. Any other prediction gets a null,
    so a pair that is no extract shows as a difference."""
    k = ", ".join(key)
    return pairs_cte_sql + f""",
lt AS (SELECT {k}, {_grams_sql('pred', 1)} AS a, {_grams_sql('ref', 1)} AS b FROM rpairs),
lh AS (SELECT {k}, len(a) AS np, len(b) AS nr,
              CASE WHEN array_to_string(list_transform(b, lambda t: '<' || t || '>'), '')
                        LIKE '%' || array_to_string(list_transform(a, lambda t: '<' || t || '>'), '%') || '%' THEN len(a) END AS hit
       FROM lt),
lsc AS (SELECT {k}, CASE WHEN np > 0 THEN hit / np ELSE 0.0 END AS p, CASE WHEN nr > 0 THEN hit / nr ELSE 0.0 END AS r FROM lh),
rscore AS (SELECT {k}, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM lsc)"""


ROUGE_L_SQL = rouge_l_sql(CHUNK_PAIRS_SQL, CHUNK_KEY) + """
SELECT doc_id, chunk, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS fmeasure FROM rscore"""


@register("rouge_l", sql=ROUGE_L_SQL)
def q_rouge_l(spark, sf_dir):
    """V2: ROUGE-L per chunk pair."""
    return rounded(rg.rouge_l(chunk_pairs(spark, sf_dir), CHUNK_KEY, "pred", "ref"), CHUNK_KEY)


@register("rouge_lsum", sql=ROUGE_L_SQL)
def q_rouge_lsum(spark, sf_dir):
    """V3: summary-level ROUGE-L per chunk pair; chunk texts have one line, where
    it equals ROUGE-L (texts of several lines: tests)."""
    return rounded(rg.rouge_l(chunk_pairs(spark, sf_dir), CHUNK_KEY, "pred", "ref", summary_level=True), CHUNK_KEY)


@register("rouge_aligned", sql=rouge_sql(CHUNK_PAIRS_SQL, CHUNK_KEY, 1) + """
SELECT round(avg(f), 6) AS rouge1_f, CAST(count(*) AS BIGINT) AS n_pairs FROM rscore""")
def q_rouge_aligned(spark, sf_dir):
    """V5 + A7: corpus mean ROUGE-1 F over the aligned chunk pairs."""
    r1 = rg.rouge_n(chunk_pairs(spark, sf_dir), CHUNK_KEY, "pred", "ref", 1)
    return r1.agg(F.round(F.avg("fmeasure"), 6).alias("rouge1_f"), F.count(F.lit(1)).alias("n_pairs"))


COMM_PAIRS_SQL = q_condense.COMMUNITY_SQL + f""",
ctexts AS (SELECT community, string_agg(text, ' ' ORDER BY id) AS text FROM nodes
           WHERE {S.strip('text')} <> '' GROUP BY community),
rpairs AS (SELECT t.community, coalesce(s.summary, '') AS pred, t.text AS ref
           FROM ctexts t LEFT JOIN csum s USING (community))"""


COMM_ROUGE_SQL = """
SELECT community, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS fmeasure FROM rscore"""


def rouge_by_community(spark, sf_dir, n):
    nodes = materialize(q_condense.doc_nodes(spark, sf_dir), "nodes")
    preds = q_condense.community_summaries(spark, sf_dir, nodes).select("community", F.col("summary").alias("pred"))
    refs = nodes.where(tx.non_blank("text")).select("community", "id", "text")
    return rounded(rg.rouge_n_by_group(preds, refs, "community", "pred", "text", n, "id"), ["community"])


@register("rouge_by_community", sql=rouge_sql(COMM_PAIRS_SQL, ["community"], 1) + COMM_ROUGE_SQL)
def q_rouge_by_community(spark, sf_dir):
    """V4 + J7: each community's summary against all its member texts."""
    return rouge_by_community(spark, sf_dir, 1)


@register("rouge2_by_community", sql=rouge_sql(COMM_PAIRS_SQL, ["community"], 2) + COMM_ROUGE_SQL)
def q_rouge2_by_community(spark, sf_dir):
    """V4 with ROUGE-2: bigrams of the member texts joined in id order."""
    return rouge_by_community(spark, sf_dir, 2)


# ------------------------------------------------------------- retrieval

def retrieval(spark, sf_dir, nodes=None):
    space = q_sparse.doc_space(spark, sf_dir)
    summaries = materialize(q_condense.community_summaries(spark, sf_dir, nodes), "summaries")
    index = rt.build_index(space, summaries, "community", "summary")
    bench = read_table(spark, sf_dir, "benchmark")
    qv = tv.embed_queries(space, bench, "item_id", "text")
    asked = bench.select(F.col("item_id").alias("query"))
    hits = rt.l2_search(asked, qv, index, summaries.select(F.col("community").alias("id")), K_RET)
    return space, summaries, bench, qv, hits


RET_SQL = q_condense.COMMUNITY_SQL + f""",
itf AS (SELECT community AS id, term, count(*) AS tf FROM
        (SELECT community, unnest(regexp_extract_all(lower(summary), {S.q(tv.TERM)})) AS term FROM csum)
        GROUP BY ALL),
iw AS (SELECT id, term, tf * idf AS w FROM itf JOIN voc USING (term)),
inrm AS (SELECT id, sqrt(sum(w * w)) AS nrm FROM iw GROUP BY id),
ivec AS (SELECT id, term, w / nrm AS weight FROM iw JOIN inrm USING (id) WHERE nrm > 0),
qtf AS (SELECT item_id AS id, term, count(*) AS tf FROM
        (SELECT item_id, unnest(regexp_extract_all(lower(text), {S.q(tv.TERM)})) AS term FROM benchmark)
        GROUP BY ALL),
qw AS (SELECT id, term, tf * idf AS w FROM qtf JOIN voc USING (term)),
qnrm AS (SELECT id, sqrt(sum(w * w)) AS nrm FROM qw GROUP BY id),
qvec AS (SELECT id, term, w / nrm AS weight FROM qw JOIN qnrm USING (id) WHERE nrm > 0),
xt AS (SELECT q.id AS query, i.id AS id, sum(q.weight * i.weight) AS sim
       FROM qvec q JOIN ivec i ON q.term = i.term GROUP BY q.id, i.id),
xs AS (SELECT b.item_id AS query, c.community AS id, coalesce(xt.sim, 0.0) AS sim
       FROM benchmark b CROSS JOIN csum c LEFT JOIN xt ON xt.query = b.item_id AND xt.id = c.community),
hits AS (SELECT * FROM (SELECT query, id, round(2.0 - 2 * sim, 6) AS dist, round(sim, 6) AS cos,
                               row_number() OVER (PARTITION BY query ORDER BY round(2.0 - 2 * sim, 6), id) AS rank
                        FROM xs) WHERE rank <= {K_RET}),
rr AS (SELECT * FROM (SELECT query, id, cos, row_number() OVER (PARTITION BY query ORDER BY cos DESC, id) AS rerank
                      FROM hits) WHERE rerank <= {K_RERANK}),
ctx AS (SELECT rr.query, string_agg(s.summary, ' ' ORDER BY rr.rerank) AS context
        FROM rr JOIN csum s ON s.community = rr.id GROUP BY rr.query)"""


@register("l2_search", sql=RET_SQL + "\nSELECT query, id, dist, CAST(rank AS BIGINT) AS rank FROM hits")
def q_l2_search(spark, sf_dir):
    """Nearest community summaries of every benchmark query (squared L2)."""
    return retrieval(spark, sf_dir)[4].select("query", "id", "dist", F.col("rank").cast("long"))


@register("cosine_rerank", sql=RET_SQL + "\nSELECT query, id, cos, CAST(rerank AS BIGINT) AS rerank FROM rr")
def q_cosine_rerank(spark, sf_dir):
    """J4 + F6: the retrieved rows reranked by cosine."""
    return rt.cosine_rerank(retrieval(spark, sf_dir)[4], K_RERANK).withColumn("rerank", F.col("rerank").cast("long"))


def contexts(spark, sf_dir, nodes=None):
    space, summaries, bench, qv, hits = retrieval(spark, sf_dir, nodes)
    rr = rt.cosine_rerank(hits, K_RERANK)
    return space, bench, qv, rr, rt.context_text(rr, summaries)


@register("context_text", sql=RET_SQL + "\nSELECT query, context FROM ctx")
def q_context_text(spark, sf_dir):
    return contexts(spark, sf_dir)[4]


@register("prompt_text", sql=RET_SQL + """
SELECT c.query, 'summarize: ' || c.context || ' ' || b.text AS prompt
FROM ctx c JOIN benchmark b ON b.item_id = c.query""")
def q_prompt_text(spark, sf_dir):
    """The generator prompt per query."""
    _, bench, _, _, ctx = contexts(spark, sf_dir)
    j = ctx.join(bench.select(F.col("item_id").alias("query"), "text"), "query")
    return j.select("query", rt.prompt(F.col("context"), F.col("text")).alias("prompt"))


@register("truncate_tokens", sql=RET_SQL + f""",
pr AS (SELECT c.query, {S.whitespace_tokens("'summarize: ' || c.context || ' ' || b.text")} AS toks
       FROM ctx c JOIN benchmark b ON b.item_id = c.query)
SELECT query, CAST(len(toks) AS BIGINT) AS n_tokens,
       array_to_string(toks[1:{PROMPT_TOKENS}], ' ') AS truncated FROM pr""")
def q_truncate_tokens(spark, sf_dir):
    """Prompt cut at the model's 512-token input limit (with its full length)."""
    _, bench, _, _, ctx = contexts(spark, sf_dir)
    j = ctx.join(bench.select(F.col("item_id").alias("query"), "text"), "query")
    p = j.select("query", rt.prompt(F.col("context"), F.col("text")).alias("prompt"))
    return p.select("query", F.size(tx.whitespace_tokens("prompt")).cast("long").alias("n_tokens"),
                    rt.truncate_tokens(F.col("prompt"), PROMPT_TOKENS).alias("truncated"))


ANSWER_SQL = RET_SQL + f""",
{S.sentences_cte()},
cand AS (SELECT rr.query, n.id AS doc_id FROM rr JOIN nodes n ON n.community = rr.id),
stf AS (SELECT doc_id, pos, term, count(*) AS tf FROM
        (SELECT doc_id, pos, unnest(regexp_extract_all(lower(sentence), {S.q(tv.TERM)})) AS term FROM sents) GROUP BY ALL),
sw AS (SELECT doc_id, pos, term, tf * idf AS w FROM stf JOIN voc USING (term)),
snrm AS (SELECT doc_id, pos, sqrt(sum(w * w)) AS nrm FROM sw GROUP BY doc_id, pos),
sterm AS (SELECT doc_id, pos, term, w / nrm AS weight FROM sw JOIN snrm USING (doc_id, pos) WHERE nrm > 0),
asc_ AS (SELECT c.query, s.doc_id, s.pos, round(sum(q.weight * s.weight), 9) AS score
         FROM cand c JOIN sterm s ON s.doc_id = c.doc_id JOIN qvec q ON q.id = c.query AND q.term = s.term
         GROUP BY c.query, s.doc_id, s.pos),
arows AS (SELECT a.*, se.sentence, {S.word_count('se.sentence')} AS nw FROM asc_ a
          JOIN sents se ON se.doc_id = a.doc_id AND se.pos = a.pos),
ar AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id, pos) AS rk,
              sum(nw) OVER (PARTITION BY query ORDER BY score DESC, doc_id, pos
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM arows),
ans AS (SELECT query, string_agg({S.budget_cut('sentence', ANSWER_BUDGET)}, ' ' ORDER BY rk) AS answer FROM ar
        WHERE run - nw < {ANSWER_BUDGET} GROUP BY query)
SELECT b.item_id AS query, coalesce(answer, '{NO_SUMMARY}') AS answer
FROM benchmark b LEFT JOIN ans ON ans.query = b.item_id"""


@register("answer", sql=ANSWER_SQL)
def q_answer(spark, sf_dir):
    """M7 (extractive, T6 end to end): an answer of at most 150 words per
    benchmark query from the retrieved communities' sentences."""
    return answers(spark, sf_dir, None)


@register("answer_computed", sql=q_condense.computed(ANSWER_SQL))
def q_answer_computed(spark, sf_dir):
    """The whole flow over one set of documents: vectors, graph, computed
    communities, their summaries, retrieval and answers."""
    return answers(spark, sf_dir, q_condense.computed_nodes(spark, sf_dir))


def answers(spark, sf_dir, nodes):
    space, bench, qv, rr, _ = contexts(spark, sf_dir, nodes)
    nodes = q_condense.doc_nodes(spark, sf_dir) if nodes is None else nodes
    members = nodes.select(F.col("community").alias("id"), F.col("id").alias("doc_id"))
    sents = stages.sentences(spark, sf_dir)
    return rt.answer(bench.select(F.col("item_id").alias("query")), qv, rr, members, sents, space, ANSWER_BUDGET)


_ANSWERS_CTE = ANSWER_SQL[:ANSWER_SQL.index("SELECT b.item_id AS query, coalesce(answer")] + f"""
, rpairs AS (SELECT b.item_id AS query, coalesce(answer, '{NO_SUMMARY}') AS pred, coalesce(b.text, '') AS ref
           FROM benchmark b LEFT JOIN ans ON ans.query = b.item_id)"""


@register("answer_scores", sql=rouge_sql(_ANSWERS_CTE, ["query"], 1) + """
SELECT query, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS fmeasure FROM rscore""")
def q_answer_scores(spark, sf_dir):
    """V6 + J8: every answer against its reference text, aligned by key with
    the counts checked on both sides."""
    from loomgraph.operators import simjoin
    got = materialize(q_answer(spark, sf_dir), "answers")
    refs = read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query"), F.coalesce("text", F.lit("")).alias("ref"))
    pairs_ = simjoin.align_by_key(got.withColumnRenamed("answer", "pred"), refs, "query")
    return rounded(rg.rouge_n(pairs_, ["query"], "pred", "ref", 1), ["query"])


# ------------------------------------------------------------ training data

PAIRS_SQL = """WITH c AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text,
                          lag(text) OVER w AS prev_text
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
tpairs AS (SELECT conv_id, turn, coalesce(text, '') AS query, coalesce(prev_text, '') AS context,
                  coalesce(next_text, '') AS answer FROM c WHERE role = 'user' AND next_role = 'assistant'),
gen AS (SELECT conv_id, turn, 'query: ' || query || ' context: ' || context AS input_text,
               answer AS target_text FROM tpairs)"""


def pairs(spark, sf_dir):
    return tp.turn_pairs(read_table(spark, sf_dir, "conversations"))


@register("train_rename", sql=PAIRS_SQL + "\nSELECT conv_id, turn, query AS input_text, answer AS target_text FROM tpairs")
def q_train_rename(spark, sf_dir):
    """(user turn, assistant reply) renamed to input_text / target_text."""
    return tp.rename_for_training(pairs(spark, sf_dir).select("conv_id", "turn", "query", "answer"),
                                  "query", "answer")


@register("train_pairs", sql=PAIRS_SQL + "\nSELECT conv_id, turn, input_text, target_text FROM gen")
def q_train_pairs(spark, sf_dir):
    """``query: q context: c`` inputs with the reply as target."""
    return tp.generator_inputs(pairs(spark, sf_dir))


@register("train_token_ids", sql=PAIRS_SQL + f""",
alltok AS (SELECT unnest(regexp_extract_all(lower(input_text), {S.q(tv.TERM)})) AS token FROM gen
           UNION ALL SELECT unnest(regexp_extract_all(lower(target_text), {S.q(tv.TERM)})) FROM gen),
vocab AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS token_id FROM alltok GROUP BY token),
ids AS (SELECT conv_id, turn, 'input' AS field,
               regexp_extract_all(lower(input_text), {S.q(tv.TERM)}) AS toks, {INPUT_LEN} AS l FROM gen
        UNION ALL
        SELECT conv_id, turn, 'labels', regexp_extract_all(lower(target_text), {S.q(tv.TERM)}), {LABEL_LEN} FROM gen),
ex AS (SELECT conv_id, turn, field, l, unnest(toks) AS token, generate_subscripts(toks, 1) AS p FROM ids),
seq AS (SELECT conv_id, turn, field, l, list(token_id ORDER BY p) AS s FROM ex JOIN vocab USING (token)
        GROUP BY conv_id, turn, field, l),
full_ AS (SELECT i.conv_id, i.turn, i.field, i.l, coalesce(s.s, []) AS s FROM ids i
          LEFT JOIN seq s ON s.conv_id = i.conv_id AND s.turn = i.turn AND s.field = i.field),
padded AS (SELECT conv_id, turn, field, list_resize(s, l, 0) AS s FROM full_)
SELECT conv_id, turn, field, CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS pos,
       CAST(unnest(s) AS BIGINT) AS token_id FROM padded""")
def q_train_token_ids(spark, sf_dir):
    """Input ids (512) and label ids (128), vocabulary by frequency, pad 0."""
    g = tp.generator_inputs(pairs(spark, sf_dir))
    vocab = tp.vocabulary(g, ["input_text", "target_text"], first_id=1)
    key = ["conv_id", "turn"]
    inp = tp.token_ids(g, key, "input_text", vocab, INPUT_LEN).withColumn("field", F.lit("input"))
    lab = tp.token_ids(g, key, "target_text", vocab, LABEL_LEN).withColumn("field", F.lit("labels"))
    return inp.unionByName(lab).select("conv_id", "turn", "field", "pos", "token_id")


@register("head_percent", sql=f"""
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents)
WHERE rn <= (SELECT round_even({HEAD_PERCENT} * count(*) / 100.0, 0) FROM documents)""")
def q_head_percent(spark, sf_dir):
    """S3: the first 5 % of the documents by key (a head, not a sample)."""
    return tp.head_percent(read_table(spark, sf_dir, "documents").select("doc_id"), "doc_id", HEAD_PERCENT)


# ------------------------------------------------------------------- hooks

@register("batch_generate_stub")
def q_batch_generate_stub(spark, sf_dir):
    """M6: a user batch generator over every good document (stand-in model)."""
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return hooks.generate(st.good_documents(d), "doc_id", "text", hooks.lead_sentence_model)


@register("encode_stub")
def q_encode_stub(spark, sf_dir):
    """A user batch encoder over every sentence (stand-in hashing encoder)."""
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    s = st.corpus_sentences(d).select(F.concat_ws(":", "doc_id", "pos").alias("sid"), "sentence")
    e = hooks.encode(s, "sid", "sentence", hooks.hashing_encoder(64))
    return e.select("sid", F.size("embedding").alias("dim"))
