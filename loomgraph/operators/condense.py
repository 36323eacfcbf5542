"""Condensing text within length budgets.

The reference condenses with a seq2seq model called row by row. Here the
data contract is kept (which text, what budget, what order) with an
extractive reducer that runs as Spark aggregations and windows: sentences
are scored, ranked inside their group, kept while the running word count
fits the budget, and re-joined in their original order. A model can be
plugged in instead through :mod:`loomgraph.operators.hooks`.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.functions import text as tx
from loomgraph.operators import termblocks as tb
from loomgraph.operators import tfidf as tv
from loomgraph.operators.chunks import length_budget, ordinal_in_group, pack_assign

# Fixed value: text used when a group yields nothing to condense.
NO_SUMMARY = "[No summary generated]"


def sentence_scores(sentences: DataFrame, key: list[str], text: str = "sentence") -> DataFrame:
    """Mean TF-IDF weight of a sentence's term occurrences, with
    ``idf = ln((N + 1) / (df + 1))`` over the sentences themselves.
    Adds ``score`` (rounded to 9 places so ties are engine-independent). Rows of
    one key count as one text and share a score; a key with a null scores 0.
    Texts are shuffled once, in blocks (:mod:`loomgraph.operators.termblocks`)."""
    size = sentences.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(text)).alias("chars")).first()
    rows = tb.placed(sentences, key, tv.spaced_terms(text), size.chars or 0)
    found = tb.block_counts(rows, key)
    df_t = found.groupBy("term").agg(F.sum("n").alias("df"))
    idf = df_t.select("term", F.log((F.lit(size.n) + 1.0) / (F.col("df") + 1.0)).alias("idf"))
    names = sentences.columns

    def score(t: pa.Table, weights: pa.Table) -> pa.Table:
        at, code, words, of_row = tb.occurrences(t, key)
        place = pc.index_in(words, value_set=weights.column("term").combine_chunks()).to_numpy(zero_copy_only=False)
        w = weights.column("idf").to_numpy()[place][code] if len(words) else np.zeros(0)
        rows_of = np.bincount(at, minlength=t.num_rows)
        mean = (np.bincount(at, weights=w, minlength=t.num_rows) / np.maximum(rows_of, 1))[of_row]
        none = rows_of[of_row] == 0
        for k in key:  # a key with a null has no score
            none = none | t.column(k).is_null().to_numpy()
        return pa.table([*map(t.column, names), pa.array(mean, pa.float64(), mask=none)], [*names, "score"])

    by_block = found.join(idf, "term").select("_block", "term", "idf")
    out = T.StructType([*sentences.schema.fields, T.StructField("score", T.DoubleType())])
    scored = rows.groupBy("_block").cogroup(by_block.groupBy("_block")).applyInArrow(score, out)
    return scored.withColumn("score", F.coalesce(F.round("score", 9), F.lit(0.0)))


def budget_select(rows: DataFrame, group: list[str], rank_cols: list, budget, order: str,
                  text: str, max_budget: int) -> DataFrame:
    """Take rows by rank until ``budget`` words are used: a row that crosses
    the limit is cut to the words left, as truncation of the joined text would
    do, and later rows are dropped. The taken texts are joined in ``order``:
    ``(*group, summary, n_kept)`` (W3). No summary exceeds its budget.

    Rows without words are skipped (they add nothing). Every other row has
    at least one word, so no more than ``max_budget`` rows can be taken
    (``max_budget`` bounds ``budget``): ranks beyond that are cut first with
    a ``row_number`` filter, which Spark runs as a partial top-k on each map
    task before the shuffle, so even a huge group reaches one task as a few
    hundred rows."""
    w = Window.partitionBy(*group).orderBy(*rank_cols)
    r = (rows.withColumn("nw", tx.word_count(text)).where(F.col("nw") > 0)
         .withColumn("rk", F.row_number().over(w))
         .where(F.col("rk") <= F.lit(max_budget)))
    kept = within_budget(r, w, budget, text)
    return kept.groupBy(*group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]),
                     " ").alias("summary"),
        F.count(F.lit(1)).alias("n_kept"))


def within_budget(rows: DataFrame, w, budget, text: str) -> DataFrame:
    """Rows that begin within ``budget`` words of their window ``w``, the last
    one cut to the words left. ``rows`` carries the word count ``nw``."""
    r = rows.withColumn("run", F.sum("nw").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.col("run") - F.col("nw")
    left = (F.lit(0) + budget - before).cast("int")
    cut = F.array_join(F.slice(tx.whitespace_tokens(text), F.lit(1), F.greatest(left, F.lit(0))), " ")
    return (r.where(before < budget)
            .withColumn(text, F.when(F.col("run") <= budget, F.col(text)).otherwise(cut)))


def extractive_chunks(sentences: DataFrame, chunks: DataFrame, min_words: int = 10) -> DataFrame:
    """M1 over chunks. ``sentences(doc_id, pos, sentence, chunk)``,
    ``chunks(doc_id, chunk, text)``. Each chunk keeps its best sentences
    within the P10 ``max_len`` budget of the chunk's length; a chunk of fewer
    than ``min_words`` words gets ``''`` (F4, row kept)."""
    scored = sentence_scores(sentences, ["doc_id", "pos"])
    budgets = chunks.select("doc_id", "chunk", tx.word_count("text").alias("n_tokens"))
    max_len, _ = length_budget("n_tokens")
    budgets = budgets.select("doc_id", "chunk", "n_tokens", max_len)
    rows = scored.join(budgets, ["doc_id", "chunk"])
    picked = budget_select(rows, ["doc_id", "chunk"], [F.col("score").desc(), F.col("pos").asc()],
                           F.col("max_len"), "pos", "sentence", max_budget=512)
    out = budgets.join(picked, ["doc_id", "chunk"], "left")
    return out.select("doc_id", "chunk", "n_tokens",
                      F.when(F.col("n_tokens") < F.lit(min_words), F.lit(""))
                      .otherwise(F.coalesce("summary", F.lit(""))).alias("summary"))


def community_texts(nodes: DataFrame, node: str = "id", community: str = "community",
                    text: str = "text", part_members: int = 1000) -> DataFrame:
    """A3 / V4 reference: the non-blank member texts of a community joined by
    a space in member id order, in parts of ``part_members`` members:
    ``(community, part, text, n_members)``. A community of any size is rows of
    bounded length; one of up to ``part_members`` members is one row."""
    nb = ordinal_in_group(nodes.where(tx.non_blank(text)).select(community, node, text), community, node)
    return (nb.withColumn("part", F.floor(F.col("ordinal") / F.lit(part_members)).cast("long"))
            .groupBy(community, "part").agg(
                F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(node, text))), lambda x: x[text]),
                             " ").alias("text"),
                F.count(F.lit(1)).alias("n_members")))


def community_summaries(central: DataFrame, labels: DataFrame, node: str = "id",
                        community: str = "community", text: str = "text",
                        budget: int = 256) -> DataFrame:
    """M3: members ranked by centrality (top fraction already applied,
    ``central(id, community, rank, text)``), non-blank texts kept in rank
    order while the running word count fits ``budget`` and joined in rank
    order; a community with no kept member gets the fallback text (P8)."""
    nb = central.where(tx.non_blank(text))
    picked = budget_select(nb, [community], [F.col("rank").asc()], F.lit(budget), "rank", text,
                           max_budget=budget)
    comms = labels.select(community).distinct()
    return (comms.join(picked, community, "left")
            .select(community,
                    F.when(F.coalesce(F.trim(F.col("summary")), F.lit("")) == F.lit(""), F.lit(NO_SUMMARY))
                    .otherwise(F.col("summary")).alias("summary")))


def scored_packs(sentences: DataFrame, group: str, order: str, text: str, pack_tokens: int) -> DataFrame:
    """:func:`pack_assign` with the ``score`` of every sentence, which travels with
    it. Rows without a group or place are dropped; each of several rows of one
    place meets the score of each."""
    packed = pack_assign(sentences, group, order, text, pack_tokens, ("score",))
    if packed.groupBy(group, order).count().where("count > 1").limit(1).count():
        return packed.drop("score").join(packed.select(group, order, "score"), [group, order])
    return packed.where(F.col(group).isNotNull() & F.col(order).isNotNull())


def joined_in_parts(rows: DataFrame, group: str, order: str, text: str, part_rows: int = 1024) -> DataFrame:
    """The texts of a group joined by a space in the whole-number ``order``:
    ``(group, text, n)``. Parts of the order are joined first, so that a group
    arrives as few long texts; the partitions of groups are not put together by
    their size, as a task holds the texts of all its groups."""
    def join_by(place):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place, text))), lambda x: x[text]), " ").alias(text)
    parts = (rows.groupBy(group, F.floor(F.col(order) / F.lit(part_rows)).cast("long").alias("_part"))
             .agg(join_by(order), F.count(F.lit(1)).alias("n")))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n, group).groupBy(group).agg(join_by("_part"), F.sum("n").alias("n"))


def flat_reduce(sentences: DataFrame, group: str, order: str, text: str = "sentence",
                pack_tokens: int = 500, out_tokens: int = 256) -> DataFrame:
    """M5: the group's sentences packed greedily at ``pack_tokens`` (G4),
    each pack condensed to ``out_tokens`` words (M1 scoring and budget), the
    pack summaries joined in pack order: ``(group, summary, n_packs)``.
    ``sentences`` carries ``score`` (see :func:`sentence_scores`)."""
    packed = scored_packs(sentences, group, order, text, pack_tokens)
    per_pack = budget_select(packed, [group, "chunk"], [F.col("score").desc(), F.col(order).asc()],
                             F.lit(out_tokens), order, text, max_budget=out_tokens)
    return joined_in_parts(per_pack, group, "chunk", "summary").withColumnRenamed("n", "n_packs")


def tree_reduce(sentences: DataFrame, group: str, order: str, text: str = "sentence",
                pack_tokens: int = 450) -> DataFrame:
    """M4: repeated pack (G4 at ``pack_tokens``) -> condense each pack to the
    P11 target of the group (``max(60, int(0.7 * total))``, total taken once
    at the start, as in the reference) until every group is one text or no
    group shrinks any more (D10); the row count falls with every other round,
    so the loop ends by itself. Each round is written as a table (lineage cut). ``sentences`` carries ``score``.
    Returns ``(group, summary, rounds)``."""
    from loomgraph.operators.chunks import reduction_target
    from loomgraph.session import materialize
    cur = materialize(sentences.select(group, F.col(order).alias("o"), F.col(text).alias("t"), "score")
                      .withColumn("round", F.lit(0)), "tree", codec="zstd")
    totals = (cur.groupBy(group).agg(F.sum(tx.word_count("t")).alias("total"))
              .select(group, reduction_target("total").alias("target")))
    totals = materialize(totals, "targets")  # small where groups are few: its size lets Spark send it to every task
    n_rows = cur.count()
    for rnd in itertools.count(1):
        packs = scored_packs(cur, group, "o", "t", pack_tokens).join(totals, group)
        # a pack holds at most pack_tokens words, so that bounds its budget
        condensed = budget_select(packs, [group, "chunk"], [F.col("score").desc(), F.col("o").asc()],
                                  F.col("target"), "o", "t", max_budget=pack_tokens)
        scores = packs.groupBy(group, "chunk").agg(F.avg("score").alias("score"))
        nxt = materialize(condensed.join(scores, [group, "chunk"])
                          .select(group, F.col("chunk").alias("o"), F.col("summary").alias("t"), "score",
                                  F.lit(rnd).alias("round")), "tree", codec="zstd")
        n_next = nxt.count()
        cur = nxt
        if n_next == n_rows or nxt.groupBy(group).count().where(F.col("count") > 1).limit(1).count() == 0:
            break
        n_rows = n_next
    return joined_in_parts(cur, group, "o", "t").select(group, F.col("t").alias("summary"), F.lit(rnd).alias("rounds"))
