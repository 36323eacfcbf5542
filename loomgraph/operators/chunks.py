"""Chunking, token budgets and duplicate removal.

Order is always explicit: a sentence is ``(doc_id, pos)`` and a chunk is
``(doc_id, chunk)``; texts are joined with ordered ``collect_list`` +
``array_sort`` (bounded per chunk).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.functions import text as tx
from loomgraph.operators.packs import pack_assign
from loomgraph.operators.sentences import keep_rows
from loomgraph.session import ensure_checkpoint_dir

TRIED = 1 << 21  # characters of pieces compared at once


def ordinal_in_group(df: DataFrame, group: str, order: str, bucket: int = 4096) -> DataFrame:
    """0-based rank of each row by ``order`` inside its ``group``, computed
    without putting a whole group in one task: rows are cut into buckets of
    ``order // bucket``, each bucket is ranked on its own, and bucket offsets
    come from a running sum over the (few) bucket counts of the group."""
    b = df.withColumn("_b", F.floor(F.col(order) / F.lit(bucket)))
    counts = b.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(wo), F.lit(0))).drop("_n")
    wr = Window.partitionBy(group, "_b").orderBy(order)
    return (b.join(offsets, [group, "_b"])
            .withColumn("ordinal", (F.col("_off") + F.row_number().over(wr) - 1).cast("long"))
            .drop("_b", "_off"))


def assign_chunks(sentences: DataFrame, chunk_size: int) -> DataFrame:
    """Sentences with their per-document ``chunk`` number."""
    s = ordinal_in_group(sentences, "doc_id", "pos")
    return s.withColumn("chunk", F.floor(F.col("ordinal") / F.lit(chunk_size)).cast("long"))


def chunks_per_document(sentences: DataFrame, chunk_size: int) -> DataFrame:
    """G3, per document: consecutive ``chunk_size`` sentences joined by a
    space; the last chunk may be short. ``(doc_id, chunk, n_sentences, text)``."""
    return chunk_texts(assign_chunks(sentences, chunk_size))


def chunk_texts(s: DataFrame) -> DataFrame:
    return (s.groupBy("doc_id", "chunk")
            .agg(F.count(F.lit(1)).alias("n_sentences"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sentence"))),
                                          lambda x: x["sentence"]), " ").alias("text")))


def global_ordinal(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """0-based position of every row in the total order ``order_cols``.

    Range-partitions by the order, counts rows per partition (one row per
    partition), turns the counts into offsets and adds the row number
    inside each partition: no step sees more than one partition's rows.
    The range-partitioned rows are checkpointed once: range bounds come from
    a sample, so two evaluations could cut the data differently."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(n, *order_cols).checkpoint()
              .withColumn("_p", F.spark_partition_id()))
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a size-bounded broadcast
    offsets = F.broadcast(counts.withColumn("_off", F.coalesce(F.sum("_n").over(wo), F.lit(0))).drop("_n"))
    wr = Window.partitionBy("_p").orderBy(*order_cols)
    return (ranged.join(offsets, "_p")
            .withColumn("ordinal", (F.col("_off") + F.row_number().over(wr) - 1).cast("long"))
            .drop("_p", "_off"))


def chunks_corpus(sentences: DataFrame, chunk_size: int) -> DataFrame:
    """G3, corpus-wide (the reference's flat list): chunks cross document
    borders. ``(chunk, n_sentences, text)`` ordered by ``(doc_id, pos)``."""
    s = global_ordinal(sentences, ["doc_id", "pos"])
    s = s.withColumn("chunk", F.floor(F.col("ordinal") / F.lit(chunk_size)).cast("long"))
    return (s.groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("n_sentences"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "sentence"))),
                                          lambda x: x["sentence"]), " ").alias("text")))


def token_pack(sentences: DataFrame, group: str, order: str, text: str, max_tokens: int) -> DataFrame:
    """G4 packs as texts: ``(group, chunk, n_sentences, n_tokens, text)``."""
    rows = pack_assign(sentences, group, order, text, max_tokens)
    return (rows.groupBy(group, "chunk")
            .agg(F.count(F.lit(1)).alias("n_sentences"), F.sum("ntok").alias("n_tokens"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))),
                                          lambda x: x[text]), " ").alias("text")))


def length_budget(n_tokens) -> tuple:
    """P10 output budget from an input length in tokens: the length is capped
    at 1024, ``t = max(30, int(0.8 * len))``, ``max = min(512, t)``,
    ``min = int(0.6 * t)`` (integer maths, exact for these factors)."""
    n = F.least(F.col(n_tokens) if isinstance(n_tokens, str) else n_tokens, F.lit(1024)).cast("long")
    t = F.greatest(F.lit(30).cast("long"), F.floor(n * 8 / 10).cast("long"))
    return F.least(F.lit(512).cast("long"), t).alias("max_len"), F.floor(t * 6 / 10).cast("long").alias("min_len")


def reduction_target(total_tokens) -> F.Column:
    """``max(60, int(0.7 * total))`` with double maths."""
    n = F.col(total_tokens) if isinstance(total_tokens, str) else total_tokens
    return F.greatest(F.lit(60).cast("long"), F.floor(n.cast("double") * F.lit(0.7)).cast("long"))


# ---------------------------------------------------------------- fuzzy dedup


def score_above(a, b, threshold: int) -> F.Column:
    """Whether G7's score of two texts, ``round(100 * ratio)`` with halves to
    even, exceeds ``threshold``; ``ratio`` is ``(n - D) / n`` for total length
    ``n`` and indel distance ``D = n - 2 * LCS``. Exact bounds come before the
    common subsequence (:func:`loomgraph.operators.neardup.alike`)."""
    @F.pandas_udf(T.BooleanType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        from loomgraph.operators.neardup import alike
        return pd.Series(alike(x.tolist(), y.tolist(), threshold))
    return run(a, b)


def taken_pieces(texts: list[list[str]], threshold: int) -> list[list[int]]:
    """Of each list of pieces, the positions of those that do not score above
    ``threshold`` against an earlier one taken. The ``k``-th pieces of all lists
    are tried together, some ``TRIED`` characters at once."""
    from loomgraph.operators.neardup import alike
    taken: list[list[int]] = [[] for _ in texts]
    open_ = [i for i, t in enumerate(texts) if len(t)]
    k = 0
    while open_:
        again, held, size = set(), [], 0
        for n, i in enumerate(open_):
            for j in taken[i]:
                held.append((i, j))
                size += len(texts[i][j]) + len(texts[i][k])
                if size > TRIED:
                    again |= _again(texts, held, k, threshold, alike)
                    held, size = [], 0
        again |= _again(texts, held, k, threshold, alike)
        for i in open_:
            if i not in again:
                taken[i].append(k)
        k += 1
        open_ = [i for i in open_ if len(texts[i]) > k]
    return taken


def _again(texts, held: list[tuple[int, int]], k: int, threshold: int, alike) -> set[int]:
    hit = alike([texts[i][j] for i, j in held], [texts[i][k] for i, _ in held], threshold) if held else []
    return {i for (i, _), above in zip(held, hit) if above}


def dedup_sentences(text, threshold: int = 90) -> F.Column:
    """G5 as a Column: the pieces after . ? ! in order, without blank ones and
    without those that score above ``threshold`` (lower-cased) against a piece
    already taken; joined by a space."""
    pieces = F.filter(tx.sentence_split(text), lambda p: tx.strip(p) != F.lit(""))
    # one array, so that the pieces are made once: first as they are, then lower-cased
    both = F.transform(F.array(pieces), lambda p: F.concat(p, F.transform(p, F.lower)))[0]

    @F.pandas_udf(T.StringType())
    def run(both: pd.Series) -> pd.Series:
        taken = taken_pieces([() if x is None else x[len(x) // 2:] for x in both], threshold)
        return pd.Series([None if x is None else " ".join([x[k] for k in t]) for x, t in zip(both, taken)], dtype=object)
    return run(both)


def clean_summaries(df: DataFrame, text: str = "summary") -> DataFrame:
    """T4: P4 -> G5 -> F2; rows that fail F2 are dropped."""
    fixed = df.withColumn(text, tx.summary_fix(F.coalesce(F.col(text), F.lit(""))))
    deduped = fixed.withColumn(text, dedup_sentences(F.col(text)))
    return keep_rows(deduped, lambda r: tx.good_summary(r[text], stripped=False))


def exact_duplicate_clusters(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """G6 exact variant: texts equal after P2 cleaning and lower-casing form a
    cluster represented by its smallest id. ``(id, rep, cluster_size)``; one
    aggregation on a hash of the normalised text, so a group of copies, however
    large, is a single partial-aggregated key, never a list of pairs."""
    norm = F.lower(tx.clean_text(F.coalesce(F.col(text_col), F.lit(""))))
    keyed = df.select(F.col(id_col).alias("id"), F.sha2(norm, 256).alias("h"))
    reps = keyed.groupBy("h").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("cluster_size"))
    return keyed.join(reps, "h").select("id", "rep", "cluster_size")
