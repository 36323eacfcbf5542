"""ROUGE evaluation as Spark jobs.

Tokens follow the common ROUGE tokenizer: lower-case, runs of ``a-z0-9``
(no stemming). ROUGE-N of a pair is a multiset intersection counted in its
row; against a whole group of texts it is a join of counts per (group,
gram). ROUGE-L needs longest common subsequences, found for whole Arrow batches
of pairs at once (see ``lcs``).
"""

from __future__ import annotations

import re
from collections import Counter
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.operators import lcs
from loomgraph.operators.chunks import ordinal_in_group

# Fixed value: ROUGE token pattern on lower-cased text.
TOKEN = "[a-z0-9]+"


def tokens(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(t, F.lit(""))), F.lit(TOKEN), 0)


def ngrams(toks: Column, n: int) -> Column:
    if n == 1:
        return toks
    idx = F.sequence(F.lit(0), F.size(toks) - n)
    grams = F.transform(idx, lambda i: F.array_join(F.slice(toks, i + 1, n), " "))
    return F.when(F.size(toks) >= n, grams).otherwise(F.array().cast("array<string>"))


def f_measure(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def scores(hit: Column, n_pred: Column, n_ref: Column) -> list[Column]:
    p = F.when(n_pred > 0, hit / n_pred).otherwise(F.lit(0.0))
    r = F.when(n_ref > 0, hit / n_ref).otherwise(F.lit(0.0))
    return [p.alias("precision"), r.alias("recall"), f_measure(p, r).alias("fmeasure")]


def rouge_n(pairs: DataFrame, key: list[str], pred: str, ref: str, n: int) -> DataFrame:
    """Per pair ``(*key, precision, recall, fmeasure)`` for ROUGE-``n``: both texts
    sit in the row, so the clipped overlap is counted there, in time linear in
    their lengths."""
    return _scored(pairs, key, pred, ref, _udf(partial(rouge_n_rows, n=n)))


def border_bigrams(members: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """``(key, gram)``: the last token of each text with the first token of the
    next one of its ``key`` by ``order`` (unique in the key), texts without
    tokens passed over. Neighbours meet by a join on their ordinals, so no
    window holds a whole key."""
    rows = members.select(key, order, F.array(tokens(text)).alias("_t")).where(F.size(F.col("_t")[0]) > 0)
    ends = ordinal_in_group(rows.select(key, order, F.element_at(F.col("_t")[0], 1).alias("_first"),
                                        F.element_at(F.col("_t")[0], -1).alias("_last")), key, order)
    after = ends.select(key, (F.col("ordinal") - 1).alias("ordinal"), F.col("_first").alias("_next"))
    return (ends.select(key, "ordinal", "_last").join(after, [key, "ordinal"])
            .select(key, F.concat_ws(" ", "_last", "_next").alias("gram")))


def rouge_n_by_group(preds: DataFrame, members: DataFrame, key: str, pred: str, text: str, n: int = 1,
                     order: str | None = None) -> DataFrame:
    """V4: ROUGE-1 or ROUGE-2 of one prediction per ``key`` against all texts
    of that key joined by ``order`` (which ROUGE-1 does not need), from counts
    per (key, gram): the group's text is never put together, so its size does
    not matter. ``(key, precision, recall, fmeasure)`` for every key of
    ``members``; a missing prediction counts as empty (J7)."""
    if n not in (1, 2) or (n == 2 and order is None):
        raise ValueError("n is 1, or 2 with an order")

    def grams(df, col):
        bound = df.select(key, F.array(tokens(col)).alias("_t"))
        return bound.select(key, F.explode(F.transform("_t", lambda x: ngrams(x, n))[0]).alias("gram"))

    def counts(df, name):
        return df.groupBy(key, "gram").agg(F.count(F.lit(1)).alias(name))
    of_texts = grams(members, text)
    if n == 2:
        of_texts = of_texts.unionByName(border_bigrams(members, key, order, text))
    both = counts(of_texts, "cr").join(counts(grams(preds, pred), "cp"), [key, "gram"], "full").select(
        key, F.coalesce("cr", F.lit(0)).alias("cr"), F.coalesce("cp", F.lit(0)).alias("cp"))
    sums = both.groupBy(key).agg(F.sum("cr").alias("nr"), F.sum("cp").alias("np"), F.sum(F.least("cr", "cp")).alias("hit"))
    out = members.select(key).distinct().join(sums, key, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(key, *scores(zero("hit"), zero("np"), zero("nr")))


# ------------------------------------------------------------ scores of a row


_FIND = re.compile(TOKEN).findall


def _tok(text: str) -> list[str]:
    return _FIND((text or "").lower())


def _prf(hit: int, n_pred: int, n_ref: int) -> tuple[float, float, float]:
    p = hit / n_pred if n_pred else 0.0
    r = hit / n_ref if n_ref else 0.0
    return p, r, (2 * p * r / (p + r) if p + r > 0 else 0.0)


def rouge_n_rows(pred: list[str], ref: list[str], n: int) -> list[tuple[float, float, float]]:
    """V1 of each pair: the overlap counts a gram as often as both texts hold it."""
    out = []
    for x, y in zip(pred, ref):
        a, b = ([*zip(*(t[i:] for i in range(n)))] if n > 1 else t for t in (_tok(x), _tok(y)))
        left, hit = Counter(b), 0
        for gram, c in Counter(a).items():
            hit += min(c, left.get(gram, 0))
        out.append(_prf(hit, len(a), len(b)))
    return out


def rouge_l_rows(pred: list[str], ref: list[str]) -> list[tuple[float, float, float]]:
    """V2 of each pair: one longest-common-subsequence step for a whole batch."""
    a, b = [_tok(x) for x in pred], [_tok(x) for x in ref]
    pairs = [lcs.numbered(x, y) for x, y in zip(a, b)]
    hit = lcs.lcs_lengths([x for x, _ in pairs], [y for _, y in pairs])
    return [_prf(int(h), len(x), len(y)) for h, x, y in zip(hit, a, b)]


def rouge_lsum_pair(pred: str, ref: str) -> tuple[float, float, float]:
    """Summary-level LCS (V3): texts split on newlines, per reference line
    the union of LCS hits with every prediction line, clipped by counts."""
    ps = [_tok(x) for x in (pred or "").split("\n")]
    rs = [_tok(x) for x in (ref or "").split("\n")]
    n_pred, n_ref = sum(map(len, ps)), sum(map(len, rs))
    pc = Counter(t for s in ps for t in s)
    rc = Counter(t for s in rs for t in s)
    lines = lcs.numbered(*rs, *ps)
    hit = 0
    for r, words in zip(lines, rs):
        found = [lcs.lcs_positions(r, p) for p in lines[len(rs):]]
        for i in np.unique(np.concatenate(found)).tolist() if found else []:
            t = words[i]
            if pc[t] > 0 and rc[t] > 0:
                hit += 1
                pc[t] -= 1
                rc[t] -= 1
    return _prf(hit, n_pred, n_ref)


def rouge_lsum_rows(pred: list[str], ref: list[str]) -> list[tuple[float, float, float]]:
    """V3 of each pair. Pairs of single lines are V2: every hit pairs one token
    with one token, so the counts never clip."""
    one = [i for i, (p, r) in enumerate(zip(pred, ref)) if "\n" not in p and "\n" not in r]
    flat = dict(zip(one, rouge_l_rows([pred[i] for i in one], [ref[i] for i in one])))
    return [flat[i] if i in flat else rouge_lsum_pair(pred[i], ref[i]) for i in range(len(pred))]


_PRF = T.StructType([T.StructField("precision", T.DoubleType()), T.StructField("recall", T.DoubleType()),
                     T.StructField("fmeasure", T.DoubleType())])


def _udf(fn):
    @F.pandas_udf(_PRF)
    def run(pred: pd.Series, ref: pd.Series) -> pd.DataFrame:
        rows = fn(pred.fillna("").tolist(), ref.fillna("").tolist())
        return pd.DataFrame(rows, columns=["precision", "recall", "fmeasure"])
    return run


def _scored(pairs: DataFrame, key: list[str], pred: str, ref: str, fn) -> DataFrame:
    return pairs.select(*key, fn(F.col(pred), F.col(ref)).alias("s")).select(*key, "s.*")


rouge_l_udf = _udf(rouge_l_rows)
rouge_lsum_udf = _udf(rouge_lsum_rows)


def rouge_l(pairs: DataFrame, key: list[str], pred: str, ref: str, summary_level: bool = False) -> DataFrame:
    return _scored(pairs, key, pred, ref, rouge_lsum_udf if summary_level else rouge_l_udf)


def corpus_mean(scores: DataFrame, col: str = "fmeasure") -> Column:
    """Mean of per-pair scores."""
    return F.avg(col)


def align_predictions(pred: DataFrame, ref: DataFrame, key: list[str]) -> DataFrame:
    """Every reference gets its prediction by key, ``''`` when missing."""
    return ref.join(pred, key, "left").withColumn("prediction", F.coalesce("prediction", F.lit("")))
