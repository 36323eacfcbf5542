"""Toxic spans by a linear-chain conditional random field.

Labels come per document, so tokens are labelled first: a word, or one of its
prefixes, that stands in toxic documents far more often than chance allows (a
likelihood ratio test over distinct contexts, so copies count once, corrected
for the number of features tried) marks its tokens in toxic documents; every
other token is clean. A two-state CRF over the words of a whole document is
then trained on those labels, with hashed features of the word, its prefixes
and its suffix. At scoring time forward-backward marginals give each word its probability of being
toxic; words at 0.5 or more are the offending spans, and a logistic function
of the largest, the second largest and the summed marginals is the document's score.

A document of any length is one chain. Its words are cut into blocks of
``BLOCK``; the blocks of a batch advance together, one word a step, as vector
operations. A block maps the odds that reach it to the odds that leave it by
a product of 2 x 2 matrices, so the odds at every block border are found first
and the recursions inside the blocks start from them. Training works on a bounded sample of
labelled rows on the driver; scoring is one pass without any shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 128          # words of a chain that one step sequence covers; results do not depend on it
CELLS = 1 << 21      # hashed feature weights: far more than features, so few share one
PREFIXES = (3, 4, 5, 6)
WORDS_CACHED = 400_000
EDGES = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def word(token: str) -> str:
    """A token as the features see it: lower case, without marks at its ends."""
    return token.strip(EDGES).lower()


def cells(w: str) -> list[int]:
    """Weight cells of the word's suffix, of the word itself and of its
    prefixes (cell 0 is unused padding)."""
    own = [f"s{w[-3:]}", f"w{w}", *(f"p{w[:n]}" for n in PREFIXES if len(w) >= n)]
    ids = [1 + zlib.crc32(f.encode()) % (CELLS - 1) for f in own]
    return ids + [0] * (len(PREFIXES) + 2 - len(ids))


def sample(docs: DataFrame, labels: DataFrame, learn: Column, toxic_docs: int = 1200,
           clean_docs: int = 3600, max_chars: int = 8_000) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """Texts and labels to learn from, and the number of labelled rows per class.

    Bounded: of the rows of ``labels`` where ``learn`` holds, the
    ``toxic_docs`` and ``clean_docs`` of smallest id hash; of those, texts of
    up to ``max_chars`` characters. Ids labelled twice count as toxic if any
    label is 1; of an id held by many rows at most the rows that fit into the
    bound. The ids joined by broadcast and the rows taken are at most
    ``toxic_docs + clean_docs``, each class by a top-k over all labels; no
    table is shuffled but the labels.
    """
    known = (labels.where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")))
    sizes = {int(r.y): int(r.n) for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
             for y, n in ((1, toxic_docs), (0, clean_docs))]
    ids = drawn[0].unionByName(drawn[1]).select(F.col("doc_id").alias("_id"), "y")
    rows = (docs.where(F.length("text").between(1, max_chars)).select(F.col("doc_id").alias("_id"), "text")
            .join(F.broadcast(ids), "_id").select("_id", "text", "y")
            .orderBy(F.crc32(F.col("_id").cast("string")), "_id", "text").limit(toxic_docs + clean_docs).collect())
    return [(r.text, r.y) for r in rows], sizes


def contexts(ids: list[np.ndarray], words: int) -> np.ndarray:
    """How often each word stands between two words it was not seen between
    before: copies and near copies of a document add nothing."""
    if not sum(map(len, ids)):
        return np.zeros(words, np.int64)
    cur = np.concatenate(ids) + 1
    before = np.concatenate([np.append(0, x[:-1] + 1)[:len(x)] for x in ids])
    after = np.concatenate([np.append(x[1:] + 1, 0)[-len(x):] if len(x) else x for x in ids])
    v = words + 1
    seen = np.unique((before * v + cur) * v + after)
    return np.bincount(seen // v % v - 1, minlength=words)


def toxic_words(of: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Words with a cell (the word's own or a prefix's) whose contexts lie in
    toxic documents beyond chance, and nearly always; ``of`` has the cells and
    ``toxic`` and ``clean`` count the contexts of each word."""
    named = of[:, 1:]
    a, b = (np.bincount(named.ravel(), weights=np.repeat(n, named.shape[1]), minlength=CELLS) for n in (toxic, clean))
    a[0] = b[0] = 0
    share = np.clip(toxic.sum() / max(1, toxic.sum() + clean.sum()), 1e-6, 1 - 1e-6)
    bar = np.log(np.count_nonzero(a) + 1) + np.log(100)
    some = np.flatnonzero((a > 0) & (a >= 0.9 * (a + b)))
    x, y = a[some], b[some]
    g = x * np.log(x / ((x + y) * share)) + y * np.log(np.maximum(y, 1e-9) / ((x + y) * (1 - share)))
    bad = np.zeros(CELLS, bool)
    bad[some[g >= bar]] = True
    return bad[named].any(axis=1)


def recursions(e: np.ndarray, size: np.ndarray, trans: np.ndarray, prior: np.ndarray | float = 1.0,
               tail: np.ndarray | float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of state 1 against state 0, ``[step, block]``,
    for emission scores ``e`` of that shape and blocks of ``size`` steps.
    ``prior`` are the odds of a block's first step before its emission, ``tail``
    the backward odds of its last step."""
    a = np.exp(trans)
    x = np.exp(np.clip(e, -25, 25))
    fwd, bwd = np.empty_like(x), np.ones_like(x)
    before = prior
    for t in range(len(x)):
        fwd[t] = r = x[t] * before
        before = (a[0, 1] + a[1, 1] * r) / (a[0, 0] + a[1, 0] * r)
    after = np.zeros(x.shape[1:]) + tail
    for t in range(len(x) - 1, -1, -1):
        bwd[t] = after
        g = x[t] * after
        after = np.where(t < size, (a[1, 0] + a[1, 1] * g) / (a[0, 0] + a[0, 1] * g), after)
    return fwd, bwd


def borders(e: np.ndarray, size: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``prior`` and ``tail`` of each block (see :func:`recursions`), blocks in
    document order; ``first`` marks the first block of each document.

    With ``A`` the transitions and ``D`` a step's emissions, a block's product
    ``S = D A ... A D`` takes prior odds to ``A S`` and, transposed, backward
    odds to ``A^T S^T``. Blocks of equal place in their documents go together.
    """
    prior, tail = np.ones(len(size)), np.ones(len(size))
    place = np.arange(len(size)) - np.maximum.accumulate(np.where(first, np.arange(len(size)), 0))
    last = np.append(first[1:], True)
    some = np.flatnonzero(~(first & last))  # blocks of documents of two or more
    if not len(some):
        return prior, tail
    a = np.exp(trans)
    x, n = np.exp(np.clip(e[:, some].astype(np.float64), -25, 25)), size[some]
    s11, s10, s01, s00 = x[0].copy(), np.zeros(len(some)), np.zeros(len(some)), np.ones(len(some))
    for t in range(1, len(x)):
        live = t < n
        up1, up0 = x[t] * (a[1, 1] * s11 + a[0, 1] * s01), x[t] * (a[1, 1] * s10 + a[0, 1] * s00)
        lo1, lo0 = a[1, 0] * s11 + a[0, 0] * s01, a[1, 0] * s10 + a[0, 0] * s00
        scale = np.where(live, up1 + up0 + lo1 + lo0, 1.0)
        s11, s10 = np.where(live, up1, s11) / scale, np.where(live, up0, s10) / scale
        s01, s00 = np.where(live, lo1, s01) / scale, np.where(live, lo0, s00) / scale
    at = place[some]
    order = np.argsort(at, kind="stable")
    cuts = np.split(order, np.searchsorted(at[order], np.arange(1, at.max() + 1)))
    for here in cuts[:-1]:
        here = here[~last[some[here]]]
        u = prior[some[here]]
        one, zero = s11[here] * u + s10[here], s01[here] * u + s00[here]
        prior[some[here] + 1] = (a[1, 1] * one + a[0, 1] * zero) / (a[1, 0] * one + a[0, 0] * zero)
    for here in cuts[:0:-1]:
        b = tail[some[here]]
        one, zero = s11[here] * b + s01[here], s10[here] * b + s00[here]
        tail[some[here] - 1] = (a[1, 1] * one + a[1, 0] * zero) / (a[0, 1] * one + a[0, 0] * zero)
    return prior, tail


class Chains:
    """Where the words of documents of ``sizes`` words, laid end to end, stand
    in blocks."""

    def __init__(self, sizes: list[int]):
        n = np.asarray(sizes, dtype=np.int64)
        per = (n + BLOCK - 1) // BLOCK
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.block = np.repeat(np.cumsum(per) - per, n) + at // BLOCK
        self.step = at % BLOCK
        self.size = np.bincount(self.block, minlength=int(per.sum()))
        self.first = np.zeros(len(self.size), bool)
        self.first[(np.cumsum(per) - per)[n > 0]] = True
        self.starts = at == 0  # first words

    def odds(self, e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward odds of each word for emission scores ``e``."""
        grid = np.zeros((int(self.size.max()), len(self.size)))
        grid[self.step, self.block] = e
        fwd, bwd = recursions(grid, self.size, trans, *borders(grid, self.size, self.first, trans))
        return fwd[self.step, self.block], bwd[self.step, self.block]


class Tagger:
    """Trained weights; scores texts."""

    def __init__(self, weights: np.ndarray, bias: float, trans: np.ndarray, document: np.ndarray):
        self.weights, self.bias, self.trans, self.document = weights, bias, trans, document
        self.cache: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def emission(self, token: str) -> float:
        got = self.cache.get(token)
        if got is None:
            if len(self.cache) >= WORDS_CACHED:
                self.cache.clear()
            got = self.cache[token] = float(self.weights[cells(word(token))].sum() + self.bias)
        return got

    def marginals(self, texts: list[str]) -> list[np.ndarray]:
        """Per text, the probability of each of its words to be toxic."""
        flat = [np.array([self.emission(t) for t in text.split()]) for text in texts]
        sizes = [len(x) for x in flat]
        if not sum(sizes):
            return flat
        fwd, bwd = Chains(sizes).odds(np.concatenate(flat), self.trans)
        odds = fwd * bwd
        return np.split(odds / (1 + odds), np.cumsum(sizes)[:-1])

    def scores(self, texts: list[str | None], at_once: int = 400_000) -> Iterator[tuple[float, list[tuple[int, int, float]]]]:
        """Score and spans ``(begin, end, probability)`` of each whole text."""
        some, total = [], 0
        for text in texts:
            some.append(text or "")
            total += len(some[-1]) // 4
            if total >= at_once:
                yield from self._scored(some)
                some, total = [], 0
        yield from self._scored(some)

    def _scored(self, texts: list[str]):
        for text, p in zip(texts, self.marginals(texts)):
            yield float(logistic(summary(p) @ self.document[1:] + self.document[0])), spans(text, p)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def summary(p: np.ndarray) -> np.ndarray:
    """What the document score sees of the marginals."""
    top = np.sort(np.partition(p, -2)[-2:])[::-1] if len(p) > 1 else np.append(p, 0)
    top = np.append(top, [0, 0])[:2]
    return np.array([top[0], top[1], np.log1p(p[p > 0.01].sum())])


def spans(text: str, p: np.ndarray) -> list[tuple[int, int, float]]:
    """Character spans of runs of words with a probability of 0.5 or more."""
    hit = p >= 0.5
    if not hit.any():
        return []
    out: list[tuple[int, int, float]] = []
    for k, m in enumerate(re.finditer(r"\S+", text)):
        if hit[k]:
            if k and hit[k - 1] and out:
                out[-1] = (out[-1][0], m.end(), max(out[-1][2], float(p[k])))
            else:
                out.append((m.start(), m.end(), float(p[k])))
    return out


def train(rows: list[tuple[str, int]], sizes: dict[int, int], rounds: int = 40) -> Tagger:
    """Fit the tagger. Without toxic rows every score is near 0.

    The document score is fitted with class weights that undo the sampling,
    so scores follow the shares of the labels.
    """
    vocab: dict[str, int] = {}
    ids = [np.array([vocab.setdefault(word(t), len(vocab)) for t in text.split()], dtype=np.int64)
           for text, _ in rows]
    ys = [y for _, y in rows]
    of = np.array([cells(w) for w in vocab], dtype=np.int64).reshape(len(vocab), len(PREFIXES) + 2)
    counts = (contexts([x for x, y in zip(ids, ys) if y == label], len(vocab)) for label in (1, 0))
    marked = toxic_words(of, *counts)
    weights, bias, trans = np.zeros(CELLS, np.float32), -3.0, np.zeros((2, 2))
    if marked.any():
        used, of = np.unique(of, return_inverse=True)
        of = of.reshape(len(vocab), -1)
        chains = Chains([len(x) for x in ids])
        flat = np.concatenate(ids)
        y = marked[flat] & np.repeat(np.array(ys) == 1, [len(x) for x in ids])
        live = ~chains.starts[1:]  # pairs of neighbouring words of one document
        moves = np.bincount((2 * y[:-1] + y[1:])[live], minlength=4).reshape(2, 2)
        own, other = np.zeros(len(used)), np.array([bias, 0, 0, 0, 0])
        moment = [[np.zeros(len(used)), np.zeros(len(used))], [np.zeros(5), np.zeros(5)]]
        for k in range(1, rounds + 1):
            trans = other[1:].reshape(2, 2)
            e = (own[of].sum(axis=1) + other[0])[flat]
            fwd, bwd = chains.odds(e, trans)
            odds = fwd * bwd
            diff = y - odds / (1 + odds)
            a = np.exp(trans)
            before, after = fwd[:-1][live], (np.exp(np.clip(e[1:], -25, 25)) * bwd[1:])[live]
            scale = 1 / (a[0, 0] + a[0, 1] * after + before * (a[1, 0] + a[1, 1] * after))
            expected = np.array([[a[0, 0] * scale.sum(), a[0, 1] * (scale * after).sum()],
                                 [a[1, 0] * (scale * before).sum(), a[1, 1] * (scale * before * after).sum()]])
            del fwd, bwd, odds, before, after, scale
            per_word = np.bincount(flat, weights=diff, minlength=len(vocab))
            grad = np.bincount(of.ravel(), weights=np.repeat(per_word, of.shape[1]), minlength=len(used)) - 0.05 * own
            grad[used == 0] = 0
            for value, g, (mean, square) in (
                    (own, grad, moment[0]),
                    (other, np.array([diff.sum(), *((moves - expected).ravel() - 0.05 * trans.ravel())]), moment[1])):
                mean += 0.1 * (g - mean)  # Adam
                square += 0.01 * (g * g - square)
                value += 0.3 * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.99 ** k)) + 1e-8)
        weights[used], bias, trans = own, other[0], other[1:].reshape(2, 2)
    tagger = Tagger(weights, float(bias), trans, np.array([-4.0, 0.0, 0.0, 0.0]))
    if rows and {y for _, y in rows} == {0, 1}:
        x = np.array([[1.0, *summary(p)] for p in tagger.marginals([t for t, _ in rows])])
        y = np.array([float(v) for _, v in rows])
        n = {c: max(1, (y == c).sum()) for c in (0, 1)}
        share = {c: sizes.get(c, n[c]) / max(1, sum(sizes.values())) for c in (0, 1)}
        weight = np.where(y == 1, share[1] / n[1], share[0] / n[0]) * len(y)
        beta = np.zeros(4)
        for _ in range(30):  # Newton steps with a small ridge
            q = logistic(x @ beta)
            h = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(4)
            beta = beta + np.linalg.solve(h, x.T @ (weight * (y - q)) - 0.1 * beta)
        tagger.document = beta
    tagger.cache = {}
    return tagger


def tag(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score, spans array<struct<begin,end,p>>)`` per row.

    Null and empty texts have no spans and the score of a text without toxic
    words. Whole texts are scored, however long; repeated rows get the same
    answer; extra columns are ignored; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            got = list(tagger.scores(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([g[0] for g in got], pa.float64()),
                pa.array([[dict(zip(("begin", "end", "p"), s)) for s in g[1]] for g in got], kind)],
                ["id", "score", "spans"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    out = rows.mapInArrow(run, "id long, score double, spans array<struct<begin:int,end:int,p:double>>")
    return out.withColumnRenamed("id", id_col)


def reject(docs: DataFrame, tagger: Tagger, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all columns kept."""
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield pd.Series([g[0] for g in tagger.scores(some.where(some.notna(), None).tolist())], dtype="float64")
    return docs.where(score(F.col(text_col)) < threshold)
