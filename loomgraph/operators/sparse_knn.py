"""Exact top-k neighbours of sparse vectors (J2 for TF-IDF), without caps.

Every vector meets every other one, and nothing is skipped by how frequent a
term is. Vectors are packed into blocks of about ``block_postings`` entries, and
each unordered pair of blocks meets once (:mod:`loomgraph.operators.tiles`). Terms
that many rows of both blocks hold are multiplied as a dense matrix in single
precision, the others by their pairs of entries. What the rounding of single precision
may have put among the best is scored again in double precision. The entries are
shuffled once, to be packed by id; no pair list and no posting list ever is, a tile's
memory is bounded by the block size, and a term that a third of all documents hold
costs no more in one task than in another.

The rows of a partition are put in order of their content (a few centres of its most
frequent terms) and of their number of terms before they are cut into blocks, so blocks
of different languages share few terms and those of short texts few entries. The order
has no bearing on the result.

The arithmetic is the n * n / 2 of exact search (on these texts the prefix
bound of the cosine keeps 97 % of all postings at the fifth neighbour's
similarity, so it saves nothing); beyond what that allows, use
:mod:`loomgraph.operators.lsh`.

Terms of one document only cannot be shared and are left out of the product.
Equal texts are searched once: of a group of copies the smallest id is its
representative, and only the ``k + 1`` smallest ids of a group can be among
anybody's neighbours. The expansion adds ``k`` rows a document, never the pairs
of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.operators import tiles
from loomgraph.session import materialize

PART_BYTES, PART_POSTINGS = 72 << 20, 1 << 16  # of a partition of the table of blocks: at most, and of a small table
HELD_POSTINGS = 6 << 20  # put in order at once
BLOCK_ROWS, STRIP_ROWS = 2048, 512
PACK_BLOCKS = 4  # full blocks of a table row: fewer bytes are sent for a pair of rows
DEAR = 300  # multiplications of a matrix product in the time of one of matched entries
CENTRES, CENTRE_TERMS, CENTRE_ROUNDS = 6, 512, 5
COLUMNS = (np.int64, np.int64, np.int32, np.uint16, np.float64)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + count - 1`` of all ranges, in turn."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Rows:
    """Sparse rows in id order, their entries in order of terms."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, count: np.ndarray, row: np.ndarray, weight: np.ndarray):
        self.ids, self.terms, self.count, self.weight = ids, terms, count, weight
        self.row = row.astype(np.intp)
        self.start = np.cumsum(count, dtype=np.int64) - count
        self.least = weight.min(initial=np.inf)
        self._by_row = self._main = None

    @classmethod
    def load(cls, *columns) -> Rows:
        return cls(*map(np.frombuffer, columns, COLUMNS))

    def by_row(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, place of the term and weight of the entries in order of rows."""
        if self._by_row is None:
            order = np.argsort(self.row.astype(np.uint16), kind="stable")
            term = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.count)
            self._by_row = self.row[order], term[order], self.weight[order]
        return self._by_row

    def dense(self, at: np.ndarray) -> np.ndarray:
        """The columns of the terms at places ``at``."""
        out = np.zeros((len(self.ids), len(at)))
        entry = _ranges(self.start[at], self.count[at])
        out[self.row[entry], np.repeat(np.arange(len(at)), self.count[at])] = self.weight[entry]
        return out

    def alike(self, other: Rows) -> float:
        """About the mean product, of the terms with most weight."""
        if self._main is None or other._main is None:
            for x in (self, other):
                total = np.bincount(np.repeat(np.arange(len(x.terms)), x.count), x.weight, len(x.terms))
                top = np.sort(np.argsort(-total, kind="stable")[:CENTRE_TERMS])
                x._main = x.terms[top], total[top] / max(1, len(x.ids))
        _, i, j = np.intersect1d(self._main[0], other._main[0], assume_unique=True, return_indices=True)
        return float(self._main[1][i] @ other._main[1][j])

    def meet(self, other: Rows, mine: tiles.Best, theirs: tiles.Best | None, first: int = 0, their_first: int = 0) -> None:
        """Offer all rows of ``other`` to these, and these to ``theirs`` if given; ``first``
        are the places of the rows of both among those that the best are kept of."""
        least = np.finfo(np.float32).tiny if min(self.least, other.least) >= 0 else -np.inf  # 0 is exact: nothing shared
        for strip in strips(self, other):
            at = strip.first
            if self is other:
                np.fill_diagonal(strip.scores[:, at:], -np.inf)
            mine.keep(first + at, strip.scores, other.ids, strip.exact, strip.slack, least=least)
            if theirs is not None:
                theirs.keep(their_first, strip.scores, self.ids[at:at + len(strip.scores)], lambda r, c: strip.exact(c, r),
                            strip.slack, turned=True, least=least)


@dataclass
class Strip:
    """Inner products of some rows of a block from ``first`` on with all rows of another one:
    ``scores`` differ by less than ``slack`` from the ``exact`` ones."""
    first: int
    scores: np.ndarray
    light: np.ndarray
    a: np.ndarray  # the frequent terms of these rows
    b: np.ndarray  # and of the others
    slack: float

    def exact(self, r: np.ndarray, c: np.ndarray, most: int = 1 << 18) -> np.ndarray:
        """Products rounded to 6 places of rows ``r`` with rows ``c``; -inf where the score is."""
        out = self.light[r, c]
        for at in range(0, len(r), step := max(1, most // max(1, self.a.shape[1]))):
            some = slice(at, at + step)
            out[some] += np.einsum("ij,ij->i", self.a[r[some]], self.b[c[some]])
        return np.where(np.isneginf(self.scores[r, c]), -np.inf, np.round(out, 6))


def strips(a: Rows, b: Rows, most: int = 1 << 20) -> Iterator[Strip]:
    """The tile of two blocks by strips of rows of ``a``, small enough for a core's cache: terms
    frequent in both by a matrix product, the others by their pairs of entries, some ``most`` in a strip."""
    _, x, y = np.intersect1d(a.terms, b.terms, assume_unique=True, return_indices=True)
    heavy = a.count[x].astype(np.int64) * b.count[y] * DEAR > len(a.ids) * len(b.ids)
    m, n = a.dense(x[heavy]), b.dense(y[heavy])
    length = math.prod(math.sqrt((v * v).sum(axis=1).max(initial=0.0)) for v in (m, n))
    kind = np.float32 if length < 1e30 else np.float64
    mf, nf = m.astype(kind), n.astype(kind).T

    to = np.full(len(a.terms), -1, np.int32)
    to[x[~heavy]] = y[~heavy]
    row, term, weight = a.by_row()
    at = to[term]
    some = np.flatnonzero(at >= 0)
    row, at, weight = row[some], at[some], weight[some]
    start, count = b.start[at], b.count[at]
    ends = np.searchsorted(row, np.arange(len(a.ids) + 1))  # entries before each row, and their pairs
    held = np.append(0, np.cumsum(count, dtype=np.int64))[ends]
    i, width = 0, len(b.ids)
    while i < len(a.ids):
        j = min(i + STRIP_ROWS, max(i + 1, int(np.searchsorted(held, held[i] + most, "right")) - 1))
        e = slice(ends[i], ends[j])
        met = _ranges(start[e], count[e])
        cell = np.repeat((row[e] - i) * width, count[e]) + b.row[met]
        light = np.bincount(cell, np.repeat(weight[e], count[e]) * b.weight[met], (j - i) * width).astype(float, copy=False).reshape(-1, width)
        scores = mf[i:j] @ nf
        scores += light
        # of each sum of n products: n + 3 roundings of the sum of absolute values, and one of the whole
        slack = tiles.SLACK + 1.2e-7 * ((m.shape[1] + 4) * length + max(light.max(), -light.min()))
        yield Strip(i, scores, light, m[i:j], n, slack)
        i = j


def products(a: Rows, b: Rows, most: int = 1 << 20) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``b``, the frequent terms in single precision."""
    return np.concatenate([s.scores for s in strips(a, b, most)])


class Packs:
    """The blocks of a table row."""

    def __init__(self, blocks: list[Rows]):
        self.blocks, self.ids = blocks, np.concatenate([b.ids for b in blocks])
        self.first = np.cumsum([0, *(len(b.ids) for b in blocks)])

    @classmethod
    def load(cls, sizes, *columns) -> Packs:
        sizes, columns = np.frombuffer(sizes, np.int64).reshape(-1, 3), list(map(np.frombuffer, columns, COLUMNS))
        ends = np.cumsum(sizes, axis=0)[:, [0, 1, 1, 2, 2]]
        begins = ends - sizes[:, [0, 1, 1, 2, 2]]
        return cls([Rows(*(x[i:j] for x, i, j in zip(columns, some, to))) for some, to in zip(begins, ends)])

    def meet(self, other: Packs, mine: tiles.Best, theirs: tiles.Best | None) -> None:
        itself = other is self
        pairs = [(i, j) for i in range(len(self.blocks)) for j in range(i if itself else 0, len(other.blocks))]
        # the most alike blocks first: what they find spares the others nearly all exact products
        for i, j in sorted(pairs, key=lambda p: -self.blocks[p[0]].alike(other.blocks[p[1]])):
            self.blocks[i].meet(other.blocks[j], mine, mine if itself and i < j else theirs, self.first[i], other.first[j])


def _entries(part: pa.Table) -> tuple[np.ndarray, ...]:
    """Ids, and row, term and weight of all entries."""
    ids, tids = part.column("id").chunk(0).to_numpy(), part.column("tids").chunk(0)
    row = np.repeat(np.arange(len(ids)), tids.value_lengths().to_numpy())
    return ids, row, *(c.flatten().to_numpy(zero_copy_only=False) for c in (tids, part.column("weights").chunk(0)))


def _columns(ids: np.ndarray, row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    place = np.empty(len(ids), np.int64)
    place[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    row = place[row]
    order = np.lexsort((row, term))
    terms, count = np.unique(term, return_counts=True)
    return [x.astype(kind) for x, kind in zip((np.sort(ids), terms, count, row[order], weight[order]), COLUMNS)]


def _pack(part: pa.Table) -> list[bytes]:
    return [x.tobytes() for x in _columns(*_entries(part))]


def centres(rows: int, row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each row the nearest of a few centres by its most frequent terms: the first
    ones are rows far from each other."""
    terms, code, count = np.unique(term, return_inverse=True, return_counts=True)
    column = np.full(len(terms), -1)
    top = np.argsort(-count, kind="stable")[:CENTRE_TERMS]
    column[top] = np.arange(len(top))
    column = column[code]
    some = column >= 0
    x = np.zeros((rows, len(top)), np.float32)
    x[row[some], column[some]] = weight[some]

    def unit(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), np.float32(1e-9))
    x = unit(x)
    near, found = x @ x.mean(axis=0), []
    for _ in range(min(CENTRES, rows)):
        found.append(x[np.argmin(near)])
        near = x @ found[-1] if len(found) == 1 else np.maximum(near, x @ found[-1])
    found = np.array(found)
    for _ in range(CENTRE_ROUNDS):
        label = np.argmax(x @ found.T, axis=1)
        found = unit(np.array([x[label == i].mean(axis=0) if (label == i).any() else c for i, c in enumerate(found)]))
    return np.argmax(x @ found.T, axis=1)


def _packs(part: pa.Table, block_postings: int) -> list[list[bytes]]:
    """Table rows of blocks of alike rows."""
    ids, row, term, weight = _entries(part)
    held = np.bincount(row, minlength=len(ids))
    start = np.cumsum(held) - held
    order = np.lexsort((ids, held, centres(len(ids), row, term, weight)))
    blocks, at, ends = [], 0, np.cumsum(held[order])
    while at < len(order):
        most = (ends[at - 1] if at else 0) + block_postings
        end = min(at + BLOCK_ROWS, max(at + 1, int(np.searchsorted(ends, most, "right"))))
        some = order[at:end]
        entry = _ranges(start[some], held[some])
        blocks.append(_columns(ids[some], np.repeat(np.arange(len(some)), held[some]), term[entry], weight[entry]))
        at = end
    out: list[list[list]] = []
    rows = postings = math.inf
    for b in blocks:
        rows, postings = rows + len(b[0]), postings + len(b[4])
        if rows > PACK_BLOCKS * BLOCK_ROWS or postings > PACK_BLOCKS * block_postings:
            out.append([])
            rows, postings = len(b[0]), len(b[4])
        out[-1].append(b)
    sizes = [np.array([[len(b[0]), len(b[1]), len(b[4])] for b in some], np.int64) for some in out]
    return [[n.tobytes(), *(b"".join(b[c].tobytes() for b in some) for c in range(5))] for n, some in zip(sizes, out)]


def topk_sparse(vectors: DataFrame, k: int, block_postings: int = 1 << 19, among: DataFrame | None = None) -> DataFrame:
    """Best ``k`` other rows of every row of ``vectors (id, tid, weight)`` by
    inner product, rounded to 6 places and above 0: ``(src, dst, sim, rank)``,
    ties to the smaller ``dst``. ``tid`` is a whole number per term; with
    ``among (id)`` only those rows."""
    postings = vectors.count()
    parts = max(math.ceil(12 * postings / PART_BYTES), min(6, math.ceil(postings / PART_POSTINGS)), 1)
    rows = vectors.repartition(parts, "id")  # the only shuffle of the entries
    if among is not None:
        rows = rows.join(among, "id", "left_semi")
    rows = (rows.groupBy("id").agg(F.collect_list(F.struct("tid", "weight")).alias("x"))
            .select("id", F.col("x.tid").alias("tids"), F.col("x.weight").alias("weights")))

    def full(t: pa.Table) -> int:
        held = np.cumsum(np.concatenate([c.value_lengths().to_numpy() for c in t.column("tids").chunks] or [[]]))
        return max(1, int(np.searchsorted(held, HELD_POSTINGS, "right"))) if len(held) and held[-1] > HELD_POSTINGS else 0

    # the weights hardly shrink, and a block is read for each pair of partitions
    blocks = materialize(tiles.packed(rows, "sizes binary, ids binary, terms binary, counts binary, rows binary, weights binary", full,
                                      lambda t: _packs(t, block_postings)), "sparse-blocks", codec="uncompressed")
    return ranked(tiles.topk(blocks, None, Packs.load, k, above=0.0).withColumnRenamed("score", "sim"), k)


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("src").orderBy(F.col("sim").desc(), F.col("dst").asc())
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def topk_texts(space, texts: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text",
               block_postings: int = 1 << 19) -> DataFrame:
    """Exact ``k`` nearest other documents of every document of a
    :class:`~loomgraph.operators.tfidf.SparseSpace` whose ``texts`` are given:
    ``(src, dst, sim, rank)``; a document without a positive similarity has no rows."""
    groups = materialize(texts.select(F.col(id_col).alias("id"), F.sha2(text_col, 256).alias("same")), "text-keys")
    first = materialize(groups.groupBy("same").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "text-groups")
    copied = first.where("copies > 1").limit(1).count() > 0
    reps = first.select(F.col("rep").alias("id"))
    shared = space.vectors.where("tid is not null and weight > 0").select("id", "tid", "weight")
    near = topk_sparse(shared, k, block_postings, reps if copied else None)
    if not copied:
        return near.select("src", "dst", "sim", "rank")

    near = materialize(near, "sparse-near")
    crowd = first.where("copies > 1").select("same", "rep")
    order = Window.partitionBy("rep").orderBy("id")
    members = materialize(groups.join(crowd, "same").select("rep", "id"), "text-copies")
    few = members.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).select("rep", "id")
    # a representative's neighbours: members of the groups near it, and of its own
    # group; one more than k, as a document is among its own group's members
    whole = space.vectors.where("weight > 0").select(F.col("id").alias("rep")).distinct()
    own = few.join(whole, "rep", "left_semi").select(F.col("rep").alias("src"), F.col("id").alias("dst"), F.lit(1.0).alias("sim"))
    beside = (near.join(few, F.col("dst") == F.col("rep"), "left")
              .select("src", F.coalesce("id", "dst").alias("dst"), "sim"))
    lists = (ranked(beside.unionByName(own), k + 1).groupBy(F.col("src").alias("rep"))
             .agg(F.collect_list(F.struct("dst", "sim")).alias("list")))
    every = groups.join(first, "same").select("rep", "id")
    pairs = (every.join(lists, "rep").select(F.col("id").alias("src"), F.inline("list")).where("src <> dst"))
    return ranked(pairs, k).select("src", "dst", "sim", "rank")
