"""Top-k joins of every row with every other one, by tiles of packed blocks.

Rows are packed into blocks of a few MB (one table row each: ids and the payload
as bytes) and written as a table of ``parts`` files. Pairs of blocks meet in a
cartesian product of the table's partitions, which Spark reads from the table for
each pair of partitions: neither rows nor pairs are shuffled, whatever the number
of blocks. A task keeps the ``k`` best of every row it has seen, so it sends ``k``
rows a row, not per tile; the score to beat so far settles nearly all
pairs of a tile by one comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGES = "src long, dst long, score double"
SLACK = 2e-6  # more than rounding to 6 places moves a score
STRIP_ROWS, STRIP_COLS = 256, 2048
EXACT = 1 << 18  # numbers of rows multiplied in double precision at once


class Best:
    """The ``k`` best columns of each of some rows, seen in strips."""

    def __init__(self, ids: np.ndarray, k: int, above: float = -np.inf):
        self.ids, self.k, self.above = ids, k, above
        self.score = np.full((len(ids), k), -np.inf)
        self.dst = np.full((len(ids), k), np.iinfo(np.int64).max)

    def keep(self, first: int, scores: np.ndarray, dst: np.ndarray,
             exact: Callable[[np.ndarray, np.ndarray], np.ndarray], slack: float = SLACK, turned: bool = False,
             least: float = -np.inf) -> None:
        """Offer columns ``dst`` to the rows from ``first`` on. ``scores`` (``turned``:
        their columns are the rows here) differ by less than ``slack`` from
        ``exact(row, column)``, by which rows are ranked; ties go to the smaller
        ``dst``, -inf is no column. Scores below ``least`` are known to be of no use."""
        rows, cols = scores.shape[::-1] if turned else scores.shape
        if not scores.size:
            return
        own = slice(first, first + rows)
        last, last_dst = self.score[own, -1], self.dst[own, -1]
        least = np.maximum(np.maximum(last, self.above) - slack, least)

        def passing(some=slice(None)):
            """Scores of some rows that are not below ``least``, compared in the type of the scores."""
            low = least[some]
            if scores.dtype != low.dtype:
                low = np.nextafter(low.astype(scores.dtype), scores.dtype.type(-np.inf))
            return scores[:, some] >= low if turned else scores[some] >= low[:, None]
        mask = passing()
        many = np.zeros(0, np.int64)
        if cols > self.k and np.count_nonzero(mask) > rows:
            many = np.flatnonzero(np.count_nonzero(mask, axis=0 if turned else 1) > 4 * self.k)
        if len(many):  # the k-th best of these columns is a bound, too
            best = np.partition(scores[:, many].T if turned else scores[many], cols - self.k, axis=1)[:, cols - self.k]
            least[many] = np.maximum(least[many], best.astype(float) - slack)
            mask[(slice(None), many) if turned else many] = passing(many)
        r, c = np.divmod(np.flatnonzero(mask), scores.shape[1])  # faster than nonzero of two dimensions
        if turned:
            r, c = c, r
        value, to = exact(r, c), dst[c]
        better = (value > last[r]) | ((value == last[r]) & (to < last_dst[r]))
        use = better & np.isfinite(value) & (value > self.above)
        r, value, to = r[use] + first, value[use], to[use]
        if not len(r):
            return
        some = np.unique(r)
        row = np.concatenate([r, np.repeat(some, self.k)])
        value = np.concatenate([value, self.score[some].ravel()])
        to = np.concatenate([to, self.dst[some].ravel()])
        order = np.lexsort((to, -value, row))
        row, value, to = row[order], value[order], to[order]
        top = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        self.score[some], self.dst[some] = value[top].reshape(-1, self.k), to[top].reshape(-1, self.k)

    def rows(self, edges: tuple[str, ...] = ("src", "dst", "score")) -> pa.RecordBatch:
        held = np.isfinite(self.score)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.ids, self.k).reshape(held.shape)[held], pa.int64()),
                                           pa.array(self.dst[held], pa.int64()), pa.array(self.score[held])], list(edges))


class Dense:
    """Dense rows in id order."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.finite = bool(np.isfinite(rows).all())
        self._single = None

    def single(self) -> tuple[np.ndarray, float]:
        """The rows in single precision, and the length of the longest one."""
        if self._single is None:
            longest = np.sqrt(np.einsum("ij,ij->i", self.rows, self.rows).max(initial=0.0))
            self._single = self.rows.astype(np.float32) if longest < 1e15 else self.rows, float(longest)
        return self._single

    @classmethod
    def of(cls, ids: pa.Array, vectors: pa.Array) -> Dense:
        ids, flat = ids.to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False)
        if vectors.null_count or len(set(vectors.value_lengths().to_pylist())) > 1:
            raise ValueError("a vector is null or of another length than others")
        order = np.argsort(ids, kind="stable")
        return cls(ids[order], flat.reshape(len(ids), -1)[order])

    def meet(self, other: Dense, mine: Best, theirs: Best | None, squared: bool = False, exclude_self: bool = True) -> None:
        """Offer all rows of ``other`` to these, and these to ``theirs`` if given. Inner
        products are made in single precision where all numbers are finite, and those that
        may be among the best again in double precision."""
        x, y, error = self.rows, other.rows, 0.0
        single = not squared and self.finite and other.finite
        if single:
            (x, length), (y, lengths) = self.single(), other.single()
            error = 1.2e-7 * (x.shape[1] + 4) * length * lengths
        if squared:
            norm, norms = (self.rows ** 2).sum(1), (other.rows ** 2).sum(1)
        same = np.isin(other.ids, self.ids) if exclude_self else np.zeros(len(other.ids), bool)
        for i in range(0, len(self.ids), STRIP_ROWS):
            a = self.rows[i:i + STRIP_ROWS]
            for j in range(0, len(other.ids), STRIP_COLS):
                b, ids = other.rows[j:j + STRIP_COLS], other.ids[j:j + STRIP_COLS]
                s, slack = x[i:i + STRIP_ROWS] @ y[j:j + STRIP_COLS].T, SLACK + error
                if squared:
                    n, m = norm[i:i + STRIP_ROWS, None], norms[None, j:j + STRIP_COLS]
                    s, slack = 2.0 * s - n - m, SLACK + 1e-12 * (n.max() + m.max())
                if not (self.finite and other.finite):
                    s[~np.isfinite(s)] = -np.inf
                own = np.flatnonzero(same[j:j + STRIP_COLS])
                low, high = (np.searchsorted(self.ids[i:i + STRIP_ROWS], ids[own], side) for side in ("left", "right"))
                while (left := low < high).any():  # as often as an id repeats
                    low, high, own = low[left], high[left], own[left]
                    s[low, own], low = -np.inf, low + 1

                def exact(r, c):
                    if single:
                        out = np.empty(len(r))
                        for at in range(0, len(r), step := max(1, EXACT // max(1, a.shape[1]))):
                            some = slice(at, at + step)
                            out[some] = np.einsum("ij,ij->i", a[r[some]], b[c[some]])
                        return np.where(np.isneginf(s[r, c]), -np.inf, np.round(out, 6))
                    if not squared:
                        return np.round(s[r, c], 6)
                    return np.where(np.isneginf(s[r, c]), -np.inf, -np.round(((a[r] - b[c]) ** 2).sum(1), 6))
                mine.keep(i, s, ids, exact, slack)
                if theirs is not None:
                    theirs.keep(j, s, self.ids[i:i + STRIP_ROWS], lambda r, c: exact(c, r), slack, turned=True)


def packed(rows: DataFrame, schema: str, full: Callable[[pa.Table], int],
           pack: Callable[[pa.Table], list[list[bytes]]]) -> DataFrame:
    """The rows of each partition packed: ``blk`` and the columns of ``schema``. ``full`` tells how many leading rows are packed
    together, or 0 when more can come; ``pack`` makes the table rows of them."""
    names = ["blk", *(c.split()[0] for c in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, TaskContext.get().partitionId() << 32

        def made(some: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for columns in pack(some.combine_chunks()):
                yield pa.RecordBatch.from_arrays([pa.array([number]), *(pa.array([x], pa.binary()) for x in columns)], names)
                number += 1
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            while n := full(held):
                yield from made(held.slice(0, n))
                held = held.slice(n)
        if held is not None and held.num_rows:
            yield from made(held)

    return rows.mapInArrow(run, f"blk long, {schema}")


def topk(left: DataFrame, right: DataFrame | None, load: Callable, k: int, above: float = -np.inf, **how) -> DataFrame:
    """The ``k`` best rows of ``right`` for every row of ``left`` (tables of blocks;
    without ``right``, of ``left`` itself, each pair of blocks once), by
    partitions: ``(src, dst, score)``. ``load`` makes a block of a table row."""
    names, itself = left.columns[1:], right is None
    a = left.toDF("ablk", *(f"a_{c}" for c in names))
    b = (left if itself else right).toDF("bblk", *(f"b_{c}" for c in names))
    both = a.hint("shuffle_replicate_nl").join(b, F.col("ablk") <= F.col("bblk") if itself else F.lit(True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, Best] = {}
        held, one = None, None

        def state(side: str, blk: int, block) -> Best:
            at = ("" if itself else side, blk)
            if at not in best:
                best[at] = Best(block.ids, k, above)
            return best[at]
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = batch.column("ablk")[i].as_py(), batch.column("bblk")[i].as_py()
                if x != held:
                    held, one = x, load(*(batch.column(f"a_{c}")[i].as_buffer() for c in names))
                same = itself and x == y
                two = one if same else load(*(batch.column(f"b_{c}")[i].as_buffer() for c in names))
                one.meet(two, state("a", x, one), state("b", y, two) if itself and not same else None, **how)
        for found in best.values():
            yield found.rows()

    return both.mapInArrow(run, EDGES)


def dense_blocks(rows: DataFrame, parts: int, block_rows: int) -> DataFrame:
    """In ``parts`` partitions, blocks of ``rows (id, v)``, of at most ``block_rows`` rows and 16 MB."""
    def full(t: pa.Table) -> int:
        width = max(1, len(t.column("v")[0])) if t.num_rows else 1
        most = max(1, min(block_rows, (1 << 21) // width))
        return most if t.num_rows >= most else 0

    def pack(t: pa.Table) -> list[bytes]:
        d = Dense.of(t.column("id").chunk(0), t.column("v").chunk(0))
        return [[d.ids.tobytes(), d.rows.tobytes()]]
    return packed(rows.repartition(parts, "id"), "ids binary, rows binary", full, pack)


def dense(ids, rows) -> Dense:
    ids = np.frombuffer(ids, np.int64)
    return Dense(ids, np.frombuffer(rows, np.float64).reshape(len(ids), -1))
