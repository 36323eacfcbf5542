"""Blocks of documents, and a count-min sketch of what they hold.

Hashed items (word windows, shingles) number as many as words, so they are
not shuffled as rows. Documents sit in blocks of bounded size, in a table
bucketed by block, so later steps meet their block without moving text again.
Each block counts its items in a count-min sketch and sends the non-zero
cells, cut into ranges, as sorted gaps (about two bytes an item); sketches of
one range are merged, and each block gets back those of its own cells whose
merged count is two or more, with the count's magnitude.

The sketch is kept sparse, where a wider row costs bits only logarithmically,
so one row of 32 or more cells an item serves better than several narrow
ones. A cell's count is never below the number of documents (or occurrences)
of any item in it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.shingles import gaps, packed, ungapped, unpacked
from loomgraph.session import ensure_checkpoint_dir, materialize

BLOBS = "_range int, _block int, _data binary"
LAST = np.iinfo(np.int64).max  # place of a null id: after all others


@dataclass
class Grid:
    """Numbers of blocks and ranges, and the sketch's width in bits."""
    n: int
    bits: int

    def cell(self, h: np.ndarray) -> np.ndarray:
        return h >> np.uint64(64 - self.bits)

    def range_of(self, h: np.ndarray) -> np.ndarray:
        """Range of hashes: equal parts of the hash space, in order."""
        return ((h >> np.uint64(32)) * np.uint64(self.n) >> np.uint64(32)).astype(np.int64)

    def by_range(self, block: int, h: np.ndarray, blob) -> pa.Table:
        """``blob(a, b)`` for each range's part ``a:b`` of sorted hashes."""
        edge = np.searchsorted(self.range_of(h), np.arange(self.n + 1))
        return blobs([(r, block, blob(edge[r], edge[r + 1])) for r in range(self.n) if edge[r] < edge[r + 1]])


def blobs(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [(), (), ()]
    return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())],
                    ["_range", "_block", "_data"])


def block_table(docs: DataFrame, id_col: str, text_col: str, block_bytes: int,
                carry: dict[str, str]) -> tuple[DataFrame, Grid]:
    """Table ``(_block, _id, _t, carried columns)`` bucketed by ``_block``.

    The number of blocks follows the bytes of text, so a block holds about
    ``block_bytes`` at any size of the corpus. ``carry`` maps columns of
    ``docs`` to the names they travel under.
    """
    spark = docs.sparkSession
    total = int(docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0)
    n = max(1, -(-total // block_bytes))
    bits = max(16, int(np.ceil(np.log2(max(1, total) / 6 * 32))))  # six bytes a word, 32 cells an item
    rows = docs.select(F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias("_block"),
                       F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"),
                       *(F.col(c).alias(k) for c, k in carry.items()))
    name = f"lg_blocks_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/loomgraph-tables/{name}"
    (rows.repartition(n, "_block").write.bucketBy(n, "_block").option("path", path)
     .option("compression", "zstd").saveAsTable(name))
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.table(name), Grid(n, bits)


def ordered(block: pa.Table) -> tuple[list[int], np.ndarray, list[bytes]]:
    """Row numbers, ids and texts of a block by (id, text); null ids last."""
    ids = [LAST if v is None else v for v in block.column("_id").to_pylist()]
    texts = [(v or "").encode() for v in block.column("_t").to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
    return order, np.array([ids[i] for i in order], dtype=np.int64), [texts[i] for i in order]


def repeated_cells(table: DataFrame, grid: Grid, items) -> DataFrame:
    """``(_range, _block, _data)``: for each block, its cells whose merged
    count is two or more (gaps) and the count's binary magnitude (bytes).

    ``items(block)`` gives the hashes a block counts, one per occurrence.
    The result is a written table: two later passes read it.
    """
    def sketch(block: pa.Table) -> pa.Table:
        h = np.sort(items(block))
        cell = grid.cell(h)
        at = np.flatnonzero(np.diff(cell, prepend=~cell[:1]) != 0)
        count = np.minimum(np.diff(np.append(at, len(cell))), 255).astype(np.uint8)
        cell = cell[at]
        # by the cell's first hash, so that a cell lies in one range for all blocks
        return grid.by_range(block.column("_block")[0].as_py(), cell << np.uint64(64 - grid.bits),
                             lambda a, b: packed(gaps(cell[a:b]), count[a:b]))

    def merge(part: pa.Table) -> pa.Table:
        r = part.column("_range")[0].as_py()
        names, cells, counts = [], [], []
        for block, data in zip(part.column("_block").to_pylist(), part.column("_data").to_pylist()):
            gap, count = unpacked(data)
            names.append((block, len(gap)))
            cells.append(ungapped(gap))
            counts.append(count)
        some, inverse = np.unique(np.concatenate(cells), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(some))
        size = np.log2(total).astype(np.uint8)
        out, at = [], 0
        for (block, n), own in zip(names, cells):
            mine = inverse[at:at + n]
            hot = total[mine] > 1
            at += n
            if hot.any():
                out.append((r, block, packed(gaps(own[hot]), size[mine[hot]])))
        return blobs(out)

    return materialize(table.groupBy("_block").applyInArrow(sketch, BLOBS)
                       .groupBy("_range").applyInArrow(merge, BLOBS), "repeat-cells")


def received(cells: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A block's repeated cells, sorted, and their magnitudes."""
    got = [unpacked(c) for c in cells]
    if not got:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    cell, size = np.concatenate([ungapped(g[0]) for g in got]), np.concatenate([g[1] for g in got])
    order = np.argsort(cell)
    return cell[order], size[order]


def magnitudes(h: np.ndarray, grid: Grid, cell: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Binary magnitude of the estimated count of each hash (0: counted once)."""
    if not len(cell):
        return np.zeros(len(h), np.uint8)
    own = grid.cell(h)
    at = np.minimum(np.searchsorted(cell, own), len(cell) - 1)
    return np.where(cell[at] == own, size[at], 0).astype(np.uint8)
