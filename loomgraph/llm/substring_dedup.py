"""Removal of repeated word windows, found through a count-min prefilter.

A window is ``window`` consecutive words of one document; words of a window
whose sequence also starts earlier (smaller id, or earlier in the document)
are removed. Three passes run over blocks of documents (see ``blocktable``):

1. *Sketch.* A count-min sketch of all windows, merged over the blocks, tells
   each block which of its windows may be repeated: with 32 or more cells a
   window about one window in 32 is estimated repeated without being so, and
   none is missed.
2. *Exact count.* Windows estimated repeated go, once per block, with a 96-bit
   fingerprint and the first document that holds them, to the range of their
   fingerprint, where the first holder over all blocks is found.
3. *Removal.* Each block marks every occurrence but the first holder's first
   one, and drops the covered words.

A window held by a third of all documents is one entry per block. Fingerprints
of different windows among ``n`` estimated repeated agree with a probability
of about n**2 / 2**97.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.blocktable import BLOBS, block_table, blobs, magnitudes, ordered, received, repeated_cells
from loomgraph.llm.shingles import RUN_BASES, Words, blocks, gaps, packed, ungapped, unpacked
from loomgraph.session import materialize


class Block:
    """The documents of one block in order, and their windows' hashes."""

    def __init__(self, table: pa.Table, window: int):
        self.order, self.ids, self.texts = ordered(table)
        self.window = window

    def hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per window: 64-bit hash, 32 more bits, document and start (in words)."""
        first, more, doc, start = [], [], [], []
        for a, b in blocks(self.texts):
            w = Words(self.texts[a:b])
            own = np.flatnonzero(w.whole(self.window))
            first.append(w.runs(self.window)[own])
            more.append((w.runs(self.window, RUN_BASES[1])[own] >> np.uint64(32)).astype("<u4"))
            text = np.repeat(np.arange(len(w.count)), w.count)[own]
            doc.append((text + a).astype("<u4"))
            start.append((own - w.first[text]).astype("<u4"))
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return cat(first, np.uint64), cat(more, "<u4"), cat(doc, "<u4"), cat(start, "<u4")


def substring_dedup(docs: DataFrame, window: int = 20, block_bytes: int = 12 << 20,
                    id_col: str = "doc_id", text_col: str = "text",
                    carry: tuple[str, ...] = (), as_written: bool = False) -> DataFrame:
    """``(id, text, n_words, n_removed, *carry)``: the kept words of every
    document joined by one space. With ``as_written`` a document that loses
    nothing keeps its text as it is (null included).

    Null and empty texts have no words; texts shorter than a window lose
    nothing. Equal documents: the one with the smallest id keeps its words.
    Rows of one id count as documents in the order of their texts; a null id
    comes after all others. Windows are judged on the input. ``carry`` names
    columns passed through; other columns are ignored, whatever their names.
    An empty table gives no rows. Blocks hold about ``block_bytes`` of text
    at any size of the corpus.
    """
    kept = {c: f"_c{i}" for i, c in enumerate(carry)}
    table, grid = block_table(docs, id_col, text_col, block_bytes, kept)
    texts = table.select("_block", "_id", "_t")

    def estimated(block: pa.Table, cells: list[bytes]):
        """The block's windows in repeated cells, by fingerprint and place."""
        own = Block(block, window)
        if not cells:
            return own, None
        h, g, doc, start = own.hashes()
        some = np.flatnonzero(magnitudes(h, grid, *received(cells)))
        some = some[np.lexsort((g[some], h[some]))]  # stable: places stay in order
        h, g, doc, start = h[some], g[some], doc[some], start[some]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        return own, (h, g, doc, start, new)

    def candidates(key: tuple[pa.Scalar, ...], block: pa.Table, sent: pa.Table) -> pa.Table:
        own, found = estimated(block, sent.column("_data").to_pylist())
        if found is None:
            return blobs([])
        h, g, doc, _, new = found
        h, g, doc = h[new], g[new], doc[new]

        def blob(a, b):
            docs_, place = np.unique(own.ids[doc[a:b]], return_inverse=True)
            small = place.astype("<u2" if len(docs_) <= 1 << 16 else "<u4")
            return packed(gaps(h[a:b]), g[a:b], docs_, small)
        return grid.by_range(key[0].as_py(), h, blob)

    def decide(part: pa.Table) -> pa.Table:
        r = part.column("_range")[0].as_py()
        names, h, g, ids = [], [], [], []
        for block, data in zip(part.column("_block").to_pylist(), part.column("_data").to_pylist()):
            gap, more, docs_, place = unpacked(data)
            names.append((block, len(gap)))
            h.append(ungapped(gap))
            g.append(more)
            ids.append(docs_[place])
        h, g, ids = np.concatenate(h), np.concatenate(g), np.concatenate(ids)
        order = np.lexsort((ids, g, h))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
        first = np.zeros(len(h), bool)
        first[order[new]] = True
        out, at = [], 0
        for block, size in names:
            out.append((r, block, packed(np.packbits(first[at:at + size]))))
            at += size
        return blobs(out)

    def remove(key: tuple[pa.Scalar, ...], block: pa.Table, sent: pa.Table) -> pa.Table:
        data = sorted(zip(sent.column("_range").to_pylist(), sent.column("_kind").to_pylist(),
                          sent.column("_data").to_pylist()))
        own, found = estimated(block, [d for _, kind, d in data if kind == 0])
        starts: list[np.ndarray] = [np.zeros(0, np.int64)] * len(own.texts)
        if found is not None:
            h, _, doc, start, new = found
            sizes = np.bincount(grid.range_of(h[new]), minlength=grid.n)
            first = np.concatenate([np.unpackbits(unpacked(d)[0], count=sizes[r]) for r, kind, d in data if kind == 1])
            again = np.ones(len(h), bool)  # all occurrences but the first holder's first
            again[new] = first == 0
            by = np.argsort(doc[again], kind="stable")
            edge = np.searchsorted(doc[again][by], np.arange(len(own.texts) + 1))
            at = start[again][by].astype(np.int64)
            starts = [at[edge[i]:edge[i + 1]] for i in range(len(own.texts))]
        text, count, gone = [], [], []
        given = block.column("_t")
        for row, raw, s in zip(own.order, own.texts, starts):
            words = raw.split()
            if len(s):
                cover = np.bincount(s, minlength=len(words) + 1) - np.bincount(s + window, minlength=len(words) + 1)
                drop = np.cumsum(cover[:len(words)]) > 0
                gone.append(int(drop.sum()))
                text.append(b" ".join([w for w, d in zip(words, drop) if not d]).decode())
            else:
                gone.append(0)
                text.append(given[row].as_py() if as_written else b" ".join(words).decode())
            count.append(len(words))
        back = block.take(pa.array(own.order, pa.int64()))
        return pa.table([back.column("_id"), pa.array(text, pa.string()), pa.array(count, pa.int64()),
                         pa.array(gone, pa.int64()), *(back.column(k) for k in kept.values())],
                        ["_id", "_t", "n_words", "n_removed", *kept.values()])

    hot = repeated_cells(texts, grid, lambda block: Block(block, window).hashes()[0])
    verdicts = materialize(
        texts.groupBy("_block").cogroup(hot.groupBy("_block")).applyInArrow(candidates, BLOBS)
        .groupBy("_range").applyInArrow(decide, BLOBS), "repeat-first")
    sent = hot.withColumn("_kind", F.lit(0)).unionByName(verdicts.withColumn("_kind", F.lit(1)))
    kinds = dict((f.name, f.dataType.simpleString()) for f in table.schema)
    schema = "_id long, _t string, n_words long, n_removed long" + "".join(f", {k} {kinds[k]}" for k in kept.values())
    out = table.groupBy("_block").cogroup(sent.groupBy("_block")).applyInArrow(remove, schema)
    return out.select(F.col("_id").alias(id_col), F.col("_t").alias(text_col), "n_words", "n_removed",
                      *(F.col(k).alias(c) for c, k in kept.items()))
