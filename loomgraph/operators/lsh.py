"""Approximate top-k cosine neighbours by random-hyperplane LSH.

For inputs too large for the exact tiled product. Each vector gets
``bands`` signatures of ``rows`` sign bits (one matrix product per Arrow
batch; the hyperplane matrix has a fixed size, ``bands * rows * dim``).
Vectors sharing a band signature are candidates. Inside a bucket nothing
is enumerated pair by pair: the bucket is cut into hash blocks of at most
``block_rows`` rows and 32 MB, each unordered pair of blocks meets once, and a task
keeps the ``k`` best per row with BLAS in strips, as in the exact join. A row is sent once
a band and block of its bucket; a hot bucket (even a third of all rows) becomes many bounded tasks.
Candidates found in several
bands are merged and a window keeps the ``k`` best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.vectors import l2_normalize
from loomgraph.operators import tiles

BLOCK_BYTES = 32 << 20


def _signatures(dim: int, bands: int, rows: int, seed: int):
    planes = np.random.default_rng(seed).standard_normal((bands * rows, dim))
    weights = (1 << np.arange(rows, dtype=np.int64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if b.empty:
                continue
            v = np.stack(b["v"].to_numpy()).astype(np.float64, copy=False)
            bits = (v @ planes.T > 0).reshape(len(b), bands, rows).astype(np.int64)
            codes = (bits * weights).sum(axis=2)
            yield pd.DataFrame({
                "id": np.repeat(b["id"].to_numpy(), bands),
                "v": np.repeat(b["v"].to_numpy(), bands),
                "band": np.tile(np.arange(bands, dtype=np.int32), len(b)),
                "bucket": codes.reshape(-1),
            })
    return run


def knn_lsh(vectors: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
            bands: int = 24, rows: int = 4, block_rows: int = 65_536, seed: int = 7) -> DataFrame:
    """Approximate directed top-k cosine neighbours: ``(src, dst, sim, rank)``."""
    unit = vectors.select(F.col(id_col).cast("long").alias("id"), l2_normalize(vec_col).alias("v"))
    dim = unit.select(F.max(F.size("v"))).first()[0] or 0
    sig = unit.mapInPandas(_signatures(dim, bands, rows, seed),
                           "id long, v array<double>, band int, bucket long")
    most = max(1, min(block_rows, BLOCK_BYTES // (8 * max(1, dim))))
    sizes = sig.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("m"))
    nb = F.ceil(F.col("m") / F.lit(most)).cast("int")
    sized = sig.join(sizes.select("band", "bucket", nb.alias("nb")), ["band", "bucket"])
    own = F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")
    met = (sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
           .select("band", "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "id", "v"))

    def tile(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        mine = pa.array(part.column("own").to_numpy() == key[2].as_py())
        sides = []
        for side in (part.filter(mine), part.filter(pc.invert(mine))):
            side = side.combine_chunks()
            if side.num_rows:
                block = tiles.Dense.of(side.column("id").chunk(0), side.column("v").chunk(0))
                sides.append((block, tiles.Best(block.ids, k)))
        one, best = sides[0]
        if key[2] == key[3]:
            one.meet(one, best, None)
        elif len(sides) > 1:
            one.meet(sides[1][0], best, sides[1][1])
        return pa.Table.from_batches([found.rows() for _, found in sides])

    cand = met.groupBy("band", "bucket", "a", "b").applyInArrow(tile, tiles.EDGES)
    best = cand.groupBy("src", "dst").agg(F.max("score").alias("score"))
    w = Window.partitionBy("src").orderBy(F.col("score").desc(), F.col("dst").asc())
    out = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return out.select("src", "dst", F.round("score", 6).alias("sim"), F.col("rank").cast("long"))


def recall(approx: DataFrame, exact: DataFrame) -> float:
    """Share of exact (src, dst) edges that the approximate result found."""
    hit = exact.join(approx.select("src", "dst"), ["src", "dst"], "left_semi").count()
    total = exact.count()
    return hit / total if total else 1.0
