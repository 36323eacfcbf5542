"""Similarity joins: exact top-k by tiles (J2, W1, J3), undirected union (U1),
pair sample (L5) and 1:1 key alignment (J1).

Exact top-k is a tiled matrix product (:mod:`loomgraph.operators.tiles`): rows are
packed into blocks, pairs of blocks are multiplied with BLAS, and a task sends the
``k`` best of each row it has seen. A window then keeps the ``k`` best per left row
over all tasks (Spark plans it as a partial ``WindowGroupLimit`` before the
exchange and a final one after it).

Task memory is a strip of scores and the blocks of two partitions whatever the
data size, no pair list is ever materialised and no vector is shuffled twice.
The cost is the inherent n*m of exact search; for corpus-scale inputs the
LSH-bucketed variant in :mod:`loomgraph.operators.lsh` bounds the work.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.vectors import as_double, dot, l2_normalize
from loomgraph.operators import tiles
from loomgraph.session import materialize

COSINE = "cosine"
SQEUCLIDEAN = "sqeuclidean"
PART_BYTES = 64 << 20  # of packed rows in a partition of the table of blocks


def topk_join(left: DataFrame, right: DataFrame, k: int, metric: str = COSINE,
              exclude_self: bool = False, block_rows: int = 8192,
              left_id: str = "id", left_vec: str = "v",
              right_id: str = "id", right_vec: str = "v") -> DataFrame:
    """For every left row, the ``k`` best right rows.

    Returns ``(src, dst, score, rank)``: ``score`` is the cosine similarity
    (``metric='cosine'``, vectors L2-normalised first) or the squared L2
    distance (``metric='sqeuclidean'``, lower first). Ties go to the smaller
    ``dst``. With ``exclude_self`` a row never pairs with its own id.
    """
    def blocks(df, id_col, vec_col):
        v = l2_normalize(vec_col) if metric == COSINE else as_double(vec_col)
        size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(vec_col)).alias("values")).first()
        parts = max(math.ceil(8 * (size["values"] or 0) / PART_BYTES), min(6, math.ceil(size["n"] / 512)), 1)
        rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
        return materialize(tiles.dense_blocks(rows, parts, block_rows), "dense-blocks")

    itself = right is left and (left_id, left_vec) == (right_id, right_vec)
    lt = blocks(left, left_id, left_vec)
    cand = tiles.topk(lt, None if itself else blocks(right, right_id, right_vec), tiles.dense, k,
                      squared=metric != COSINE, exclude_self=exclude_self)
    w = Window.partitionBy("src").orderBy(F.col("score").desc(), F.col("dst").asc())
    out = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    if metric != COSINE:
        out = out.withColumn("score", -F.col("score"))
    return out


def knn_edges(vectors: DataFrame, k: int, id_col: str = "vec_id",
              vec_col: str = "embedding", block_rows: int = 8192) -> DataFrame:
    """Directed top-k cosine neighbours of every vector, self excluded by id
    (W1, fixes D7). Returns ``(src, dst, sim, rank)``; ``sim`` rounded to 6."""
    e = topk_join(vectors, vectors, k, COSINE, exclude_self=True, block_rows=block_rows,
                  left_id=id_col, left_vec=vec_col, right_id=id_col, right_vec=vec_col)
    return e.select("src", "dst", F.round("score", 6).alias("sim"),
                    F.col("rank").cast("long").alias("rank"))


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst",
               weight: str = "sim", min_weight: float | None = None) -> DataFrame:
    """(i,j) and (j,i) collapse to one edge ``src < dst`` (U1). The weight is
    the larger of the two directions (equal up to round-off); with
    ``min_weight`` only edges above it are kept (D21)."""
    e = edges.select(F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst"),
                     F.col(weight).alias("weight"))
    e = e.where(F.col("src") != F.col("dst"))
    out = e.groupBy("src", "dst").agg(F.max("weight").alias("weight"))
    if min_weight is not None:
        out = out.where(F.col("weight") > F.lit(min_weight))
    return out


def pair_sample(vectors: DataFrame, n: int = 5, id_col: str = "vec_id",
                vec_col: str = "embedding") -> DataFrame:
    """Cosine of every pair among the first ``n`` rows by id."""
    head = (vectors.select(F.col(id_col).alias("id"), l2_normalize(vec_col).alias("v"))
            .orderBy("id").limit(n))
    a, b = head.alias("a"), head.alias("b")
    return (a.join(b, F.col("a.id") < F.col("b.id"))
            .select(F.col("a.id").alias("i"), F.col("b.id").alias("j"),
                    F.round(dot("a.v", "b.v"), 6).alias("sim")))


def align_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """1:1 equi-join that fails loudly when a key is missing on either side or
    occurs twice (J1, J8). The reference aligns by row position and asserts
    equal counts; here one full outer join of the key counts of both sides
    finds every fault."""
    def counted(df, name):
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    both = counted(left, "_l").join(counted(right, "_r"), key, "full")
    faults = both.agg(
        F.count_if(F.col("_l").isNull() | F.col("_r").isNull()).alias("missing"),
        F.count_if((F.coalesce("_l", F.lit(1)) > 1) | (F.coalesce("_r", F.lit(1)) > 1)).alias("twice")).first()
    if faults.missing or faults.twice:
        raise ValueError(f"'{key}': {faults.missing} keys have no partner, {faults.twice} occur more than once")
    return left.join(right, key, "inner")
