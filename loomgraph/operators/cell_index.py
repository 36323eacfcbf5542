"""A vector index in cells, for search in tables too large to scan.

A k-means quantiser, fitted on a bounded sample, gives every vector the cell of
its nearest centre. The index is a table laid out by cell, and each cell is cut
into parts of bounded size, so a cell that holds a third of all rows is many
parts. A search sends a query to its ``probes`` nearest cells; the cells that
any query probes are a filter on the layout column, so the others are never
read. Queries and a part meet in one task, in blocks, by a matrix product that
keeps the ``k`` best per query.

All rows are in the index and ``probes = cells`` is the exact search; fewer
probes read about ``probes / cells`` of the table for a query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.session import materialize

SAMPLE = 100_000  # rows the quantiser is fitted on, at most
PART = 4_096      # index rows, and queries, that meet in one task


@dataclass
class CellIndex:
    rows: DataFrame      # (id, v, part, cell), laid out by cell
    parts: DataFrame     # (cell, parts)
    centres: np.ndarray  # cells x dimensions


def valid(v):
    """Vectors without nulls and non-finite components."""
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def build(vectors: DataFrame, cells: int, id_col: str = "id", vec_col: str = "v", seed: int = 1) -> CellIndex:
    """Index of all valid rows. The centres (``cells`` times the dimension) are
    the only thing held by the driver and sent to every task."""
    rows = vectors.where(valid(F.col(vec_col))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("v"))
    n = rows.count()
    if not n:
        empty = rows.select("id", "v", F.lit(0).alias("part"), F.lit(0).alias("cell"))
        return CellIndex(empty, empty.select("cell", F.lit(1).alias("parts")), np.zeros((0, 0)))
    some = rows if n <= SAMPLE else rows.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)) < SAMPLE)
    model = KMeans(k=cells, seed=seed, maxIter=10, initSteps=2).fit(some.select(array_to_vector("v").alias("features")))
    centres = np.array(model.clusterCenters())
    placed = materialize(rows.withColumn("cell", nearest_cells(centres, 1)(F.col("v"))[0]), "index-cells")
    sizes = materialize(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")), "index-sizes")
    laid = (placed.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
            .select("id", "v", "part", "cell"))
    return CellIndex(materialize(laid.repartition("cell", "part"), "index", partition_by="cell"), sizes, centres)


def nearest_cells(centres: np.ndarray, probes: int):
    """Column function: the ``probes`` nearest cells of a vector, nearest first."""
    half = (centres * centres).sum(axis=1) / 2

    @F.pandas_udf("array<int>")
    def run(v: pd.Series) -> pd.Series:
        far = half[None, :] - np.stack(v.to_numpy()) @ centres.T if len(v) else np.zeros((0, len(half)))
        return pd.Series(list(np.argsort(far, axis=1, kind="stable")[:, :probes].astype(np.int32)))
    return run


def search(index: CellIndex, queries: DataFrame, k: int, probes: int, id_col: str = "id", vec_col: str = "v",
           exclude_self: bool = False) -> DataFrame:
    """``(query, id, dist, rank)``: for each query the ``k`` nearest rows, by
    squared L2 distance rounded to 6 places, among those of its ``probes``
    nearest cells; ties go to the smaller id. Queries that are not valid vectors
    have no rows; a query id should occur once."""
    asked = queries.where(valid(F.col(vec_col))).select(
        F.col(id_col).cast("long").alias("query"), F.transform(vec_col, lambda x: x.cast("double")).alias("q"))
    if not len(index.centres):
        return asked.select("query", F.lit(0).cast("long").alias("id"), F.lit(0.0).alias("dist"), F.lit(0).alias("rank")).limit(0)
    asked = materialize(asked.withColumn("cell", F.explode(nearest_cells(index.centres, probes)(F.col("q")))), "index-asked")
    cells = [r.cell for r in asked.select("cell").distinct().collect()]  # at most all cells
    blocks = max(1, -(-asked.select("query").distinct().count() // PART))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    left = (asked.join(index.parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("block", block))
    right = (index.rows.where(F.col("cell").isin(cells)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        names, ids = a.column("query").to_numpy(), b.column("id").to_numpy()
        out = []
        if len(names) and len(ids):
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            q = a.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(names), -1)
            v = b.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[order]
            far = (q * q).sum(axis=1)[:, None] + (v * v).sum(axis=1)[None, :] - 2 * (q @ v.T)
            slack = 2e-6 + 1e-12 * max((q * q).sum(axis=1).max(), (v * v).sum(axis=1).max())
            for i, name in enumerate(names):
                d = np.where(ids == name, np.inf, far[i]) if exclude_self else far[i]
                # everything that rounding may tie with the k-th, scored without the expansion's error
                near = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1] + slack)
                exact = np.round(((v[near] - q[i]) ** 2).sum(axis=1), 6)
                for j in np.argsort(exact, kind="stable")[:k]:
                    if np.isfinite(d[near[j]]):
                        out.append((name, ids[near[j]], exact[j]))
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                        ["query", "id", "dist"])

    key = ["cell", "part", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, "query long, id long, dist double")
    best = Window.partitionBy("query").orderBy("dist", "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
