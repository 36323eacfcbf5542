"""Embedding table operators: statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.vectors import as_double, sum_array


def embedding_stats(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Shape, min, max and mean over all vector components.

    Reduced per row first (array min/max/sum), then one global aggregate,
    so no row is exploded into components.
    """
    v = as_double(vec_col)
    per_row = vectors.select(F.size(vec_col).alias("d"), F.array_min(v).alias("lo"),
                             F.array_max(v).alias("hi"), sum_array(v).alias("s"))
    return per_row.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("d").cast("long").alias("dim"),
        F.round(F.min("lo"), 6).alias("min_value"),
        F.round(F.max("hi"), 6).alias("max_value"),
        F.round(F.sum("s") / F.sum("d"), 6).alias("mean_value"),
    )
