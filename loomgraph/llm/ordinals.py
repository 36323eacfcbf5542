"""Positions of rows in a global order, without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.session import materialize


def with_ordinal(df: DataFrame, group: list[str], order: list, name: str) -> DataFrame:
    """``df`` with ``ordinal``, the 0-based position by ``order`` inside its
    ``group`` (columns; null is a group, no columns mean the whole table).

    Rows are range-sorted into a written table, in which every row knows its
    partition and its place there; a group's rows in one partition are
    consecutive, so an offset per (partition, group) is all that is added. The
    window below sees one row per partition of a group. Rows equal in group and
    order get consecutive positions that stay fixed with the written table.
    """
    keys = [F.col(c).asc_nulls_first() for c in group] + list(order)
    placed = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("_at", F.monotonically_increasing_id())
                         .withColumn("_p", F.shiftright("_at", 33).cast("int")), name)
    runs = placed.groupBy("_p", *group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(F.col("_p").alias("_rp"), *[F.col(c).alias(f"_r_{c}") for c in group],
                       (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = F.col("_p") == F.col("_rp")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return (placed.join(runs, same).withColumn("ordinal", F.col("_at") + F.col("_shift"))
            .drop("_at", "_p", "_rp", "_shift", *[f"_r_{c}" for c in group]))
