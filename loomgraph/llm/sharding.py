"""Contiguous shards of nearly equal bytes from global prefix sums.

Rows are range-sorted by id into a written table that carries the partition
number; a running sum inside each partition plus the prefix sum of the
per-partition totals (one row per partition) gives every row its global byte
offset. Shard ``k`` takes the rows whose midpoint lies in the ``k``-th of
``shards`` equal parts of the total, so each shard is a contiguous id range
and differs from the target by at most one row at each end. The slots inside
a shard come from the same prefix sums over row counts. DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.session import materialize


def byte_shards(docs: DataFrame, shards: int = 40, overhead: int = 16,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, text_crc32, law, shard, slot, grown_shard)`` per row.

    ``size`` is the UTF-8 length of the text (null: 0) plus ``overhead``;
    ``law`` is ``bytes``; ``grown_shard`` is null (only a key law has one).
    Rows of equal ids, null ids (first) and repeated rows keep their own
    slots; which of fully equal rows gets which slot does not matter, as they
    cannot be told apart. Extra columns are ignored; no rows give no rows;
    with fewer rows than shards some shards stay empty. One row larger than
    the target fills its shard alone or nearly so: rows are never cut.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"),
                       (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    order = ["_id", "size", "text_crc32"]
    rows = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("_p", F.spark_partition_id()), "shard-sizes")

    # one row per partition: the unpartitioned window below sees only those
    totals = rows.groupBy("_p").agg(F.sum("size").alias("_b"), F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    base = totals.select(
        "_p", F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b0"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.sum("_b").over(whole).alias("_total"))

    inside = W.partitionBy("_p").orderBy(*order)
    placed = (rows.withColumn("_run", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)))
              .withColumn("_rn", F.row_number().over(inside))
              .join(F.broadcast(base), "_p")
              .withColumn("_mid2", 2 * (F.col("_b0") + F.col("_run")) - F.col("size"))
              .withColumn("shard", F.least(F.lit(shards - 1),
                                           F.expr(f"_mid2 * {shards} div (2 * _total)").cast("int")))
              .withColumn("_row", F.col("_n0") + F.col("_rn") - 1))
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
