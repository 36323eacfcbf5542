"""Scans of the input tables with explicit schemas.

Every reader names its columns so that Catalyst prunes the parquet scan to
what the caller projects (``ReadSchema`` in the plan) and pushes filters into
it. Small single-file inputs give a single input split; operators that do
heavy per-row work call :func:`spread` so the work fans out over the cluster
instead of running in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS: dict[str, T.StructType] = {
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]),
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()),
    ]),
    "pages": T.StructType([
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan with the declared schema (no inference, prunable)."""
    schema = SCHEMAS.get(name)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread ``df`` over the cluster when its scan yields too few splits.

    Used before CPU-heavy row work (regex on long texts, vector maths). A
    small single-file input gives one split, i.e. one task; it is then
    repartitioned over the shuffle partitions (by ``key`` when given, so a
    later aggregation or join on that key reuses the partitioning). An input
    that already has at least as many splits as the cluster has cores, as
    any large table does, is returned unchanged: no extra exchange.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if key is None:
        return df.repartition(n)
    return df.repartition(n, F.col(key))
