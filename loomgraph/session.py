"""Session helpers: a tuned local session for tests/bench, and the
checkpoint-directory policy used by iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "loomgraph") -> SparkSession:
    """Local session with AQE on and the UI off (tests, bench, examples).

    On a cluster, build the session with the cluster's own settings; nothing
    in the library depends on this function.
    """
    master = master or os.environ.get("LOOMGRAPH_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LOOMGRAPH_DRIVER_MEM", "16g"))
        .config("spark.sql.ansi.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, reading it from the session.

    ``spark.checkpoint.dir`` names a shared folder on a cluster; it is used
    as is. Where it is unset, a single-JVM session (``local`` or
    ``local[n]``, as in tests) gets a fresh scratch folder; any session with
    executors of its own raises, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: operators that cut lineage need a "
                "shared checkpoint folder on a cluster")
        configured = tempfile.mkdtemp(prefix="loomgraph-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df, name: str = "t", codec: str | None = None, partition_by: str | None = None):
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Used instead of ``DataFrame.checkpoint()`` in iterative jobs: a
    checkpoint keeps the statistics of the plan it replaced, and in a loop
    of joins those estimates compound round after round (a size estimate
    with millions of digits after a dozen rounds makes planning itself the
    bottleneck). A re-read table has fresh statistics and no lineage, and it
    lives in the shared checkpoint folder, so lost executors re-read it. The
    table is deleted when the driver's JVM ends; :func:`release` drops it
    earlier. ``partition_by`` lays the table out by a column, which a filter on it
    prunes at the scan.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/loomgraph-tables/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    p, fs = _hadoop_path(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._loomgraph_path = path
    return out


def release(table) -> None:
    """Delete a table of :func:`materialize` that no later plan reads."""
    p, fs = _hadoop_path(table.sparkSession, table._loomgraph_path)
    fs.delete(p, True)


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())
