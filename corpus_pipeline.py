"""Corpus pipeline: toxicity filter, exact dedup, near-duplicate join,
repeated passages, packing.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame`` and works on all rows
its predecessor kept; all but the last return the columns of ``documents``.
Decisions are about rows, not ids: of equal or linked rows one stays, the one
with the smallest id (null last), then the first in the table, also where an
id is repeated or null. Null or empty texts, ties and extra columns are treated
as the operators' docstrings state; an empty table passes through.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import exact_dedup as exact
from loomgraph.llm import jaccard_join as near
from loomgraph.llm import packing, substring_dedup, toxicity
from loomgraph.llm.queries import fold
from loomgraph.session import materialize, release


ROW = "_pipeline_row"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number that tells its rows apart: their place in the
    written files. A computed input is written first."""
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(ROW)
    try:
        return docs.select("*", place)
    except AnalysisException:
        return materialize(docs, "pipeline-rows").select("*", place)


def _among(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of the numbered ``docs`` whose id and number are in ``kept``."""
    same = F.col("doc_id").eqNullSafe(F.col(f"{ROW}_id")) & (F.col(ROW) == F.col(f"{ROW}_no"))
    return docs.join(kept.toDF(f"{ROW}_id", f"{ROW}_no"), same, "left_semi").drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose CRF score is below 0.5. Trained on a bounded sample of
    the labelled documents outside fold 0 of 5."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.reject(docs, toxicity.train(*toxicity.sample(docs, labels, fold(5) != 0)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the smallest id."""
    rows = _numbered(docs)
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW).alias("key")
    found = exact.exact_dedup(rows.select(key, "text"), id_col="key").where("kept")
    return _among(rows, found.select("key.doc_id", f"key.{ROW}"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents linked by five-word shingles at a
    similarity of 0.75 or more, that of the smallest id; rows without words stay."""
    rows = _numbered(docs)
    found = near.jaccard_components(rows, words=5, percent=75, row_col=ROW).where("kept")
    return _among(rows, found.select("doc_id", ROW))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words of 20-word windows that also start
    earlier in the corpus; ``n_chars`` follows the text."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = substring_dedup.substring_dedup(docs, window=20, carry=rest, as_written=True)
    if "n_chars" in rest:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of sequences of 2048 along the Hilbert curve."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, length=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_passages),
    ("packing", pack),
]

#: SQL cannot express the trained tagger, so there is none; tests/llm compares
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written in the shared
    checkpoint folder and read again, and its input is then released."""
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
