"""Stage tables shared inside one query.

A query such as ``answer`` needs the cleaned corpus three times (TF-IDF
space, graph nodes, sentences). Each stage is computed once per query and
written as a table in the checkpoint folder (like the reference's
intermediate files), instead of re-running the regex cleaning per use.
The cache is cleared when a registered query starts, so every query still
computes everything from the base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.operators import sentences as st
from loomgraph.session import materialize
from loomgraph.sources.tables import read_table, spread

_CACHE: dict = {}


def clear() -> None:
    _CACHE.clear()


def cached(name: str, spark: SparkSession, sf_dir: str, build):
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def good_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned documents that pass F1: ``(doc_id, text)``."""
    def build():
        d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
        return materialize(st.good_documents(d), "good_docs", codec="zstd")
    return cached("good_docs", spark, sf_dir, build)


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept sentences of the good documents: ``(doc_id, pos, sentence)``."""
    def build():
        return materialize(st.split_sentences(good_docs(spark, sf_dir)), "sentences", codec="zstd")
    return cached("sentences", spark, sf_dir, build)
