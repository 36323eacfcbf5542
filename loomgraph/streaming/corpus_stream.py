"""Structured Streaming for the stateless corpus steps.

The cleaning, filtering and sentence split are pure row transforms, so the
batch functions apply unchanged to a streaming DataFrame; new document files
dropped into a folder are cleaned and split as they arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomgraph.operators import sentences as st
from loomgraph.sources.tables import SCHEMAS


def read_documents_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 1,
                          file_glob: str = "documents*.parquet") -> DataFrame:
    """Streaming scan of the parquet document files of ``folder`` whose
    names match ``file_glob`` (declared schema)."""
    return (spark.readStream.schema(SCHEMAS["documents"])
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("pathGlobFilter", file_glob).parquet(folder))


def stream_sentences(docs: DataFrame) -> DataFrame:
    """T5 on a stream: ``(doc_id, pos, sentence)`` for every arriving document."""
    return st.corpus_sentences(docs.select("doc_id", "text"))


def start_sentence_sink(docs: DataFrame, out_path: str, checkpoint: str, trigger_once: bool = True):
    """Append the sentences of a document stream to a parquet folder.

    ``checkpoint`` must be a shared folder on a cluster (exactly-once file
    sink bookkeeping survives driver and executor restarts)."""
    w = (stream_sentences(docs).writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
