"""Driver contract and streaming smoke test."""

import tempfile

import __spark_entry__ as ent


def test_every_oracle_has_a_query():
    qs, sql = ent.queries(), ent.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 63


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.columns == ["query", "answer"]
    assert df.count() >= 0


def test_stream_sentences_matches_batch(spark):
    from loomgraph.operators import sentences as st
    from loomgraph.streaming import corpus_stream as cs
    out = tempfile.mkdtemp(prefix="lg-stream-out-", dir="/tmp")
    ck = tempfile.mkdtemp(prefix="lg-stream-ck-", dir="/tmp")
    q = cs.start_sentence_sink(cs.read_documents_stream(spark, "/root/testdata/sf0.001"), out, ck)
    q.awaitTermination(300)
    streamed = spark.read.parquet(out)
    batch = st.corpus_sentences(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
