"""Same results for 1 and 8 shuffle partitions."""

import pytest

from loomgraph.plans import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["knn_edges", "tfidf_knn", "chunks_corpus", "community_order"])
def test_partition_count_does_not_change_results(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(map(tuple, QUERIES[name](spark, SF).collect())))
        assert out[0] == out[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
