"""The whole text of a group is put together from parts, a partition of groups at a time."""

from pyspark.sql import functions as F

from loomgraph.operators import condense as cd


def test_groups_arrive_as_few_long_texts(spark):
    """Before, the last step collected every row of a group at once, and small groups' partitions were joined."""
    rows = [(g, d, p, f"s{g} {d} {p} " + "w " * (p % 7), float((d * 7 + p) % 5)) for g in ("a", "b") for d in range(60) for p in range(50)]
    rows += [("c", 0, 0, "one two", 1.0), ("d", 0, 0, "", 0.0)]
    frame = (spark.createDataFrame(rows, "community string, doc_id long, pos long, sentence string, score double")
             .withColumn("o", F.struct("doc_id", "pos")))
    out = cd.tree_reduce(frame.select("community", "o", "sentence", "score"), "community", "o", "sentence", 5)
    assert out._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 1
    got = {r.community: (r.summary, r.rounds) for r in out.collect()}
    assert set(got) == {"a", "b", "c"} and got["c"][0] == "one two" and len({n for _, n in got.values()}) == 1
    for g in "ab":  # the target is over 5 words, so no word is lost, and the order of the sentences is kept
        assert got[g][0].split() == " ".join(r[3] for r in rows if r[0] == g).split()
    assert out.schema["rounds"].dataType.simpleString() == "int"
