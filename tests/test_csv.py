"""CSV round trip of awkward texts, declared schema, corrupt rows, foreign files."""

from loomgraph.sources.csv import CORRUPT, read_csv, write_csv

TEXTS = ["a", "", None, "c", "x, y", 'say "hi"', '""', '"', "line\nbreak", "cr\r\nlf", "back\\slash", "\\N", "\\\\N", "\\", " lead and trail ",
         "café काम", "\t", "N", ",", "\n", "'"]


def test_round_trip(spark, tmp_path):
    rows = list(enumerate(TEXTS)) + [(None, "no id")]
    write_csv(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), str(tmp_path / "t"))
    back = read_csv(spark, str(tmp_path / "t"), "doc_id long, text string")
    got = back.collect()
    assert {(r.doc_id, r.text) for r in got} == set(rows) and len(got) == len(rows)
    assert all(r[CORRUPT] is None for r in got)


def test_corrupt_rows_are_kept(spark, tmp_path):
    (tmp_path / "c.csv").write_text('doc_id,text\n1,"fine"\nx,"no number"\n3,\n')
    rows = {r.text: (r.doc_id, r[CORRUPT]) for r in read_csv(spark, str(tmp_path / "c.csv"), "doc_id long, text string", marked=False).collect()}
    assert rows["fine"] == (1, None) and rows[""] == (3, None)
    assert rows["no number"][0] is None and "x," in rows["no number"][1]


def test_empty_table(spark, tmp_path):
    write_csv(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "e"))
    assert read_csv(spark, str(tmp_path / "e"), "doc_id long, text string").collect() == []
