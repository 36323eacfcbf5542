"""Hand-checked text cases (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import text as tx

CASES = [
    # input, P1, P1 then P2, P4, P5
    ("He did n't go , she said .", "He didn't go, she said.", "He didnt go, she said.",
     "He did n't go , she said.", "He did n't go she said"),
    ("a - b", "a - b", "a  b", "a - b", "a - b"),
    ("wait . . .", "wait...", "wait...", "wait.", "wait"),
    ("x  .", "x .", "x .", "x .", "x"),
    ("Tab\there\xa0nbsp\x1cfs", "Tab\there\xa0nbsp\x1cfs", "Tab here nbsp fs", "Tab here nbsp fs",
     "Tab here nbsp fs"),
    ("café naïve #1 (ok) काम", "café naïve #1 (ok) काम", "café naïve 1 ok कम",
     "café naïve #1 (ok) काम", "café naïve #1 (ok) काम"),
    ("rock 'n' roll '90s", "rock'n' roll'90s", "rockn roll90s", "rock 'n' roll '90s", "rock 'n' roll '90s"),
    ("", "", "", "", ""),
]


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize("case", CASES)
def test_text_columns(spark, case):
    src, p1, p2, p4, p5 = case
    assert _one(spark, tx.english_fix, src) == p1
    assert _one(spark, lambda c: tx.clean_text(tx.english_fix(c)), src) == p2
    assert _one(spark, tx.summary_fix, src) == p4
    assert _one(spark, tx.node_text, src) == p5


def test_summary_fix_periods(spark):
    assert _one(spark, tx.summary_fix, "a ..  b ... c .") == "a. b. c."


def test_script_clean_devanagari(spark):
    assert _one(spark, tx.script_clean, "café naïve #1 (ok) काम") == "काम"


@pytest.mark.parametrize("text,keep", [
    ("one two three four", False), ("one two three four five", True),
    ("1 2 3 4 5", False), ("ab c 1 2 3", True), ("abc 1 2 3 4", False)])
def test_good_line(spark, text, keep):
    assert _one(spark, tx.good_line, text) is keep


@pytest.mark.parametrize("text,keep", [
    ("a b c d e f g", False), ("a b c d e f g h", True), ("abcd 1 2 3 4 5 6 7", False)])
def test_good_summary(spark, text, keep):
    assert _one(spark, tx.good_summary, text) is keep


def test_word_count_matches_python(spark):
    texts = ["", " a  b\tc\n", " x　y ", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["n"] for r in df.select(tx.word_count("t").alias("n")).collect()]
    assert got == [len(t.split()) for t in texts]
