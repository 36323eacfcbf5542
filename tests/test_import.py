"""The package must import and list its queries without looking for files
beside the installed engine."""

import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[1])


def test_queries_load_without_engine_files():
    code = (
        "import glob, os, zipfile\n"
        "def refuse(*a, **k): raise AssertionError('file access at import')\n"
        "zipfile.ZipFile = refuse; glob.glob = refuse\n"
        "import __spark_entry__ as e\n"
        "q, o = e.queries(), e.oracle_sql()\n"
        "assert len(q) >= 65 and set(o) <= set(q), (len(q), set(o) - set(q))\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_stopword_list_is_the_engines(spark):
    from pyspark.ml.feature import StopWordsRemover

    from loomgraph.functions.stopwords import ENGLISH_STOPWORDS
    assert list(ENGLISH_STOPWORDS) == list(StopWordsRemover.loadDefaultStopWords("english"))
