"""Language identification by compression.

Each language gets a raw-content zstandard dictionary made of a bounded
sample of its labelled texts. A text is compressed, whole, once with each
dictionary; the language whose dictionary gives the smallest output wins. The
margin to the second smallest output, as a share of the smallest, tells how
sure that is: below ``min_margin`` the answer is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN = "und"
#: ASCII marks and digits say nothing about the language: they become blanks.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 0x20 for b in range(256))


def plain(text: str) -> bytes:
    """Lower-case letters of a text, blanks collapsed."""
    return b" ".join(text.lower().encode().translate(LETTERS).split())


def fit(docs: DataFrame, learn: Column, docs_per_lang: int = 256, chars_per_doc: int = 1024,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, tuple[bytes, int]]:
    """Dictionary bytes and number of rows per language, over rows where
    ``learn`` holds.

    The sample is bounded: for each language the ``docs_per_lang`` rows of
    smallest id hash, ``chars_per_doc`` leading characters of each. Rows with
    a null language or no text teach nothing. The collected data are at most
    languages x docs_per_lang x chars_per_doc characters, whatever the size
    of the corpus. No row to learn from gives no language.
    """
    rows = (docs.where(learn & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
            .select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"),
                    F.substring(text_col, 1, chars_per_doc).alias("t")))
    w = W.partitionBy("lang").orderBy("h", "t")
    some = rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= docs_per_lang)
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    samples: dict[str, list[bytes]] = {}
    for lang, _, text in sorted(map(tuple, some.select("lang", "r", "t").collect())):
        samples.setdefault(lang, []).append(plain(text))
    return {lang: (b"\n".join(texts), counts[lang]) for lang, texts in samples.items()}


class Compressors:
    """One compressor per language. The length of naming the language itself
    (by its share of the rows) counts too; it decides between equal outputs."""

    def __init__(self, dictionaries: dict[str, tuple[bytes, int]], level: int = 6):
        import zstandard as zstd

        self.langs = sorted(dictionaries)
        total = sum(n for _, n in dictionaries.values())
        self.naming = np.array([np.log2(total / dictionaries[k][1]) / 8 for k in self.langs])
        self.of = []
        for lang in self.langs:
            content = zstd.ZstdCompressionDict(dictionaries[lang][0], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.of.append(zstd.ZstdCompressor(level=level, dict_data=content, write_checksum=False,
                                               write_content_size=False, write_dict_id=False))

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """Language, score in 0..1 and margin of a whole text."""
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        data = plain(text)
        size = np.array([len(c.compress(data)) for c in self.of], dtype=float) + self.naming
        best = int(size.argmin())  # of equal sizes the first language by name
        excess = size / size[best] - 1
        score = 1 / np.exp(-50 * excess).sum()
        margin = float(np.partition(excess, 1)[1]) if len(size) > 1 else 1.0
        return self.langs[best], float(score), margin


def identify(docs: DataFrame, dictionaries: dict[str, tuple[bytes, int]], min_margin: float = 0.005,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score, margin, rejected)`` per row.

    ``lang_pred`` is the nearest learned language even where the margin is
    narrow; ``rejected`` then says so, for callers that want no answer. Null
    texts, empty texts and texts without a letter give ``und``, score 0 and
    ``rejected``. Texts are compressed whole, however long. Ties go to the
    language first by name. Extra columns are ignored, repeated rows answered
    each, an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Compressors(dictionaries)
        for batch in batches:
            got = [by.classify(v.as_py()) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([g[0] for g in got], pa.string()),
                pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64()),
                pa.array([g[0] == UNKNOWN or g[2] < min_margin for g in got], pa.bool_())],
                ["id", "lang_pred", "score", "margin", "rejected"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    out = rows.mapInArrow(run, "id long, lang_pred string, score double, margin double, rejected boolean")
    return out.withColumnRenamed("id", id_col)
