"""Terms of blocks of rows, counted and weighted without a shuffle of occurrences.

Rows are dealt to blocks of a few MB by a hash of their key, the only shuffle of
the texts, their terms made before it. A block sends each of its terms once, with the number of its keys that
have it; the weights of the block's terms come back and meet its texts. Rows of one
key share a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 1 << 23  # characters of a block on average


def _parts(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def number_of_blocks(rows: DataFrame, chars: int) -> int:
    """Blocks of texts of ``chars`` characters in all."""
    return max(chars // BLOCK_CHARS, 2 * _parts(rows)) + 1


def block_of(key: list, blocks: int) -> F.Column:
    return F.pmod(F.xxhash64(*key), F.lit(blocks))


def placed(rows: DataFrame, key: list[str], terms: F.Column, chars: int) -> DataFrame:
    """``rows`` with their ``_block`` and ``_terms`` (joined by spaces); ``chars`` is
    the length of all texts."""
    return (rows.withColumn("_block", block_of(key, number_of_blocks(rows, chars))).withColumn("_terms", terms)
            .repartition(_parts(rows), "_block"))


def numbered_keys(t: pa.Table, key: list[str]) -> np.ndarray:
    """A number for every row, equal for equal keys (null equals null)."""
    at = np.zeros(t.num_rows, np.int64)
    for name in key:
        one = t.column(name).combine_chunks().dictionary_encode(null_encoding="encode")
        at = np.unique(at * (len(one.dictionary) + 1) + one.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return at


def occurrences(t: pa.Table, key: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Key number and term number of every occurrence, the terms, and the key numbers of the rows."""
    texts = t.column("_terms").combine_chunks()
    lists = pc.split_pattern(pc.if_else(pc.equal(texts, ""), pa.scalar(None, texts.type), texts), " ")
    lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
    words = lists.flatten().dictionary_encode()
    at = numbered_keys(t, key)
    return np.repeat(at, lengths), words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary, at


def block_counts(rows: DataFrame, key: list[str]) -> DataFrame:
    """``(_block, term, n)``: how many keys of the block have the term."""
    def run(t: pa.Table) -> pa.Table:
        at, code, words, _ = occurrences(t, key)
        width = max(len(words), 1)
        n = np.bincount(np.unique(at * width + code) % width, minlength=len(words))[:len(words)]
        block = pa.array(np.full(len(words), t.column("_block")[0].as_py(), np.int64))
        return pa.table({"_block": block, "term": words, "n": pa.array(n, pa.int64())})
    return rows.groupBy("_block").applyInArrow(run, "_block long, term string, n long")
