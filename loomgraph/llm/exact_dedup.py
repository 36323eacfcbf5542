"""Exact duplicate removal by progressive refinement.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` is
replaced by one space. Three rounds of narrower groups:

1. length of the normalised text; rows alone with their length are done;
2. hash of the first ``prefix_chars`` characters among rows that share a
   length; rows alone with (length, prefix) are done;
3. SHA-256 of the whole normalised text, computed only for the survivors.

Rounds 1 and 2 move ``(id, length, hash)`` only; the surviving groups are written,
and the second pass over the texts keeps the rows that belong to one before it
hashes them. Every group is reduced by a partially aggregated ``groupBy`` and
joined back, so a group of copies that holds a third of all rows is one
aggregated row; the join back is a plain shuffled join that adaptive execution
may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.session import materialize

BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """``text`` (null: empty) with each run of blanks as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 64, digest: bool = False) -> DataFrame:
    """``(id, keep_id, group_size, kept[, text_sha256])``, one row per input row.

    ``keep_id`` is the smallest id of the rows with an equal text, and
    ``kept`` says that the row carries it. A null text counts as empty and
    an empty text equals any other empty text. A null id sorts after every
    other id, so such a row stays only when all rows of its text have null
    ids. Rows repeated with the same id and text all count in ``group_size``;
    all of those that carry the smallest id are marked kept. Other columns of
    ``docs`` are ignored, whatever their names; an empty table gives no rows.
    ``digest`` adds the lowercase hex SHA-256 of every normalised text.
    """
    norm = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("_id"), norm.alias("_t"))
    rows = rows.withColumns({"_len": F.octet_length("_t").cast("long"),
                             "_pre": F.xxhash64(F.substring("_t", 1, prefix_chars))})
    narrow = ["_id", "_len", "_pre"]
    # where every digest is asked for, the one pass over the texts makes it, too
    keys = materialize(rows.select(*narrow, *([F.sha2("_t", 256).alias("_sha")] if digest else [])), "dedup-keys")

    lengths = keys.groupBy("_len").count().where("count > 1").select("_len")
    same_len = keys.select("_len", "_pre").join(lengths, "_len")
    again = materialize(same_len.groupBy("_len", "_pre").count().where("count > 1").select("_len", "_pre"), "dedup-groups")
    if digest:
        full = keys.join(again, ["_len", "_pre"], "left_semi").select("_id", "_sha")
    else:
        full = materialize(rows.join(again, ["_len", "_pre"], "left_semi")
                           .select("_id", F.sha2("_t", 256).alias("_sha")), "dedup-hashes")

    groups = full.groupBy("_sha").agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    again_rows = full.join(groups, "_sha").withColumnRenamed("_sha", "text_sha256")
    alone = (keys.join(again, ["_len", "_pre"], "left_anti")
             .withColumn("keep_id", F.col("_id")).withColumn("group_size", F.lit(1).cast("long")))
    if digest:
        alone = alone.withColumnRenamed("_sha", "text_sha256")
    cols = [F.col("_id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
            F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            *(["text_sha256"] if digest else [])]
    return again_rows.select(*cols).unionByName(alone.select(*cols))
