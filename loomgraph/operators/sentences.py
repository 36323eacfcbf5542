"""Corpus cleaning and sentence splitting (T5: S1 -> P1 -> P2 -> F1 -> G1).

The reference flattens the corpus into a Python list and loses the row id;
here every row keeps ``doc_id`` and every sentence ``(doc_id, pos)`` so
later stages can order, join and aggregate by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text as tx


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """P1 then P2 on every document; nulls become ``''``. ``(doc_id, text)``."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), tx.clean_text(tx.english_fix(t)).alias("text"))


def keep_rows(df: DataFrame, predicate) -> DataFrame:
    """``df.where(predicate(row))`` evaluated once per row.

    Catalyst pushes a filter below the projection that computes its input
    and substitutes the expression for every reference, so a predicate
    reading a cleaned text three times would clean it three more times
    (filters get no common-subexpression elimination). Wrapping the row in
    a one-element array and filtering it with a lambda binds the computed
    row to one variable; ``inline`` then emits the rows that pass.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.inline(F.filter(F.array(row), predicate)))


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cleaned documents that pass F1 (the article-level filter)."""
    clean = clean_documents(docs, id_col, text_col)
    return keep_rows(clean, lambda r: tx.good_line(r["text"], stripped=True))


def sentence_pieces(clean: DataFrame) -> DataFrame:
    """Every split piece with its position: ``(doc_id, pos, piece)`` (G1)."""
    return clean.select("doc_id", F.posexplode(tx.sentence_split("text")).alias("pos", "piece"))


def split_sentences(clean: DataFrame, min_words: int = 5, min_ratio: float = 0.3) -> DataFrame:
    """Stripped, non-blank pieces that pass F1: ``(doc_id, pos, sentence)``.

    ``pos`` is the piece's position in its document before filtering, so
    (doc_id, pos) is a stable sentence key. The second split of the
    reference (G2) is a no-op for a rule splitter and is not repeated.
    Pieces are stripped and tested inside one array expression per
    document, so each piece is stripped once.
    """
    pieces = F.transform(tx.sentence_split("text"),
                         lambda p, i: F.struct(i.cast("long").alias("pos"), tx.strip(p).alias("sentence")))
    kept = F.filter(pieces, lambda r: (r["sentence"] != F.lit(""))
                    & tx.good_line(r["sentence"], min_words, min_ratio, stripped=True))
    return clean.select("doc_id", F.inline(kept))


def corpus_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """T5 end to end: clean, keep good articles, split, keep good sentences."""
    return split_sentences(good_documents(docs, id_col, text_col))
