"""Dense text vectors (E1): hashed term frequencies, weighted and normalised.

The space has ``dim`` hashed terms, so vectors of any corpus have one fixed
width and no vocabulary is kept; terms that share a cell add up. Document
frequencies are summed by a tree of partial sums of ``dim`` counts.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.tfidf import terms


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col), terms(F.coalesce(F.col(text_col), F.lit(""))).alias("_terms"))


def fit(df: DataFrame, id_col: str, text_col: str, dim: int = 256) -> PipelineModel | None:
    """The weights of ``text_col`` in ``dim`` cells; none of an empty table."""
    rows = _rows(df, id_col, text_col)
    if rows.isEmpty():
        return None
    return Pipeline(stages=[HashingTF(numFeatures=dim, inputCol="_terms", outputCol="_tf"),
                            IDF(inputCol="_tf", outputCol="_weighted"),
                            Normalizer(p=2.0, inputCol="_weighted", outputCol="_unit")]).fit(rows)


def transform(df: DataFrame, model: PipelineModel | None, id_col: str, text_col: str) -> DataFrame:
    """``(id, embedding array<double>)`` of unit length, one row per row of
    ``df``: texts that the model was fitted on, or others (queries) in the same
    space. Null, empty and weightless texts get the zero vector."""
    if model is None:
        return df.select(id_col, F.array().cast("array<double>").alias("embedding"))
    out = model.transform(_rows(df, id_col, text_col))
    return out.select(id_col, vector_to_array("_unit").alias("embedding"))
