"""CSV in and out with a declared schema.

Texts hold commas, quotes, line breaks and backslashes, so every string is quoted,
quotes are doubled, and nothing else is an escape. A null is written as a mark
that no text gets: texts that begin with backslashes before an ``N`` are
written with one backslash more. So null, empty and any other text come back
as they were. Files are read whole by a task each (a quoted line break hides
where rows begin): write as many files as the readers need tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL = r"\N"  # fixed value: the usual mark of a null in delimited files
CORRUPT = "_corrupt_record"


def _strings(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                       for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """``df`` (columns of plain types) as CSV files in the folder ``path``."""
    def marked(c: Column) -> Column:
        return F.when(c.isNull(), F.lit(NULL)).otherwise(F.regexp_replace(c, r"^(\\+N)$", r"\\$1"))
    (_strings(df, marked).write.mode("overwrite").option("header", header).option("quoteAll", True)
     .option("escape", '"').option("emptyValue", "").option("nullValue", NULL)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True, marked: bool = True) -> DataFrame:
    """Rows of CSV files by a declared schema (nothing is inferred), with the
    column ``_corrupt_record``: the text of a row that does not fit, else null.

    ``marked`` reads what :func:`write_csv` wrote. Files of other programs,
    where an empty field may be a null or an empty text, are read with
    ``marked=False``: both come as an empty text."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.schema(wanted).option("header", header).option("multiLine", True).option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("emptyValue", "").option("nullValue", NULL if marked else "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    plain = rows.drop(CORRUPT)
    change = (lambda c: F.regexp_replace(c, r"^\\(\\+N)$", "$1")) if marked else (lambda c: F.coalesce(c, F.lit("")))
    return rows.select(*[change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                         for f in plain.schema.fields], CORRUPT)
