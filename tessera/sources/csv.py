"""Delimited text input with an explicit schema and several null tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.strings import normalise_name


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             null_tokens: Sequence[str] = (), normalise_names: bool = False,
             multiline: bool = True) -> DataFrame:
    """CSV with a header.

    Spark's ``nullValue`` takes one token only, so every column is read as
    text, any of ``null_tokens`` becomes null, and only then is each column
    cast to its schema type with ``try_cast`` (bad cells -> null, never a
    failed job). ``schema`` is matched to headers by position; with
    ``normalise_names`` the headers are also lower-cased with blanks turned
    into underscores (``Ship Mode`` -> ``ship_mode``).

    ``multiline=True`` allows quoted fields with line breaks (free-text
    descriptions), but Spark cannot split such a file: each file is one
    task, so large inputs should come as many files. Pass
    ``multiline=False`` for one-record-per-line files, which split freely.
    """
    raw = (spark.read.option("header", True).option("multiLine", multiline)
                .option("escape", '"').option("mode", "PERMISSIVE"))
    if schema is not None:
        raw = raw.schema(StructType([StructField(f.name, StringType(), True)
                                     for f in schema.fields]))
    df = raw.csv(path)
    if schema is None and normalise_names:
        df = df.toDF(*[normalise_name(c) for c in df.columns])
    tokens = list(null_tokens)
    cols = []
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`")
        if tokens:
            v = F.when(~v.isin(tokens), v)
        if schema is not None and not isinstance(schema.fields[i].dataType, StringType):
            v = v.try_cast(schema.fields[i].dataType)
        name = normalise_name(c) if normalise_names else c
        cols.append(v.alias(name))
    return df.select(*cols)
