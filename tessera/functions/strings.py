"""String helpers: list columns, null-tolerant concatenation, name cleanup."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_list(col: Column | str, sep: str = ",") -> Column:
    """Split a delimited string into an array, keeping empty tokens.

    ``limit=-1`` keeps trailing empty strings, as a table-valued string split
    does; a null input stays null (and explodes to no rows).
    """
    return F.split(F.col(col) if isinstance(col, str) else col, re.escape(sep), -1)


def split_trimmed(col: Column | str, sep: str = ",") -> Column:
    """``split_list`` with the blanks around every item removed."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(F.trim(c), f" *{re.escape(sep)} *", -1)


def concat_null_as_empty(*cols: Column | str) -> Column:
    """Concatenate treating null as the empty string (T-SQL ``concat``)."""
    return F.concat_ws("", *[F.col(c) if isinstance(c, str) else c for c in cols])


def strip_to_int(col: Column | str, suffix: str) -> Column:
    """``'90 min'`` -> 90; anything unparsable -> null (ANSI-safe)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(c, F.lit(suffix), F.lit("")).try_cast("int")


def normalise_name(name: str) -> str:
    """Lower-case a header and turn blanks into underscores."""
    return name.lower().replace(" ", "_")


def normalise_column_names(df: DataFrame) -> DataFrame:
    """``Ship Mode`` -> ``ship_mode`` for every column (metadata-only)."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def ci_equals(col: Column | str, literal: str) -> Column:
    """Case-insensitive equality, for literals written against a
    case-insensitive collation."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(c) == literal.lower()
