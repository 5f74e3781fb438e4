"""Text compared without case, as the projects' hosts compare it.

``lower(col)`` on both sides answers one equality; a collated column carries
the comparison with it, through joins, grouping, distinct, ``in`` and patterns,
and keeps its own spelling. ``UTF8_LCASE`` compares the lower-case forms of
the bytes' characters, which is what the hosts do for these tables' text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLLATION = "UTF8_LCASE"


def ignoring_case(col: str | Column) -> Column:
    """``col`` as a column that compares without case."""
    return F.collate(F.col(col) if isinstance(col, str) else col, COLLATION)


def collated(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with these text columns (all of them by default) collated."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: ignoring_case(f"`{c}`") for c in names})


def plain(df: DataFrame) -> DataFrame:
    """``df`` with collated columns back to plain text, for sinks that take no other."""
    odd = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.dataType.collation != "UTF8_BINARY"]
    return df.withColumns({c: F.collate(F.col(f"`{c}`"), "UTF8_BINARY") for c in odd})


def group_ignoring_case(df: DataFrame, keys: Sequence[str], first_by: Sequence[str], *aggregates: Column) -> DataFrame:
    """Groups of ``keys`` compared without case, shown in the spelling of the
    group's first row by ``first_by`` (columns that tell rows apart)."""
    names = {k: f"__ci_{k}" for k in keys}
    order = F.struct(*first_by)
    grouped = df.withColumns({n: ignoring_case(k) for k, n in names.items()}).groupBy(*names.values()).agg(
        F.min_by(F.struct(*keys), order).alias("__first"), *aggregates)
    rest = [c for c in grouped.columns if c not in (*names.values(), "__first")]
    return grouped.select(*[F.col("__first")[k].alias(k) for k in keys], *rest)


def join_ignoring_case(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)`` with keys compared without case; the
    result has the left side's spelling (inner, left, semi and anti joins)."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("the left side's spelling is kept: inner, left, left_semi or left_anti")
    other = right.select(*[F.col(f"`{k}`").alias(f"__other_{k}") for k in keys], *[f"`{c}`" for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same &= ignoring_case(left[k]) == ignoring_case(other[f"__other_{k}"])
    return left.join(other, same, how).drop(*[f"__other_{k}" for k in keys])
