"""Profiling and quality checks (one pass each, no driver loops)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count per column: a single aggregate pass, then an unpivot of the
    one-row result into (column_name, null_count)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def max_length(df: DataFrame, col: str, alias: str = "max_len") -> DataFrame:
    """Longest string in a column, nulls ignored."""
    return df.agg(F.max(F.length(col)).alias(alias))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values including null."""
    return df.select(col).distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Keys occurring more than once (a primary-key check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose composite key is duplicated.

    A left-semi join on the key columns compared null-safely (rather than on
    a concatenated string, which turns nulls into '' and lets different pairs
    collide).
    """
    dup = duplicate_keys(df, keys).select(*keys)
    cond = [df[k].eqNullSafe(dup[k]) for k in keys]
    return df.join(dup, cond, "left_semi")
