"""Top-n and top-k-per-group.

``top_n`` plans as ``TakeOrderedAndProject`` (each task keeps n rows, the
driver merges n x tasks). ``top_k_per_group`` filters a rank-like window on
``<= k``; Catalyst turns that into a ``WindowGroupLimit`` that runs before
the shuffle, so even a group holding a third of all rows ships at most k rows
per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANKERS = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def top_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def rank_within(group_cols: Sequence[str], order: Sequence[Column | str],
                ranker: str = "row_number") -> Column:
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return _RANKERS[ranker]().over(w)


def top_k_per_group(df: DataFrame, group_cols: Sequence[str],
                    order: Sequence[Column | str], k: int = 1,
                    ranker: str = "row_number", rank_col: str = "rn",
                    keep_rank: bool = True) -> DataFrame:
    out = (df.withColumn(rank_col, rank_within(group_cols, order, ranker))
             .filter(F.col(rank_col) <= k))
    return out if keep_rank else out.drop(rank_col)
