"""Multi-valued string columns -> bridge tables (one row per list item)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import split_list


def bridge(df: DataFrame, id_col: str, list_col: str, out_col: str | None = None,
           sep: str = ",", trim: bool = True) -> DataFrame:
    """(id, item) for every item of a delimited list.

    Empty items are kept (a table-valued split keeps them); null lists give
    no rows. Only the id and the list column are read, so the explode runs
    after column pruning.
    """
    out_col = out_col or list_col
    item = F.col("_item")
    return (df.select(id_col, F.explode(split_list(list_col, sep)).alias("_item"))
              .select(id_col, (F.trim(item) if trim else item).alias(out_col)))
