"""Exact distinct counts that merge: bitmaps of dense ids.

``count(distinct)`` over several columns multiplies the rows (``Expand``) and
cannot be put together from parts. Here values get dense numbers once, every
group sets the bits of the values it holds, and bits merge by ``or``: over
files, days or coarser groups, without seeing the rows again. A group's bitmap
comes in pieces of 32,768 numbers (4 KB), so rows of a hot group combine in
every task before the shuffle and no task holds a group's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import running_totals


def dense_ids(df: DataFrame, column: str, id_col: str = "dense_id") -> DataFrame:
    """(column, id_col): the distinct non-null values, numbered from 1 in
    their order without gaps."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("__one", F.lit(1).cast("long"))
    return running_totals(values, [column], "__one", "__before").select(column, (F.col("__before") + 1).cast("long").alias(id_col))


def distinct_bitmaps(df: DataFrame, groups: Sequence[str], id_col: str = "dense_id") -> DataFrame:
    """(groups..., piece, bits): which ids each group holds. Rows without an
    id set no bit."""
    return (df.where(F.col(id_col).isNotNull())
            .groupBy(*groups, F.bitmap_bucket_number(id_col).alias("piece"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bits")))


def merge_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser ``groups``, or of the same groups from several parts."""
    return bitmaps.groupBy(*groups, "piece").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, groups: Sequence[str], count_col: str = "n_distinct") -> DataFrame:
    """Distinct ids per group, of bitmaps merged to ``groups``."""
    return bitmaps.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(count_col))
