"""Row numbers and ranks within keys that may hold a third of all rows.

A window sorts all rows of a key in one task. Here rows are dealt by ranges of
(key, order, a hash of the row) instead, so a hot key, and even a hot tie
within it, spreads over many slices; slices are numbered on their own and put
together by offsets:

* rows of the key in earlier slices, for ``row_number`` and ``rank``;
* for a tie that goes on from an earlier slice, the rank at which it began,
  carried over any number of slices that hold nothing else;
* distinct order values of earlier slices, less those that go on, for
  ``dense_rank``.

Only a key that crosses a slice border needs offsets, and a border is crossed
by one key, so there are at most two of them per slice: they are broadcast
whatever the size of the tables. The sliced rows are written to the shared
folder once, because Spark samples the ranges anew for every job.

Nulls in keys are a key of their own and nulls in the order sort as Spark
sorts them (first when ascending, last when descending). Rows that are equal
in every column share a slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written_once


def _sort(order: str) -> tuple[str, Column]:
    """``"col"`` or ``"col desc"``."""
    name, _, direction = order.partition(" ")
    if direction not in ("", "asc", "desc"):
        raise ValueError(f"order {order!r} is neither 'column' nor 'column desc'")
    return name, F.desc(name) if direction == "desc" else F.asc(name)


def sliced_ranks(df: DataFrame, keys: Sequence[str], order: Sequence[str], tie_break: Sequence[str] = (),
                 row_number: str | None = "rn", rank: str | None = None, dense_rank: str | None = None,
                 slices: int | None = None) -> DataFrame:
    """``df`` plus ``row_number`` (by order, then tie_break), ``rank`` and
    ``dense_rank`` (by order) within ``keys``: equal to the window functions
    on all rows. ``slices``: tasks to deal the rows to."""
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [_sort(o) for o in order]
    names, sorts = [x[0] for x in by], [x[1] for x in by]
    ties = [_sort(o)[1] for o in tie_break]
    dealt = (df.withColumn("__tie", F.xxhash64(*df.columns))
             .repartitionByRange(n, *keys, *sorts, *ties, "__tie").withColumn("__slice", F.spark_partition_id()))
    own = Window.partitionBy("__slice", *keys)
    by_value, by_row = own.orderBy(*sorts), own.orderBy(*sorts, *ties, "__tie")
    numbered = written_once(dealt.select(
        *df.columns, "__slice", F.row_number().over(by_row).cast("long").alias("__rn"),
        F.rank().over(by_value).cast("long").alias("__rank"),
        F.dense_rank().over(by_value).cast("long").alias("__dense")), "sliced-ranks")

    value = F.struct(*names)
    slices_of_key = Window.partitionBy(*keys).orderBy("__slice")
    earlier = slices_of_key.rowsBetween(Window.unboundedPreceding, -1)
    summary = (numbered.groupBy("__slice", *keys).agg(
        F.max("__rn").alias("__n"), F.max("__rank").alias("__tail"), F.max("__dense").alias("__distinct"),
        F.min_by(value, "__rn").alias("__first"), F.max_by(value, "__rn").alias("__last"))
        .withColumn("__parts", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where(F.col("__parts") > 1)
        .withColumn("__on", (F.row_number().over(slices_of_key) > 1)
                    & F.lag("__last").over(slices_of_key).eqNullSafe(F.col("__first")))
        .withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))))
    # where the last tie of a slice began; unknown if the slice is all one tie that came from before
    began = F.when((F.col("__tail") > 1) | ~F.col("__on"), F.col("__before") + F.col("__tail"))
    goes_on = F.col("__on").cast("long")
    offsets = (summary.withColumn("__began", began).select(
        "__slice", *[F.col(k).alias(f"__key_{k}") for k in keys], "__on", "__before",
        F.last("__began", ignorenulls=True).over(earlier).alias("__carried"),
        (F.coalesce(F.sum(F.col("__distinct") - goes_on).over(earlier), F.lit(0)) - goes_on).alias("__before_distinct")))

    o = offsets.withColumnRenamed("__slice", "__of")
    match = F.col("__slice") == F.col("__of")
    for k in keys:
        match &= F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    joined = numbered.join(F.broadcast(o), match, "left")  # at most two rows per slice
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = []
    if row_number:
        out.append((F.col("__rn") + zero("__before")).alias(row_number))
    if rank:
        out.append(F.when(F.coalesce("__on", F.lit(False)) & (F.col("__rank") == 1), F.col("__carried"))
                   .otherwise(F.col("__rank") + zero("__before")).alias(rank))
    if dense_rank:
        out.append((F.col("__dense") + zero("__before_distinct")).alias(dense_rank))
    return joined.select(*df.columns, *out)
