"""Running totals without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written_once

GROUP = 1024


def totals_before(df: DataFrame, order: str, value: str, out: str, group: int = GROUP) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` over all rows whose ``order``
    (a non-negative integer, unique) is smaller.

    Two levels: prefix sums within groups of ``group`` consecutive numbers, and
    over the groups' totals, so the only window without a partition sees one
    row per group.
    """
    bucket = F.floor(F.col(order) / group)
    within = (Window.partitionBy("__bucket").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    over = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("__bucket", bucket)
    starts = (rows.groupBy("__bucket").agg(F.sum(value).alias("__total"))
              .select("__bucket", F.coalesce(F.sum("__total").over(over), F.lit(0)).alias("__start")))
    inner = F.coalesce(F.sum(value).over(within), F.lit(0))
    return (rows.withColumn("__inner", inner).join(starts, "__bucket")
            .withColumn(out, (F.col("__start") + F.col("__inner")).cast("long"))
            .drop("__bucket", "__inner", "__start"))


def running_totals(df: DataFrame, order: Sequence[str], value: str, out: str, slices: int | None = None) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` over all rows before this one
    in ``order`` (columns of any type, unique together).

    Rows are dealt by ranges of the order into slices, written once (Spark
    samples ranges anew for every job), summed within their slice, and moved
    up by the slices before: the window without a partition and the broadcast
    see one row per slice.
    """
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written_once(df.repartitionByRange(n, *order).withColumn("__slice", F.spark_partition_id()), "running-totals")
    within = Window.partitionBy("__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("__slice").agg(F.sum(value).alias("__total"))
              .select("__slice", F.coalesce(F.sum("__total").over(over), F.lit(0)).alias("__start")))
    inner = F.coalesce(F.sum(value).over(within), F.lit(0))
    return (dealt.withColumn("__inner", inner).join(F.broadcast(starts), "__slice")
            .withColumn(out, F.col("__start") + F.col("__inner")).drop("__slice", "__inner", "__start"))
