"""Joins that split measured heavy keys.

AQE splits a skewed partition of a sort-merge join, but only where nothing
above the join needs the rows of a key together, and never the side that an
outer or anti join must keep whole. Here the keys that hold more than their
share are found first by a frequent-item sketch (one small row per task), and
only their rows are dealt out: the left rows by a salt, the right rows to every
salt of their key. All other keys join as they are, in the same join.

The list of heavy keys is bounded by what a share can be: of keys with more
than one row in ``1 / share`` there are at most ``1 / share``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key with more than this share of the left rows is heavy.
SHARE = 0.01
HOWS = ("inner", "left", "left_semi", "left_anti")


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> DataFrame:
    """(keys..., n): the non-null keys with more than ``share`` of the rows,
    counted exactly. A sketch names the candidates, so the count groups by a
    bounded list and not by every key."""
    key = F.struct(*keys)
    complete = df.select(*keys).dropna()
    total = complete.count()
    if not total:
        return complete.withColumn("n", F.lit(0).cast("long"))
    tracked = 4 * math.ceil(1 / share)
    text = F.to_json(key)
    found = complete.select(text.alias("__key")).agg(
        F.expr(f"approx_top_k(__key, {math.ceil(1 / share)}, {tracked})").alias("top")).select(F.explode("top.item").alias("__key"))
    counted = (complete.withColumn("__key", text).join(F.broadcast(found), "__key", "left_semi")  # at most 1 / share rows
               .groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    return counted.where(F.col("n") > share * total)


def join_heavy(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", share: float = SHARE,
               rows_per_salt: int | None = None) -> DataFrame:
    """``left.join(right, keys, how)`` with the rows of keys that are heavy in
    ``left`` spread over salts of about ``rows_per_salt`` rows (by default the
    share that makes a key heavy). Null keys match nothing and are dealt by a
    hash of the row."""
    if how not in HOWS:
        raise ValueError(f"how is one of {HOWS}; the right side is copied to the salts, so it cannot be kept whole")
    heavy = heavy_keys(left, keys, share).collect()
    per = rows_per_salt or max([1, *[math.ceil(r["n"] * share) for r in heavy]])
    spark, schema = left.sparkSession, left.select(*keys).schema
    salts = F.broadcast(spark.createDataFrame([(*[r[k] for k in keys], math.ceil(r["n"] / per)) for r in heavy],
                                              schema.add("__salts", T.IntegerType())))  # at most 1 / share rows
    row = F.xxhash64(*left.columns, F.monotonically_increasing_id())
    some_null = F.lit(False)
    for k in keys:
        some_null |= F.col(k).isNull()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = left.join(salts, list(keys), "left").withColumn(
        "__salt", F.when(some_null, F.pmod(row, F.lit(width))).when(F.col("__salts").isNull(), 0)
        .otherwise(F.pmod(row, "__salts")).cast("int")).drop("__salts")
    other = right.select(*keys).distinct() if how in ("left_semi", "left_anti") else right
    copied = other.join(salts, list(keys), "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts")
    return dealt.join(copied, [*keys, "__salt"], how).drop("__salt")
