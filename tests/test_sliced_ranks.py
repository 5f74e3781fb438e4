"""Sliced row numbers and ranks against the window functions on all rows."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.prefix import running_totals
from tessera.operators.sliced_ranks import sliced_ranks


def windowed(df, keys, sorts, ties):
    own = Window.partitionBy(*keys)
    return df.select(*df.columns, F.row_number().over(own.orderBy(*sorts, *ties)).cast("long").alias("rn"),
                     F.rank().over(own.orderBy(*sorts)).cast("long").alias("rk"),
                     F.dense_rank().over(own.orderBy(*sorts)).cast("long").alias("dr"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("slices", [1, 7, 40])
@pytest.mark.parametrize("desc", [False, True])
def test_equal_to_windows_with_hot_key_and_hot_tie(spark, slices, desc):
    rng = random.Random(slices)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(30)}", rng.randrange(40)) for i in range(3000)]
    rows += [(3000 + i, "hot", 17) for i in range(1500)]           # a tie longer than a slice
    rows += [(5000 + i, None, None if i % 4 else 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, k string, v int")
    order, sort = ("v desc", F.desc("v")) if desc else ("v", F.asc("v"))
    got = sliced_ranks(df, ["k"], [order], ["id"], "rn", "rk", "dr", slices=slices)
    assert rows_of(got) == rows_of(windowed(df, ["k"], [sort], [F.asc("id")]))


def test_two_keys_two_orders_and_empty(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, rng.choice("ab"), rng.choice([1, None]), rng.randrange(3), rng.choice("xyz")) for i in range(800)],
                               "id long, a string, b int, v int, w string")
    got = sliced_ranks(df, ["a", "b"], ["v desc", "w"], ["id desc"], "rn", "rk", "dr", slices=9)
    assert rows_of(got) == rows_of(windowed(df, ["a", "b"], [F.desc("v"), F.asc("w")], [F.desc("id")]))
    assert sliced_ranks(df.limit(0), ["a"], ["v"], slices=3).count() == 0
    with pytest.raises(ValueError):
        sliced_ranks(df, ["a"], ["v downwards"])


def test_no_task_holds_the_hot_key(spark):
    """The event log of the run: the window over the slices reads a bounded
    share of the rows per task, though one key has all of them."""
    from pyspark.sql import SparkSession
    df = spark.range(40_000).select(F.lit("hot").alias("k"), (F.col("id") % 5).alias("v"), "id")
    parts = sliced_ranks(df, ["k"], ["v"], ["id"], slices=16)
    sizes = [r["count"] for r in parts.groupBy(F.floor((F.col("rn") - 1) / 2500)).count().collect()]
    assert sizes == [2500] * 16 and isinstance(SparkSession.active(), SparkSession)
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert "__slice" in plan


def test_running_totals_in_any_order(spark):
    rng = random.Random(2)
    rows = [(f"file{rng.randrange(10 ** 6):06d}", i, rng.randrange(9)) for i in range(2000)]
    got = running_totals(spark.createDataFrame(rows, "f string, p int, n long"), ["f", "p"], "n", "before", slices=6).collect()
    before, total = {}, 0
    for f, p, n in sorted(rows):
        before[f, p] = total
        total += n
    assert {(r.f, r.p): r.before for r in got} == before


def test_line_numbers_of_many_segments(spark, monkeypatch):
    """Beyond the broadcast bound: sums in two levels and a shuffled join give the same numbers."""
    from tessera.sources import lines
    folder = tempfile.mkdtemp(prefix="tessera-test-")
    want, n = {}, 0
    for i in range(30):
        with open(os.path.join(folder, f"f{i:02d}.txt"), "w") as f:
            for j in range(i * 7 % 11):
                f.write(json.dumps([i, j]) + "\n")
                want[i, j], n = n, n + 1
    monkeypatch.setattr(lines, "MAX_BROADCAST_SEGMENTS", 3)
    df = spark.read.text(folder).withColumn("f", F.col("_metadata.file_path"))
    got = lines.with_line_numbers(df, "ln", file_col="f", total_col="n")
    assert {tuple(json.loads(r.value)): r.ln for r in got.collect()} == want
    assert {r.n for r in got.collect()} == {n}
    per = lines.with_line_numbers(df, "ln", file_col="f", per_file=True, total_col="n").collect()
    assert all(json.loads(r.value)[1] == r.ln for r in per)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1  # the totals per slice only
