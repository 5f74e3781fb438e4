"""Streaming every-n-th-order trigger vs the batch numbering."""

import os

from food_seed import seed_orders
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.streaming.nth_order import every_nth_order_stream, run_once


def test_stream_matches_batch(spark, tmpdir_path):
    orders = seed_orders(spark)
    src = os.path.join(tmpdir_path, "orders_in")
    # three files, one per month, arriving in time order
    for m in (1, 2, 3):
        (orders.filter(F.month("placed_at") == m).coalesce(1)
               .write.mode("overwrite").parquet(os.path.join(src, f"month={m}")))
    stream = (spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(src, "month=*")))
    run_once(spark, every_nth_order_stream(stream, every=3), "nth_orders")
    got = {(r.order_id, r.rn) for r in spark.table("nth_orders").collect()}

    w = Window.partitionBy("customer_code").orderBy("placed_at", "order_id")
    expect = {(r.order_id, r.rn) for r in
              orders.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") % 3 == 0)
                    .collect()}
    assert got == expect
    assert ("OF1900191864", 3) in got and ("OF1900191870", 6) in got


def test_event_time_stream_with_late_orders(spark, tmpdir_path):
    import datetime as dt

    orders = seed_orders(spark)
    src = os.path.join(tmpdir_path, "orders_late")
    # Half of January's orders only arrive after February's: out of order,
    # within the 90-day delay.
    jan = orders.filter(F.month("placed_at") == 1)
    held = F.abs(F.hash("order_id")) % 2 == 0
    parts = [jan.filter(~held).unionByName(orders.filter(F.month("placed_at") == 2)),
             jan.filter(held),
             orders.filter(F.month("placed_at") == 3)]
    # a far-future order of another customer moves the watermark past all
    flush = spark.createDataFrame(
        [tuple(None for _ in orders.columns)], orders.schema) \
        .withColumn("order_id", F.lit("FLUSH")).withColumn("customer_code", F.lit("zz")) \
        .withColumn("placed_at", F.lit(dt.datetime(2100, 1, 1)))
    parts.append(flush.select(*orders.columns))
    for i, p in enumerate(parts):
        p.coalesce(1).write.mode("overwrite").parquet(os.path.join(src, f"batch={i}"))
    stream = (spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(src, "batch=*")))
    run_once(spark, every_nth_order_stream(stream, every=3, watermark="90 days"), "nth_late")
    got = {(r.order_id, r.rn) for r in spark.table("nth_late").collect()}

    w = Window.partitionBy("customer_code").orderBy("placed_at", "order_id")
    expect = {(r.order_id, r.rn) for r in
              orders.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") % 3 == 0)
                    .collect()}
    assert got == expect
