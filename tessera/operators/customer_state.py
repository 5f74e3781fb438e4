"""Customer state kept up to date batch by batch.

What the lifecycle questions need of a customer's history is small and
mergeable: the number of orders and of promo orders, the first and last order
day, and the first order itself with the promos of its day. Each batch of
orders is reduced to one partial state per customer (combined before the
shuffle, so a customer with a third of all orders is one row per task) and
written under its batch id, so a batch that runs again counts once. Partial
states merge in any order: late orders are just another part. ``compact``
replaces the parts by one state; a version is the set of batches it holds.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.batches import BatchStore

STATE = ("customer_code long, n_orders long, n_promo long, first_day date, last_day date, "
         "first_order struct<placed_at: timestamp, order_id: long, promo: string>, first_day_promos array<long>")
TABLE, COMPACTED = "customer_state", "customer_state_compacted"


def _first_day_promos(days_and_promos: Column, first: Column) -> Column:
    """Of collected (day, promo orders), the orders of the first day."""
    own = F.filter(days_and_promos, lambda x: x["day"] == first)
    return F.array_sort(F.flatten(F.transform(own, lambda x: x["promos"])))


def partial_state(orders: DataFrame) -> DataFrame:
    """One row per customer of these orders.

    The promo orders of the first day are gathered from per-day rows, so what
    is held per customer is the first day's list only, not the history."""
    day = F.to_date("placed_at")
    mine = orders.where("customer_code is not null").withColumn("__day", day)
    whole = mine.groupBy("customer_code").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count("promo_code_name").alias("n_promo"),
        F.min("__day").alias("first_day"), F.max("__day").alias("last_day"),
        F.min(F.struct("placed_at", "order_id", F.col("promo_code_name").alias("promo"))).alias("first_order"))
    promos = (mine.where("promo_code_name is not null").select("customer_code", "__day", "order_id")
              .join(whole.select("customer_code", F.col("first_day").alias("__day")), ["customer_code", "__day"])
              .groupBy("customer_code").agg(F.array_sort(F.collect_list("order_id")).alias("first_day_promos")))
    return whole.join(promos, "customer_code", "left").withColumn(
        "first_day_promos", F.coalesce("first_day_promos", F.array().cast("array<long>")))


def merged_state(parts: DataFrame) -> DataFrame:
    """One row per customer of any number of partial states."""
    by_day = F.collect_list(F.struct(F.col("first_day").alias("day"), F.col("first_day_promos").alias("promos")))
    return (parts.groupBy("customer_code").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("n_promo").alias("n_promo"), F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"), F.min("first_order").alias("first_order"), by_day.alias("__days"))
        .withColumn("first_day_promos", _first_day_promos(F.col("__days"), F.col("first_day"))).drop("__days"))


class CustomerState:
    """The state's parts in a store, and what they add up to."""

    def __init__(self, store: BatchStore):
        self.store = store

    def update(self, batch_id: str, orders: DataFrame) -> bool:
        """Add a batch of orders; False if it was added before."""
        return self.store.write(f"orders-{batch_id}", {TABLE: partial_state(orders)})

    def _held(self) -> list[str]:
        """Batches that the newest compacted state holds."""
        rows = self.store.read("compacted_versions", "version string, n long, held array<string>").orderBy(F.desc("n")).take(1)
        return [rows[0].version, *rows[0].held] if rows else []

    def current(self) -> DataFrame:
        """One row per customer over all batches."""
        held = self._held()
        parts = self.store.read(TABLE, STATE)
        if not held:
            return merged_state(parts.drop("batch_id"))
        newer = parts.where(~F.col("batch_id").isin(held[1:])).drop("batch_id")
        base = self.store.read(COMPACTED, STATE).where(F.col("batch_id") == f"compact-{held[0]}").drop("batch_id")
        return merged_state(base.unionByName(newer))

    def compact(self) -> str:
        """Write what the parts add up to as one state; its version is a
        digest of the batches it holds, so the same compaction is done once."""
        batches = sorted(r.batch_id for r in self.store.commits().where("startswith(batch_id, 'orders-')").select("batch_id").collect())
        version = hashlib.sha256("\n".join(batches).encode()).hexdigest()[:16]
        spark = self.store.spark
        made = spark.createDataFrame([(version, len(batches), batches)], "version string, n long, held array<string>")
        self.store.write(f"compact-{version}", {COMPACTED: self.current(), "compacted_versions": made})
        return version
