"""Every n-th order per customer as orders stream in, counted in a table.

``nth_order`` keeps a state per customer in the streaming engine for ever and
numbers a customer's orders in pandas. Here the counts are rows of a store
(``sources.batches``): every micro-batch is numbered by ``sliced_ranks``, so a
customer with a third of a batch is spread over tasks, its numbers start after
the stored count, and the orders that bring a customer to a multiple of
``every`` are committed together with the batch's counts. A micro-batch that
runs again after a failure finds its epoch committed, or nothing of it.

Orders are numbered in (time, tie) order within a micro-batch and in arrival
order across micro-batches; a late order is counted after those before it on
arrival. Counts are partial sums per epoch; ``compact`` adds them up into one
row per customer, and later epochs start from there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sliced_ranks import sliced_ranks
from ..sources.batches import BatchStore

COUNTS, BASE, TRIGGERED = "order_counts", "order_counts_base", "nth_orders"


class NthOrders:
    """The trigger's tables in ``store``; ``sink`` is for ``foreachBatch``."""

    def __init__(self, store: BatchStore, every: int = 3, key: str = "customer_code",
                 order: Sequence[str] = ("placed_at", "order_id"), key_type: str = "long"):
        self.store, self.every, self.key, self.order = store, every, key, list(order)
        self.counts_schema = f"{key} {key_type}, n long, epoch long"

    def _newest_base(self) -> int:
        found = self.store.read(BASE, self.counts_schema).agg(F.max("epoch")).first()[0]
        return -1 if found is None else found

    def seen(self) -> DataFrame:
        """(key, n): orders counted so far."""
        upto = self._newest_base()
        base = self.store.read(BASE, self.counts_schema).where(F.col("epoch") == upto)
        later = self.store.read(COUNTS, self.counts_schema).where(F.col("epoch") > upto)
        return base.unionByName(later).groupBy(self.key).agg(F.sum("n").alias("n"))

    def sink(self, batch: DataFrame, epoch: int) -> None:
        """Number one micro-batch and commit its n-th orders and counts."""
        batch_id = f"epoch-{epoch}"
        if self.store.is_committed(batch_id):
            return
        orders = batch.where(F.col(self.key).isNotNull())
        numbered = sliced_ranks(orders, [self.key], self.order, row_number="__in_batch")
        hits = (numbered.join(self.seen().withColumnRenamed("n", "__seen"), self.key, "left")
                .withColumn("rn", F.coalesce("__seen", F.lit(0)) + F.col("__in_batch"))
                .where(F.col("rn") % self.every == 0).select(*batch.columns, "rn"))
        counts = orders.groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).withColumn("epoch", F.lit(epoch).cast("long"))
        self.store.write(batch_id, {TRIGGERED: hits, COUNTS: counts})

    def compact(self) -> int:
        """Add up the counts of all epochs so far; returns the last of them."""
        last = self.store.read(COUNTS, self.counts_schema).agg(F.max("epoch")).first()[0]
        if last is None or last <= self._newest_base():
            return self._newest_base()
        total = self.seen().withColumn("epoch", F.lit(last).cast("long"))
        self.store.write(f"compact-{last}", {BASE: total})
        return last

    def triggered(self, schema: str) -> DataFrame:
        """All n-th orders committed so far; ``schema`` is that of the orders."""
        return self.store.read(TRIGGERED, f"{schema}, rn long").drop("batch_id")

    def run(self, orders: DataFrame, checkpoint: str) -> None:
        """Count all orders that are there and new to the checkpoint, then stop."""
        (orders.writeStream.foreachBatch(self.sink).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start().awaitTermination())
