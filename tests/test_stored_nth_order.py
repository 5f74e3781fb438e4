"""The n-th order trigger over stored counts: equal to numbering all orders in arrival order."""

import collections
import datetime as dt
import random
import tempfile

import pytest

from tessera.sources.batches import BatchStore
from tessera.streaming.stored_nth_order import NthOrders

SCHEMA = "order_id long, customer_code long, placed_at timestamp"


def batches(seed):
    rng, out, n = random.Random(seed), [], 0
    for _ in range(4):
        rows = [(n + i, None if i % 40 == 0 else 1 if i % 3 == 0 else rng.randrange(2, 30),
                 dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(10_000))) for i in range(150)]
        n += 150
        out.append(rows)
    return out


def plain(all_batches, every=3):
    seen, out = collections.Counter(), set()
    for rows in all_batches:
        for o, c, at in sorted(rows, key=lambda r: (r[2], r[0])):
            if c is not None:
                seen[c] += 1
                if seen[c] % every == 0:
                    out.add((o, c, seen[c]))
    return out


@pytest.fixture()
def store(spark):
    return BatchStore(spark, tempfile.mkdtemp(prefix="tessera-store-"))


def got(trigger):
    rows = [(r.order_id, r.customer_code, r.rn) for r in trigger.triggered(SCHEMA).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_batches_run_again_and_compacted(spark, store):
    data, trigger = batches(1), NthOrders(store)
    assert got(trigger) == set() and trigger.compact() == -1
    for epoch, rows in enumerate(data):
        for _ in range(2):  # the second run of an epoch changes nothing
            trigger.sink(spark.createDataFrame(rows, SCHEMA), epoch)
        if epoch in (1, 2):
            assert trigger.compact() == epoch == trigger.compact()
    assert got(trigger) == plain(data)
    assert {r.customer_code: r.n for r in trigger.seen().collect()} == collections.Counter(
        c for rows in data for _, c, _ in rows if c is not None)


def test_stream_of_files(spark, store):
    src, checkpoint = tempfile.mkdtemp(prefix="tessera-src-"), tempfile.mkdtemp(prefix="tessera-ckpt-")
    data, trigger = batches(2), NthOrders(store)
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    for rows in data[:2]:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        trigger.run(stream(), checkpoint)
    trigger.run(stream(), checkpoint)
    assert got(trigger) == plain(data[:2])
