"""Candidates of the Jaccard join: linked sets always meet, others hardly ever; shuffle files go with their step."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import jaccard_join
from tessera.llm.common import stored
from tessera.llm.jaccard_join import CANDIDATE, COUNTER_BITS, POSTING, Bands, candidate_rows, postings


def _candidates(rows, n, p, classes):
    """Pairs that the join finds for (id, text) rows: those of a task, and those of postings in common."""
    batch = pa.record_batch({"id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows])})
    pairs, holders = set(), {}
    for found in candidate_rows(iter([batch]), n, p, 100, classes):
        for kind, key, a, b in zip(*(found[c].to_pylist() for c in ("kind", "key", "a", "b")), strict=True):
            if kind == CANDIDATE:
                pairs.add((a, b))
            elif kind == POSTING:
                holders.setdefault(key, []).append(a)
    for ids in holders.values():
        pairs |= {tuple(sorted(x)) for x in zip(ids, ids[1:])}
    return pairs


@pytest.mark.parametrize("n, p", [(4, 85), (5, 80)])
def test_a_few_common_ngrams_make_no_candidates(n, p):
    """As in a large corpus: any two documents have some n-grams in common, and the counters tell none apart."""
    rng = random.Random(p)
    vocabulary = [f"w{k}" for k in range(30 if n == 4 else 13)]
    rows = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(150, 250)))) for k in range(300)]
    sets = [jaccard_join.shingles(t, n) for _, t in rows]
    shared = sum(len(np.intersect1d(sets[i], sets[i + 1])) > 0 for i in range(0, 300, 2))
    near = [(1000 + k, rows[k][1] + " end") for k in range(0, 300, 10)]
    found = _candidates(rows + near, n, p, np.zeros(1 << COUNTER_BITS, np.uint8))
    assert {(k - 1000, k) for k, _ in near} <= found
    assert shared > 5 and len(found) < 40


@pytest.mark.parametrize("p", [95, 85, 80, 75, 50, 30])
def test_linked_sets_share_a_posting(p):
    """Sets of all sizes that just link, whatever the classes of their n-grams."""
    rng = np.random.default_rng(p)
    classes = (rng.geometric(0.7, 1 << COUNTER_BITS) - 1).clip(max=9).astype(np.uint8)
    bands, linked = Bands(p, 100), 0
    for _ in range(800):
        union = np.unique(rng.integers(0, 2**64, int(np.exp(rng.uniform(0, 7))), dtype=np.uint64))
        apart = rng.permutation(len(union))[:len(union) - -(-p * len(union) // 100)]
        cut = rng.integers(0, len(apart) + 1)
        a, b = np.delete(union, apart[:cut]), np.delete(union, apart[cut:])
        linked += 1
        assert len(np.intersect1d(postings(a, bands, classes), postings(b, bands, classes))), (len(a), len(b))
    assert linked == 800


def test_stored_tables_leave_no_shuffle_files(spark):
    """Steps of a job do not pile up their shuffles on disk."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return disk.getAllFiles().mkString("\n").count("/shuffle_")

    before, conf = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    rows = stored(spark.range(0, 20000, 1, 8).repartition(4, "id"), "test-shuffle")
    deadline = time.time() + 10
    while files() > before and time.time() < deadline:
        time.sleep(0.2)
    assert files() <= before and rows.count() == 20000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == conf
