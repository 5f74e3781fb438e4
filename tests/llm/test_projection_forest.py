"""The forest search against exhaustive search."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import projection_forest as forest

SCHEMA = "vec_id long, embedding array<float>"


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(x) * float(y)
    return total


def exhaustive(rows, k, step=20):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
          and any(x != 0 for x in v)]
    queries = {}
    for i, v in ok:
        if i % step == 0:
            queries[i] = min(queries.get(i, v), v)
    out = {}
    for q, v in queries.items():
        best = collections.defaultdict(lambda: -np.inf)
        for i, w in ok:
            if i != q:
                best[i] = max(best[i], dot(v, w))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(spark, rows, k, schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema)
    out = collections.defaultdict(list)
    for r in forest.nearest(df, F.col("vec_id") % 20 == 0, k, **kw).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return dict(out)


def singles(x):
    return [float(np.float32(v)) for v in x]


def recall(got, want):
    pairs = [(q, i) for q, own in want.items() for i, _ in own]
    return sum(i in {j for j, _ in got.get(q, [])} for q, i in pairs) / len(pairs)


@pytest.mark.parametrize("tile", [8192, 16])
def test_clusters_and_copies(spark, monkeypatch, tile):
    monkeypatch.setattr(forest, "TILE_ROWS", tile)  # 16: hot leaves are cut into many tiles
    monkeypatch.setattr(forest, "TILE_QUERIES", tile)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 8)) * 3
    rows = [(i, singles(centres[i % 12] + rng.standard_normal(8) * 0.3)) for i in range(900)]
    rows += [(i, rows[5][1]) for i in range(900, 1300)]  # copies: a third of all rows
    want, got = exhaustive(rows, 20), found(spark, rows, 20, leaf_rows=40)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    assert all(s == dot(rows[q][1], rows[i][1]) for q, own in got.items() for i, s in own)
    assert all(own == sorted(own, key=lambda x: (-x[1], x[0])) for own in got.values())


def test_few_rows_are_exact(spark):
    rows = [(i, singles(np.random.default_rng(i).standard_normal(4) * (i % 7))) for i in range(90)]
    assert found(spark, rows, 20) == exhaustive(rows, 20)
    assert found(spark, rows[:8], 20) == exhaustive(rows[:8], 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]),
            (7, [3.0]), (8, [1.0, 2.0, 4.0]), (20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (40, [0.0, 0.0]), (60, None),
            (9, [1.0, 2.0]), (9, [1.0, 2.0]), (-20, [-1.0, 5.0]), (10, [-1.0, -1.0]), (11, [1.0, 2.0])]
    assert found(spark, rows, 20) == exhaustive(rows, 20)
    assert found(spark, rows, 2) == exhaustive(rows, 2)


def test_empty_clashing_and_double(spark):
    assert found(spark, [], 20) == {} == found(spark, [(1, None)], 20)
    rows = [(i, [float(i), 1.0 / (i + 1)], 5, "a", [1]) for i in range(50)]
    schema = "vec_id long, embedding array<double>, query_id long, score string, leaves array<int>"
    assert found(spark, rows, 3, schema) == exhaustive([r[:2] for r in rows], 3)


def test_uneven_norms(spark):
    rng = np.random.default_rng(3)
    rows = [(i, singles(rng.standard_normal(6) * rng.lognormal(0, 1.5))) for i in range(1500)]
    want = exhaustive(rows, 10)
    assert recall(found(spark, rows, 10, leaf_rows=30), want) >= 0.9


def test_table_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = collections.defaultdict(list)
    for r in forest.op11_projection_forest(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = exhaustive(rows, 20)
    assert recall(got, want) >= 0.9 and got.keys() == want.keys()
    vectors = dict(rows)
    assert all(len(own) == 20 and all(s == dot(vectors[q], vectors[i]) for i, s in own) for q, own in got.items())
