"""Approximate nearest neighbours by inner product: a forest of random-projection
trees, searched through one priority queue, with exact reranking.

Index. A tree halves the vectors again and again at the median of a random
direction's projections. Directions come from a seed, medians from a bounded
sample (``SAMPLE`` rows with the smallest hash of the id); every row is then
put into its leaf of every tree. Vectors get one more component that makes all
norms equal, so that nearness by inner product is nearness by angle.

Search. A query descends all trees through one queue, ordered by the worst
margin on the way to a node; leaves are taken in that order until they hold
``budget`` rows. Candidates meet their queries in tiles (branch of a tree,
block of rows, part of queries), where every query meets the rows of the leaves
it took; each tile keeps the best ``k`` per query by exact products in double
precision, as one row, and the tiles' results are merged per query in two
steps.

The budget is measured, not set: for ``PROBES`` sampled rows the exact nearest
rows are found by a pass over the whole table, and the budget is what the
queue has to gather until ``RECALL`` of these neighbours are in a taken leaf.
On vectors without structure it approaches all rows; on clustered ones it is
a small part of them.

Skew: a branch of many rows (copies of one vector share a leaf in every tree)
or many queries is cut into tiles of bounded size by hashes of the ids. The
driver holds the sample, the trees, a row per leaf (at most ``TREES * 2 **
MAX_DEPTH``) and the probes' neighbours, all of fixed size.

Scores are sums of products in component order, in double precision, so equal
vectors have equal scores; ties go to the smaller id.

Edge cases: vectors that are null, zero or hold null or non-finite components,
and rows with a null id, take no part; missing components of shorter vectors
count as zero; rows that repeat an id count as one candidate with its largest
product, and as one query with the smallest of their vectors; a query's own id
is no candidate; fewer than ``k`` candidates are all returned; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, stored
from tessera.sources.tables import read_table

TREES, LEAF_ROWS, MAX_DEPTH = 4, 512, 10
SAMPLE, PROBES, RECALL = 16_384, 64, 0.95
TILE_ROWS, TILE_QUERIES, AT_ONCE = 8192, 4096, 512
SEED = 20_260
RESULT = "query_id long, rank int, vec_id long, score double"
BEST = "query_id long, ids array<long>, scores array<double>, step int"


def taking_part(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = F.col("vector")
    number = lambda x: x.cast("double")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(number(x)) | (F.abs(number(x)) == float("inf")))
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
            .where("vec_id is not null and vector is not null").where(~odd & F.exists(v, lambda x: x != 0)))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of numbers as rows of doubles, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes])] = flat
    return out


class Forest:
    """Trees as directions and thresholds; node 2n + 1 is the lower half of
    node n, 2n + 2 the upper. ``norm``: the largest norm of all rows."""

    def __init__(self, sample: np.ndarray, n_rows: int, norm: float, trees: int = TREES, leaf_rows: int = LEAF_ROWS):
        self.norm, self.dims, self.trees = norm, sample.shape[1], trees
        self.depth = int(np.clip(np.ceil(np.log2(max(1, n_rows / leaf_rows))), 0, MAX_DEPTH))
        self.leaves = 2 ** self.depth
        # neighbouring leaves of about TILE_ROWS rows together are a branch
        self.shift = min(self.depth, max(0, int(np.log2(max(1, TILE_ROWS // leaf_rows)))))
        rng = np.random.default_rng(SEED)
        self.directions = rng.standard_normal((trees, self.leaves - 1, self.dims + 1))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.medians = np.zeros((trees, self.leaves - 1))
        rows = self.levelled(sample)
        for t in range(trees):
            node = np.zeros(len(rows), np.int64)
            for level in range(self.depth):
                at = np.einsum("ij,ij->i", rows, self.directions[t][node])
                for n in np.unique(node):
                    self.medians[t, n] = np.median(at[node == n])
                node = 2 * node + 1 + (at > self.medians[t][node])

    def levelled(self, rows: np.ndarray) -> np.ndarray:
        """Rows with the component that gives all of them the same norm."""
        rest = np.sqrt(np.maximum(0.0, self.norm ** 2 - np.einsum("ij,ij->i", rows, rows)))
        return np.column_stack([rows, rest])

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        """(rows, trees): each row's leaves, numbered through all trees."""
        rows, out = self.levelled(rows), np.empty((len(rows), self.trees), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                at = np.einsum("ij,ij->i", rows, self.directions[t][node])
                node = 2 * node + 1 + (at > self.medians[t][node])
            out[:, t] = node - (self.leaves - 1) + t * self.leaves
        return out

    def in_order(self, query: np.ndarray) -> Iterator[int]:
        """All leaves of all trees, best margin first, from one shared queue."""
        query = np.append(query * (self.norm / np.linalg.norm(query)), 0.0)
        margins = (self.directions @ query - self.medians).tolist()
        inner = self.leaves - 1
        queue = [(float("-inf"), t, 0) for t in range(self.trees)]
        while queue:
            worst, t, node = heapq.heappop(queue)
            if node >= inner:
                yield node - inner + t * self.leaves
                continue
            margin = margins[t][node]
            heapq.heappush(queue, (max(worst, margin), t, 2 * node + 1))
            heapq.heappush(queue, (max(worst, -margin), t, 2 * node + 2))

    def taken(self, query: np.ndarray, sizes: np.ndarray, budget: int) -> dict[int, list[int]]:
        """Branch -> leaves, of the first leaves that hold ``budget`` rows."""
        out, rows = {}, 0
        for leaf in self.in_order(query):
            if rows >= budget:
                break
            if sizes[leaf]:
                out.setdefault(leaf >> self.shift, []).append(leaf)
                rows += int(sizes[leaf])
        return out


def exact_best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """(query position, id, score) of the ``k`` best ids for each query.

    A matrix product with slack picks who may be among them; their scores are
    summed again in component order, which does not depend on their place."""
    by_id = np.argsort(ids, kind="stable")
    rows, ids = rows[by_id], ids[by_id]
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(ids)]))
    names, slack = ids[starts], 1e-12 * np.abs(rows).max() * np.abs(queries).max() * rows.shape[1]
    out = []
    for k0 in range(0, len(queries), AT_ONCE):
        q, own = queries[k0:k0 + AT_ONCE], query_ids[k0:k0 + AT_ONCE]
        best = np.maximum.reduceat(q @ rows.T, starts, axis=1)
        best[own[:, None] == names[None, :]] = -np.inf
        if len(names) > k:
            least = np.partition(best, len(names) - k, axis=1)[:, len(names) - k] - slack
        else:
            least = np.full(len(q), -np.inf)
        may = (best >= least[:, None]) & (best > -np.inf)
        qi, ri = np.nonzero(may[:, group])
        score = np.zeros(len(qi))
        for d in range(rows.shape[1]):
            score += q[qi, d] * rows[ri, d]
        order = np.lexsort((-score, group[ri], qi))
        qi, gi, score = qi[order], group[ri[order]], score[order]
        first = np.r_[True, (qi[1:] != qi[:-1]) | (gi[1:] != gi[:-1])] if len(qi) else np.empty(0, bool)
        qi, gi, score = qi[first], gi[first], score[first]
        out.append(_first(qi + k0, names[gi], score, k))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _first(at: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The ``k`` largest scores of each ``at``, ties to smaller ids, in order."""
    order = np.lexsort((ids, -score, at))
    at, ids, score = at[order], ids[order], score[order]
    begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
    keep = np.arange(len(at)) - np.repeat(begin, np.diff(np.r_[begin, len(at)])) < k
    return at[keep], ids[keep], score[keep]


def merged_best(at: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """As ``_first``, where an id may come several times with equal scores."""
    order = np.lexsort((-score, ids, at))
    at, ids, score = at[order], ids[order], score[order]
    new = np.r_[True, (at[1:] != at[:-1]) | (ids[1:] != ids[:-1])] if len(at) else np.empty(0, bool)
    return _first(at[new], ids[new], score[new], k)


def _best_rows(query_ids: np.ndarray, at: np.ndarray, ids: np.ndarray, score: np.ndarray, step: np.ndarray) -> pa.Table:
    """A row per query that has any: ``at`` are places in ``query_ids``."""
    begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
    ends = pa.array(np.r_[begin, len(at)].astype(np.int32))
    return pa.table({"query_id": pa.array(query_ids[at[begin]], pa.int64()),
                     "ids": pa.ListArray.from_arrays(ends, pa.array(ids, pa.int64())),
                     "scores": pa.ListArray.from_arrays(ends, pa.array(score, pa.float64())),
                     "step": pa.array(step[at[begin]], pa.int32())})


def _neighbours(key: pa.Array, ids: np.ndarray, score: np.ndarray, **more) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"query_id": key, "vec_id": pa.array(ids, pa.int64()),
                                       "score": pa.array(score, pa.float64()), **more})


def indexed(rows: DataFrame, forest) -> DataFrame:
    """Every row with its leaf in each tree; stored once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = forest.value
        for batch in batches:
            leaves = own.leaf(matrix(batch["vector"], own.dims))
            ends = pa.array(np.arange(0, leaves.size + 1, own.trees, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["vector"],
                                              pa.ListArray.from_arrays(ends, pa.array(leaves.ravel()))],
                                             ["vec_id", "vector", "leaves"])

    kind = rows.schema["vector"].dataType.simpleString()
    return stored(rows.mapInArrow(run, f"vec_id long, vector {kind}, leaves array<int>"), "forest-rows")


def measured_budget(table: DataFrame, forest, probes, sizes: np.ndarray, k: int, recall: float) -> int:
    """Rows the queue has to gather for ``recall`` of the probes' exact
    neighbours, which one pass over the whole table finds."""
    ids, vectors = probes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = batch["vec_id"].to_numpy(zero_copy_only=False)
                at, found, score = exact_best(vectors, ids, matrix(batch["vector"], vectors.shape[1]), own, k)
                row = {i: n for n, i in enumerate(own.tolist())}
                yield _neighbours(pa.array(ids[at]), found, score,
                                  leaves=batch["leaves"].take(pa.array([row[i] for i in found.tolist()], pa.int64())))

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    exact = (table.mapInArrow(run, "query_id long, vec_id long, score double, leaves array<int>")
             .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).collect())
    needed, own = [], forest.value
    for i, vector in zip(ids.tolist(), vectors, strict=True):
        rows, after = 0, {}
        for leaf in own.in_order(vector):
            rows += int(sizes[leaf])
            after[leaf] = rows
        needed += [min(after[leaf] for leaf in r.leaves) for r in exact if r.query_id == i]
    return int(np.quantile(needed, recall, method="higher")) if needed else int(sizes.sum())


def nearest(vectors: DataFrame, is_query, k: int, id_col: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, leaf_rows: int = LEAF_ROWS, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``vectors`` that
    ``is_query`` (a condition on ``vec_id``) selects, the ``k`` nearest other
    rows found."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = taking_part(vectors, id_col, vector)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, dims, norm = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(F.sqrt(square))).first()
    if not n:
        return spark.createDataFrame([], RESULT)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).toArrow().combine_chunks()
    known = matrix(sample["vector"].chunk(0), dims)
    forest = spark.sparkContext.broadcast(Forest(known, n, norm, trees, leaf_rows))
    table = indexed(rows, forest)
    sizes = np.zeros(trees * forest.value.leaves, np.int64)
    for leaf, count in table.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        sizes[leaf] = count
    ids, first = np.unique(sample["vec_id"].to_numpy()[:PROBES], return_index=True)
    budget = measured_budget(table, forest, (ids, known[first]), sizes, k, recall)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = forest.value
        for batch in batches:
            taken = [[{"branch": b, "leaves": leaves} for b, leaves in own.taken(q, sizes, budget).items()]
                     for q in matrix(batch["vector"], dims)]
            kind = pa.list_(pa.struct({"branch": pa.int32(), "leaves": pa.list_(pa.int32())}))
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["vector"], pa.array(taken, kind)],
                                             ["query_id", "vector", "taken"])

    kind = rows.schema["vector"].dataType.simpleString()
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    visits = stored(queries.mapInArrow(
        search, f"query_id long, vector {kind}, taken array<struct<branch: int, leaves: array<int>>>"), "forest-visits")
    asked = {r.branch: r["count"] for r in visits.select(F.explode("taken.branch").alias("branch")).groupBy("branch").count().collect()}
    shift = forest.value.shift
    held = np.add.reduceat(sizes, np.arange(0, len(sizes), 1 << shift))
    blocks = {b: -(-int(held[b]) // TILE_ROWS) for b in asked}
    # a row per branch: at most TREES * 2 ** MAX_DEPTH, whatever the tables
    tiles = F.broadcast(spark.createDataFrame(
        [(b, blocks[b], -(-count // TILE_QUERIES)) for b, count in asked.items()], "branch int, blocks int, parts int"))
    # a query's results from this many tiles are merged in two steps of about the root of it
    steps = int(np.sqrt(sum(blocks.values()))) + 1
    key = ("branch", "block", "part")
    candidates = (table.select("vec_id", "vector", F.explode("leaves").alias("leaf"))
                  .withColumn("branch", F.shiftright("leaf", shift)).join(tiles, "branch")
                  .select("branch", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"),
                          F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "leaf", "vec_id", "vector"))
    wanted = (visits.select("query_id", "vector", F.explode("taken").alias("t"))
              .select("query_id", "vector", "t.branch", "t.leaves").join(tiles, "branch")
              .select("branch", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
                      F.pmod(F.xxhash64("query_id"), "parts").cast("int").alias("part"), "query_id", "vector", "leaves"))

    def rerank(left, right):
        left, right = left.combine_chunks(), right.combine_chunks()
        none = np.empty(0, np.int64)
        if not left.num_rows or not right.num_rows:
            return _best_rows(none, none, none, none.astype(float), none)
        ids, leaf, vectors = left["vec_id"].to_numpy(), left["leaf"].to_numpy(), matrix(left["vector"].chunk(0), dims)
        own, asking = right["query_id"].to_numpy(), matrix(right["vector"].chunk(0), dims)
        lists = right["leaves"].chunk(0)
        wanted_leaf, asker = lists.flatten().to_numpy(), np.repeat(np.arange(len(own)), np.diff(lists.offsets.to_numpy()))
        found = []
        for one in np.intersect1d(leaf, wanted_leaf):
            here, who = leaf == one, asker[wanted_leaf == one]
            at, near, score = exact_best(asking[who], own[who], vectors[here], ids[here], k)
            found.append((who[at], near, score))
        if not found:
            return _best_rows(none, none, none, none.astype(float), none)
        at, near, score = merged_best(*(np.concatenate(c) for c in zip(*found, strict=True)), k)
        tile = right["branch"][0].as_py() * 31 + right["block"][0].as_py()
        return _best_rows(own, at, near, score, np.full(len(own), tile % steps))

    def merge(part):
        part = part.combine_chunks()
        own, where = np.unique(part["query_id"].to_numpy(), return_inverse=True)
        lists = part["ids"].chunk(0)
        at = np.repeat(where, np.diff(lists.offsets.to_numpy()))
        best = merged_best(at, lists.flatten().to_numpy(), part["scores"].chunk(0).flatten().to_numpy(), k)
        return _best_rows(own, *best, np.zeros(len(own)))

    def final(part):
        best = merge(part)
        lists = best["ids"].chunk(0)
        n = np.diff(lists.offsets.to_numpy())
        return pa.table({"query_id": pa.array(np.repeat(best["query_id"].to_numpy(), n), pa.int64()),
                         "rank": pa.array(np.concatenate([np.arange(1, x + 1) for x in n]), pa.int32()),
                         "vec_id": lists.flatten(), "score": best["scores"].chunk(0).flatten()})

    found = candidates.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInArrow(rerank, BEST)
    return found.groupBy("query_id", "step").applyInArrow(merge, BEST).groupBy("query_id").applyInArrow(final, RESULT)


def op11_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
