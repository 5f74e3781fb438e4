"""Exact n-gram Jaccard join of documents, in size-banded tiles.

Two documents link when ``q * |A & B| >= p * |A | B|`` for their sets of
distinct word n-grams (threshold p/q). The result is complete: documents that
link directly or through others get the same component.

Candidates. Sets fall into bands of sizes, each ``q/p`` times the one before,
so linked sets lie in one band or in neighbours; tile ``b`` covers the pairs
whose smaller set is in band ``b``. Linked sets of a tile differ in at most D
elements, so when every set is cut into the same k > D parts by ranges of the
hash, they have at least k - D parts in common. Parts are brought into one
order, those with many rare n-grams first, and a set posts the first D + 1 of
its own: linked sets share a posting, always. k is such that a posted part
holds some two or three n-grams, mostly; documents that merely have a few
n-grams in common, as any two may in a large corpus, share no whole part, and
those with a frequent line or passage in common post others of their parts.
Sets too small for parts post pairs of their first elements instead: they share
two elements among the first ``|A| - ceil(p/q |A|) + 2`` of each in any common
order (one among the first ``+ 1`` when the threshold is low). A fixed number
of counters, chosen by hash and filled from all documents, tells which n-grams
are rare. The counters only set the order; results do not depend on them.

Postings are combined before the shuffle: a task sends each class hash once,
with the smallest document that has it, and equal sets within a task are
collapsed. Chains of documents over shared postings give candidate clusters.

Verification. A cluster is cut into blocks of ``BLOCK`` documents, each with
the cluster's smallest document per band added (for bands with at least a
document per block, so that the added ones weigh no more than the cluster).
Within a block, pairs of fitting
sizes that are not connected yet are compared: hashed bitmaps bound the overlap
from above (a bit set in one only is an element missing in the other), then
sorted arrays are intersected. Where a cluster of several blocks is still not
one component, documents outside its largest component are compared with all of
it: first by bitmaps of fixed size alone, which leaves small groups of documents
that may link (most loose clusters vanish here), then by the exact intersection
within those groups. So a large group of near copies costs time in proportion to
its size, texts travel only where a link is possible, and no link is lost.

Edge cases: a null or empty text has an empty set and links with nothing (its
component is its own id); fewer words than n give one n-gram of all of them; a
row whose id is null is not compared and has a null component; rows that
repeat an id are one document, whose links are those of all its rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, shuffles_dropped, stored, text_or_empty
from tessera.llm.components import connected_components
from tessera.sources.tables import read_table

BLOCK = 64
BLOCK_SHINGLES = 2 << 20
WIDE_BLOCK = 1024
MAP_BLOCK, MAP_BITS = 1024, 1 << 14
FLUSH_POSTINGS = 1 << 20
COUNTER_BITS, CHUNK_BITS = 22, 14
CLASSES, SMALL = 10, 32
POSTING, CANDIDATE, COPY, SIZE = range(4)
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _C2
    x = x ^ (x >> np.uint64(27))
    x = x * _C3
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only, both
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ hashed[i:i + len(out)]) * _C1
        out ^= out >> np.uint64(29)
    return np.unique(_mix(out))


class Bands:
    """Size bands of a threshold p/q, and what sets post for each tile."""

    def __init__(self, p: int, q: int):
        self.p, self.q = p, q
        self.lows = np.array([1], np.int64)
        self.cuts: dict[int, np.ndarray] = {}

    def _grow(self, size: int) -> None:
        lows = list(self.lows)
        while lows[-1] <= size * self.q // self.p + 1:
            lows.append(lows[-1] * self.q // self.p + 1)
        self.lows = np.array(lows, np.int64)

    def band(self, size: int) -> int:
        if self.lows[-1] <= size:
            self._grow(size)
        return int(np.searchsorted(self.lows, size, "right")) - 1

    def prefix(self, size: int) -> int:
        """Among how many first elements of a set of this size is one of a set
        that links with it."""
        return size - -(-self.p * size // self.q) + 1

    def needed(self, a: int | np.ndarray, b: int | np.ndarray) -> int | np.ndarray:
        """Smallest overlap of linked sets of these sizes."""
        return -(-self.p * (a + b) // (self.p + self.q))

    def apart(self, a: int, b: int) -> int:
        """In how many elements linked sets of these sizes, or smaller ones, differ at most."""
        return (a + b) * (self.q - self.p) // (self.p + self.q)

    def tiles(self, size: int) -> list[tuple[int, int]]:
        """(tile, size of the largest set that one of this size may link with
        there) of the tiles that have such sets."""
        band = self.band(size)
        below = int(self.lows[band]) - 1
        return [(band, size * self.q // self.p)] + [(band - 1, below)] * (below * self.q >= size * self.p)

    def parts(self, tile: int) -> np.ndarray | None:
        """Where the parts of the sets of a tile begin; None if these are too
        small for parts, or differ too much."""
        if tile not in self.cuts:
            low, top = int(self.lows[tile]), int(self.lows[tile + 1]) - 1
            most = self.apart(top, top * self.q // self.p)
            # a part more than they may differ in, and half as many again to choose from
            k = 1 if not most else 3 * (most + 1) // 2 + 1 if low >= SMALL and self.tight else 0
            self.cuts[tile] = np.array([-(-j * (1 << 64) // k) for j in range(k)], np.uint64)
        return self.cuts[tile] if len(self.cuts[tile]) else None

    @property
    def tight(self) -> bool:
        return 4 * self.p >= 3 * self.q


def postings(elements: np.ndarray, bands: Bands, classes: np.ndarray) -> np.ndarray:
    """Hashes that a set posts, for the tiles of its band."""
    size, out = len(elements), []
    common = classes[(elements >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
    # sums over the ranges of the sorted elements: a part's hash, and its n-grams of
    # each class, six bits a class
    sums, weights = np.zeros((2, size + 1), np.uint64)
    np.cumsum(elements, out=sums[1:])
    np.cumsum(np.uint64(1) << (np.uint64(6) * (np.uint64(CLASSES - 1) - common.astype(np.uint64))), out=weights[1:])
    first = None
    for tile, largest in bands.tiles(size):
        cuts = bands.parts(tile)
        if cuts is not None:
            at = np.append(np.searchsorted(elements, cuts), size)
            keys = _mix((sums[at[1:]] - sums[at[:-1]]) ^ (np.arange(1, len(at), dtype=np.uint64) * _C1))
            n = bands.apart(size, largest) + 1
            if n < len(keys):
                keys = keys[np.lexsort((keys, ~(weights[at[1:]] - weights[at[:-1]])))[:n]]
        else:
            if first is None:
                first = elements[np.lexsort((elements, common))[:bands.prefix(size) + bands.tight]]
            keys = first
            if bands.tight:
                a, b = np.triu_indices(len(first), 1)
                keys = _mix(np.minimum(first[a], first[b]) * _C1 + np.maximum(first[a], first[b]))
        out.append(_mix(keys ^ _mix(np.full(1, tile + 1, np.uint64))))
    return np.concatenate(out)


def frequency_classes(rows: DataFrame, n: int) -> np.ndarray:
    """Class of each counter by the number of n-grams that all documents put
    into it: 0 up to some twice the mean, which says nothing of one n-gram, then
    one more for each doubling; 2 ** COUNTER_BITS, whatever the size of the corpus."""
    low, step = np.uint64(64 - COUNTER_BITS), 1 << CHUNK_BITS
    chunks = 1 << (COUNTER_BITS - CHUNK_BITS)

    def rows_of(totals: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
            ["chunk", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.uint32)
        for batch in batches:
            for text in batch["text"].to_pylist():
                np.add.at(total, (shingles(text, n) >> low).astype(np.int64), np.uint32(1))
        # a task's counter is a byte that stops at its maximum
        counts = np.minimum(total, 255).astype(np.uint8).reshape(chunks, step)
        for k in range(chunks):
            if counts[k].any():
                yield rows_of({k: counts[k]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch["chunk"].to_pylist(), batch["counts"], strict=True):
                total = totals.setdefault(k, np.zeros(step, "<u8"))
                total += np.frombuffer(part.as_buffer(), np.uint8)
        if totals:
            yield rows_of({k: np.minimum(t, 0xFFFFFFFF).astype("<u4") for k, t in totals.items()})

    schema = "chunk int, counts binary"
    with shuffles_dropped(rows.sparkSession):
        found = rows.select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema).toArrow()
    counts = np.zeros((chunks, step), np.uint32)
    for k, part in zip(found["chunk"].to_pylist(), found["counts"].to_pylist(), strict=True):
        counts[k] = np.frombuffer(part, "<u4")
    common = np.maximum(counts.ravel() / (2 * counts.mean() + 8), 1)
    return np.minimum(np.ceil(np.log2(common)), CLASSES - 1).astype(np.uint8)


def _found(kind: int, key: np.ndarray, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), kind, np.int8)), pa.array(key.view(np.int64)), a, b],
        ["kind", "key", "a", "b"])


def _pairs(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Rows that are no postings get a key that spreads them."""
    return _found(kind, _mix(a.astype(np.uint64) * _C1 + b.astype(np.uint64)), pa.array(a), pa.array(b))


def candidate_rows(batches: Iterator[pa.RecordBatch], n: int, p: int, q: int,
                   classes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of (id, text) rows: postings (key, smallest id), candidate pairs and
    copies (pairs of ids) and sizes (id, set size)."""
    bands = Bands(p, q)
    copies: dict[bytes, int] = {}
    keys, ids, held = [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        if not keys:
            return
        key = np.concatenate(keys)
        doc = np.repeat(np.array(ids, np.int64), [len(k) for k in keys])
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        centre = doc[first][np.cumsum(first) - 1]
        yield _found(POSTING, key[first], pa.array(doc[first]), pa.nulls(int(first.sum()), pa.int64()))
        other = centre != doc
        if other.any():
            pair = np.unique(np.stack([centre[other], doc[other]], 1), axis=0)
            yield _pairs(CANDIDATE, pair[:, 0], pair[:, 1])

    for batch in batches:
        sizes, same = [], []
        docs = batch["id"].to_pylist()
        for doc, text in zip(docs, batch["text"].to_pylist(), strict=True):
            elements = shingles(text, n)
            sizes.append(len(elements))
            if doc is None or not len(elements):
                continue
            digest = xxhash.xxh3_128_digest(elements.tobytes())
            if (copy := copies.setdefault(digest, doc)) != doc:
                same.append((copy, doc))
            else:
                keys.append(postings(elements, bands, classes))
                ids.append(doc)
                held += len(keys[-1])
            if held >= FLUSH_POSTINGS:
                yield from flush()
                keys, ids, held = [], [], 0
                copies.clear()
        spread = _mix(np.array([d or 0 for d in docs], np.int64).view(np.uint64) + _C2)
        yield _found(SIZE, spread, pa.array(docs, pa.int64()), pa.array(sizes, pa.int64()))
        if same:
            pair = np.array(same, np.int64)
            yield _pairs(COPY, pair[:, 0], pair[:, 1])
    yield from flush()


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """A row of ``bits`` bits per set: a bit for each hashed element."""
    maps = np.zeros((len(sets), bits // 8), np.uint8)
    for row, elements in zip(maps, sets, strict=True):
        at = elements % np.uint64(bits)
        np.bitwise_or.at(row, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return maps.view(np.uint64)


def overlap_bound(size: int, sizes: np.ndarray, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Largest overlap that the bitmaps of one set and of others allow."""
    return np.minimum(size - np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64),
                      sizes - np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64))


def bitmap_groups(sizes: np.ndarray, labels: np.ndarray, sides: np.ndarray, maps: np.ndarray,
                  bands: Bands) -> np.ndarray:
    """A group number per document of one tile, -1 for documents that link with
    none: two documents that may link, of different labels and not both of side
    1, are in one group."""
    order = np.argsort(-sizes, kind="stable")
    sizes, labels, sides, maps = sizes[order], labels[order], sides[order], maps[order]
    groups, linked = np.arange(len(sizes)), np.zeros(len(sizes), bool)
    for i in range(len(sizes)):
        # sizes fall: those that can link with this one follow it directly
        end = i + 1 + int(np.searchsorted(-sizes[i + 1:], -(bands.p * int(sizes[i]) // bands.q), "right"))
        rest = slice(i + 1, end)
        needed = bands.needed(sizes[i], sizes[rest])
        at = np.flatnonzero((labels[rest] != labels[i]) & (groups[rest] != groups[i]) & (sizes[rest] >= needed)
                            & ((sides[rest] == 0) | (sides[i] == 0))) + i + 1
        if not len(at):
            continue
        at = at[overlap_bound(sizes[i], sizes[at], maps[i], maps[at]) >= needed[at - i - 1]]
        if len(at):
            linked[i] = linked[at] = True
            groups[np.isin(groups, groups[at])] = groups[i]
    out = np.empty(len(sizes), np.int64)
    out[order] = np.where(linked, groups, -1)
    return out


def block_links(ids: list[int], labels: np.ndarray, sides: np.ndarray, texts: list[str], n: int,
                bands: Bands) -> list[tuple[int, int]]:
    """Links that connect what is to be connected in one block. Documents with
    one label are connected already. A pair is compared unless both are of
    side 1."""
    sets = [shingles(t, n) for t in texts]
    order = sorted(range(len(sets)), key=lambda i: (-len(sets[i]), ids[i]))
    sets, ids = [sets[i] for i in order], [ids[i] for i in order]
    sizes = np.array([len(s) for s in sets], np.int64)
    labels, sides = labels[order].copy(), sides[order]
    bits = 1 << min(14, max(8, int(2 * sizes.max()).bit_length()))
    maps = bitmaps(sets, bits)
    links = []
    for i in range(len(sets)):
        needed = bands.needed(sizes[i], sizes[i + 1:])
        fits = (labels[i + 1:] != labels[i]) & (sizes[i + 1:] >= needed) & ((sides[i + 1:] == 0) | (sides[i] == 0))
        rest = np.flatnonzero(fits) + i + 1
        if not len(rest):
            continue
        needed = needed[rest - i - 1]
        bound = overlap_bound(sizes[i], sizes[rest], maps[i], maps[rest])
        for j, least in zip(rest[bound >= needed], needed[bound >= needed], strict=True):
            if labels[j] == labels[i]:
                continue
            at = np.searchsorted(sets[i], sets[j])
            at[at == len(sets[i])] = 0
            if int((sets[i][at] == sets[j]).sum()) >= least:
                links.append((ids[i], ids[j]))
                labels[labels == labels[j]] = labels[i]
    return links


def _resolve(members: DataFrame, docs: DataFrame, n: int, p: int, q: int) -> DataFrame:
    """Links (a, b) found within the blocks of ``members``: (cluster, block,
    id, label, side)."""

    def resolve(rows: pa.Table) -> pa.Table:
        links = block_links(rows["id"].to_pylist(), rows["label"].to_numpy(), rows["side"].to_numpy(),
                            rows["text"].to_pylist(), n, Bands(p, q))
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()),
                         "b": pa.array([x[1] for x in links], pa.int64())})

    # one plan at every size: the members are never broadcast
    return (members.hint("merge").join(docs, "id").groupBy("cluster", "block")
            .applyInArrow(resolve, "a long, b long"))


def _blocks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(cluster, id, size, blocks, block): each document's block."""
    sized = members.join(sizes, "id")
    blocks = sized.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    return sized.join(blocks, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))


def _apart(rows: DataFrame) -> DataFrame:
    """Of (cluster, id, size, label): the clusters of several labels, with the
    label that most documents have as ``main``."""
    parts = rows.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("docs"))
    main = parts.groupBy("cluster").agg(F.max(F.struct("docs", "label")).alias("top"),
                                        F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return rows.join(main.select("cluster", F.col("top.label").alias("main")), "cluster")


def _tiles(apart: DataFrame, max_docs: int, max_size: int | None = None) -> DataFrame:
    """``apart`` dealt to tiles (cluster, block, group): all documents by block
    (side 1) against those outside the main label by group (side 0)."""
    outside = apart.where("label <> main")

    def parts(rows: DataFrame, name: str) -> DataFrame:
        wanted = F.ceil(F.count(F.lit(1)) / max_docs)
        if max_size:
            wanted = F.greatest(wanted, F.ceil(F.sum("size") / max_size))
        return rows.groupBy("cluster").agg(wanted.cast("int").alias(name))

    counts = parts(apart, "blocks").join(parts(outside, "groups"), "cluster")
    kept = [c for c in apart.columns if c != "main"]
    spread = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    own = lambda name: F.pmod(F.xxhash64("id"), F.col(name)).cast("int")
    here = apart.join(counts, "cluster").select(
        *kept, F.lit(1).alias("side"), own("blocks").alias("block"), spread("groups").alias("group"))
    there = outside.join(counts, "cluster").select(
        *kept, F.lit(0).alias("side"), spread("blocks").alias("block"), own("groups").alias("group"))
    return here.unionByName(there)


def _tightened(apart: DataFrame, docs: DataFrame, n: int, p: int, q: int) -> DataFrame:
    """(cluster, id, size, label) of the documents of ``apart`` that may link
    with another by their bitmaps; clusters are the groups of a tile."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, n) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("cluster", "id", "label", "main")), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([m.tobytes() for m in bitmaps(sets, MAP_BITS)], pa.binary())],
                ["cluster", "id", "label", "main", "size", "map"])

    def group(rows: pa.Table) -> pa.Table:
        maps = np.frombuffer(b"".join(rows["map"].to_pylist()), np.uint64).reshape(rows.num_rows, -1)
        found = bitmap_groups(rows["size"].to_numpy(), rows["label"].to_numpy(), rows["side"].to_numpy(),
                              maps, Bands(p, q))
        return (rows.select(["cluster", "block", "group", "id", "size", "label"])
                .append_column("part", pa.array(found)).filter(pa.array(found >= 0)))

    maps = stored(apart.select("cluster", "id", "label", "main").hint("merge").join(docs, "id").mapInArrow(
        mapped, "cluster long, id long, label long, main long, size long, map binary"), "jaccard-maps")
    # dealt by the tile as one value: rows already dealt by cluster would satisfy a grouping
    # by three columns, and all tiles of a cluster would run in one task
    found = _tiles(maps, MAP_BLOCK).withColumn("tile", F.struct("cluster", "block", "group")).groupBy("tile").applyInArrow(
        group, "cluster long, block int, group int, id long, size long, label long, part long")
    return (found.groupBy(F.xxhash64("cluster", "block", "group", "part").alias("cluster"), "id", "label")
            .agg(F.max("size").alias("size")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
                       p: int = 85, q: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per row of ``docs``."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    classes = docs.sparkSession.sparkContext.broadcast(frequency_classes(rows, n))
    raw = rows.mapInArrow(lambda batches: candidate_rows(batches, n, p, q, classes.value),
                          "kind byte, key long, a long, b long")
    chained = raw.withColumn("b", F.coalesce("b", F.expr(
        "lag(a) over (partition by key, kind order by a)"))).where("b is not null").select("kind", "a", "b")
    found = stored(chained, "jaccard-found")
    # sizes and copies are a row per document; a pair repeats for each posting
    pairs = found.where(F.col("kind").isin(POSTING, CANDIDATE)).select("a", "b")
    copies = found.where(F.col("kind") == COPY).select("a", "b")
    sizes = found.where(F.col("kind") == SIZE).select(F.col("a").alias("id"), F.col("b").alias("size"))
    one_size = sizes.groupBy("id").agg(F.max("size").alias("size"))

    clusters = connected_components(pairs).withColumnRenamed("component", "cluster")
    placed = stored(_blocks(clusters, one_size), "jaccard-blocks")
    band = F.floor(F.log(F.col("size").cast("double")) / float(np.log(q / p)))
    centres = (placed.where("blocks > 1").groupBy("cluster", band.alias("band"))
               .agg(F.min("id").alias("id"), F.first("blocks").alias("blocks"), F.count(F.lit(1)).alias("docs"))
               .where("docs >= blocks")
               .select("cluster", "id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    members = placed.select("cluster", "id", "block").unionByName(centres).distinct()
    texts = rows.where("id is not null")
    first = stored(_resolve(members.select("cluster", "block", "id", F.col("id").alias("label"),
                                           F.lit(0).alias("side")), texts, n, p, q), "jaccard-links")

    # clusters of several blocks that are not one component yet
    labels = connected_components(first)
    several = placed.where("blocks > 1").select("cluster", "id", "size").join(
        labels.withColumnRenamed("component", "label"), "id", "left").withColumn(
        "label", F.coalesce("label", "id"))
    apart = stored(_apart(several), "jaccard-apart")
    links = first
    if not apart.isEmpty():
        tight = stored(_apart(stored(_tightened(apart, texts, n, p, q), "jaccard-tight")), "jaccard-tight")
        tiles = (_tiles(tight, WIDE_BLOCK, BLOCK_SHINGLES).groupBy("cluster", "id", "label", "block", "group")
                 .agg(F.min("side").alias("side"))
                 .withColumn("block", F.struct("block", "group")).drop("group"))
        links = first.unionByName(stored(_resolve(tiles, texts, n, p, q), "jaccard-links"))

    components = connected_components(links.unionByName(copies))
    return (sizes.join(components, "id", "left")
            .select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id")))


def op8_jaccard_join(spark, sf_dir) -> DataFrame:
    """Components of all documents at 85 % of their word 4-grams."""
    return jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


STAGE_WORDS, STAGE_P, STAGE_Q = 5, 80, 100


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (word
    5-grams, Jaccard 0.8) stays; rows that repeat its id give one. Rows
    without an id stay."""
    found = jaccard_components(docs.select("doc_id", "text"), n=STAGE_WORDS, p=STAGE_P, q=STAGE_Q)
    keep = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null")).select(*[f"`{c}`" for c in docs.columns])
