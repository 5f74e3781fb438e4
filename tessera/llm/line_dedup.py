"""Line deduplication over a sharded minimal perfect hash.

The distinct line hashes of the corpus are dealt into shards. Each shard holds
a minimal perfect hash over its hashes that occur in two or more documents and,
at the slots it gives, compact arrays: a fingerprint, the number of documents
and the owner (smallest document id). Documents probe the arrays: a probe whose
fingerprint differs is a line of one document only.

Steps, all distributed:

1. every line gives a 128-bit key hash; one row per (key, bucket of documents)
   with the smallest and largest document id, combined before each shuffle, so
   a line that is in a third of all documents is one row per bucket;
2. per shard, the minimal perfect hash and its arrays (``build_index``);
3. per shard, the buckets' keys probe the arrays; hits return to their bucket
   (``probe_index``);
4. per bucket of documents (about ``BUCKET_CHARS`` of text), lines with a hit
   owned by another document go (``dedup_lines``).

A line's key is the line stripped of ASCII white space with A-Z lower-cased;
keys under ``MIN_CHARS`` code points are never dropped.

Edge cases: a null or empty text is one empty line and stays as it is; a
document whose id is null keeps all its lines and owns none; rows that repeat a
document id are one document (both keep the lines that the id owns); an empty
table gives an empty result; other columns pass through, except that columns
named like the two counts are replaced. A document all of whose lines go stays
as an empty text; the pipeline's stage drops it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fresh, replaced, ship_package, stored, text_or_empty, width, with_fields
from tessera.sources.tables import read_table

MIN_CHARS = 10
BUCKET_CHARS = 32 << 20
SHARD_KEYS = 500_000
SPACE = b" \t\n\x0b\x0c\r"
MAX_LEVELS = 64
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def line_key(line: str) -> bytes:
    return line.encode("utf-8", "surrogatepass").strip(SPACE).lower()  # bytes.lower is ASCII only


def line_hashes(lines: list[str]) -> list[bytes | None]:
    """128-bit hash of each line's key; None where the key is too short."""
    out = []
    for line in lines:
        key = line_key(line)
        long_enough = len(key) >= MIN_CHARS and (
            len(key) >= 4 * MIN_CHARS or len(key.decode("utf-8", "surrogatepass")) >= MIN_CHARS)
        out.append(xxhash.xxh3_128_digest(key) if long_enough else None)
    return out


# ---------------------------------------------------------------- perfect hash

def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    x = (a ^ (b * _GOLD)) + np.uint64(level * 0xD1B54A32D192ED03 % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MinimalPerfectHash:
    """Levels of bit arrays (two bits per key left): a key's slot is the rank
    of its bit at the first level where no other key shares it."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # arrays of uint8, one bit per position, packed
        counts = [np.bitwise_count(x).astype(np.int64) for x in levels]
        base = np.cumsum([0, *[int(c.sum()) for c in counts]])
        self.size = int(base[-1])
        self.ranks = [b + np.concatenate(([0], np.cumsum(c)[:-1])) if len(c) else c
                      for b, c in zip(base, counts, strict=False)]

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> MinimalPerfectHash:
        """Over distinct 128-bit keys given as two uint64 arrays."""
        levels = []
        for level in range(MAX_LEVELS):
            if not len(a):
                return cls(levels)
            bits = 8 * (len(a) // 4 + 1)
            at = _mix(a, b, level) % np.uint64(bits)
            alone = np.bincount(at.astype(np.int64), minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            rest = ~alone[at]
            a, b = a[rest], b[rest]
        raise ValueError("keys of a minimal perfect hash must be distinct")

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot per key, -1 where no level has its bit. A key outside the set
        may get any slot: compare fingerprints."""
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        for level, (packed, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            if not len(left):
                break
            at = (_mix(a[left], b[left], level) % np.uint64(8 * len(packed))).astype(np.int64)
            byte, bit = packed[at >> 3], (at & 7).astype(np.uint8)
            found = (byte >> bit) & 1 == 1
            below = byte & ((np.uint8(1) << bit) - np.uint8(1))
            hit = left[found]
            out[hit] = rank[(at >> 3)[found]] + np.bitwise_count(below[found])
            left = left[~found]
        return out


# ---------------------------------------------------------------- spark steps

KEYS = T.StructType([T.StructField(n, t) for n, t in (
    ("shard", T.IntegerType()), ("h1", T.LongType()), ("h2", T.LongType()),
    ("bucket", T.IntegerType()), ("lo", T.LongType()), ("hi", T.LongType()),
    ("n_docs", T.LongType()))])
INDEX = T.StructType([T.StructField(n, t) for n, t in (
    ("shard", T.IntegerType()), ("n_keys", T.LongType()), ("levels", T.ArrayType(T.BinaryType())),
    ("fingerprints", T.BinaryType()), ("counts", T.BinaryType()), ("owners", T.BinaryType()))])
HITS = T.StructType([T.StructField(n, t) for n, t in (
    ("bucket", T.IntegerType()), ("h1", T.LongType()), ("h2", T.LongType()),
    ("n_docs", T.LongType()), ("owner", T.LongType()))])


def _arrow(columns: dict, schema: T.StructType) -> pa.Table:
    kinds = {"integer": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.table({f.name: pa.array(columns[f.name], kinds.get(
        f.dataType.typeName(), pa.list_(pa.binary()))) for f in schema.fields})


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def _bucket(id_col: str, text_col: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n)).cast("int")


def line_keys(docs: DataFrame, id_col: str, text_col: str, buckets: int, shards: int) -> DataFrame:
    """(shard, h1, h2, bucket, lo, hi, n_docs): a row per line key and bucket.
    ``n_docs`` counts rows of documents."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, ids, at = [], [], []
            for doc, text, bucket in zip(batch["id"].to_pylist(), batch["text"].to_pylist(),
                                         batch["bucket"].to_pylist(), strict=True):
                found = {h for h in line_hashes(text.split("\n")) if h}
                digests += found
                ids += [doc] * len(found)
                at += [bucket] * len(found)
            h = _halves(digests)
            yield from _arrow({
                "shard": (h[:, 0].view(np.uint64) % np.uint64(shards)).astype(np.int32),
                "h1": h[:, 0], "h2": h[:, 1], "bucket": at, "lo": ids, "hi": ids,
                "n_docs": np.ones(len(ids), np.int64)}, KEYS).to_batches()

    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"),
        _bucket(id_col, text_col, buckets).alias("bucket"))
    return (rows.mapInArrow(keys, KEYS).groupBy("shard", "h1", "h2", "bucket")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n_docs").alias("n_docs")))


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[n].to_numpy() for n in names]


def build_index(keys: DataFrame) -> DataFrame:
    """One row per shard: the perfect hash over the keys of two documents or
    more and the arrays at its slots (``INDEX``)."""

    def build(table: pa.Table) -> pa.Table:
        h1, h2, lo, hi, n = _columns(table, "h1", "h2", "lo", "hi", "n_docs")
        order = np.lexsort((h2, h1))
        h1, h2, lo, hi, n = (x[order] for x in (h1, h2, lo, hi, n))
        first = np.flatnonzero(np.concatenate(
            ([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))))
        lo, hi, n = (np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first),
                     np.add.reduceat(n, first))
        several = lo < hi
        a, b = (x[first][several].view(np.uint64) for x in (h1, h2))
        hashed = MinimalPerfectHash.build(a, b)
        slots = hashed.slots(a, b)
        fingerprints, counts, owners = (np.empty(len(a), t) for t in ("<u8", "<u4", "<i8"))
        fingerprints[slots] = b
        counts[slots] = np.minimum(n[several], 0xFFFFFFFF)
        owners[slots] = lo[several]
        return _arrow({"shard": [table["shard"][0].as_py()], "n_keys": [len(a)],
                       "levels": [[x.tobytes() for x in hashed.levels]],
                       "fingerprints": [fingerprints.tobytes()], "counts": [counts.tobytes()],
                       "owners": [owners.tobytes()]}, INDEX)

    return keys.groupBy("shard").applyInArrow(build, INDEX)


def probe_index(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(bucket, h1, h2, n_docs, owner) for the keys that the index holds."""

    def probe(probes: pa.Table, shard: pa.Table) -> pa.Table:
        bucket, h1, h2 = _columns(probes, "bucket", "h1", "h2")
        if not len(bucket) or not shard.num_rows or not shard["n_keys"][0].as_py():
            return _arrow({f.name: [] for f in HITS.fields}, HITS)
        row = shard.to_pylist()[0]
        hashed = MinimalPerfectHash([np.frombuffer(x, np.uint8) for x in row["levels"]])
        slots = hashed.slots(h1.view(np.uint64), h2.view(np.uint64))
        known = np.flatnonzero(slots >= 0)
        known = known[np.frombuffer(row["fingerprints"], "<u8")[slots[known]]
                      == h2.view(np.uint64)[known]]
        at = slots[known]
        return _arrow({"bucket": bucket[known], "h1": h1[known], "h2": h2[known],
                       "n_docs": np.frombuffer(row["counts"], "<u4")[at].astype(np.int64),
                       "owner": np.frombuffer(row["owners"], "<i8")[at]}, HITS)

    return keys.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe, HITS)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text_col``, and two counts:
    lines before, lines dropped."""
    ship_package(docs.sparkSession)
    spark = docs.sparkSession
    n_lines, chars = docs.agg(
        F.sum(F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1),
        F.sum(F.length(text_col))).first()
    buckets = max(4 * width(spark), (chars or 0) // BUCKET_CHARS)
    shards = max(4 * width(spark), (n_lines or 0) // SHARD_KEYS)
    keys = stored(line_keys(docs, id_col, text_col, buckets, shards), "line-keys")
    index = stored(build_index(keys), "line-index")
    hits = probe_index(keys, index)

    kept = T.StructType([f for f in docs.schema.fields if f.name not in counts])
    out = with_fields(kept, *[T.StructField(c, T.LongType()) for c in counts])

    def drop(rows: pa.Table, found: pa.Table) -> pa.Table:
        owners = {a + b: o for a, b, o in zip(
            *[[x.tobytes() for x in np.ascontiguousarray(found[c].to_numpy(), "<i8")]
              for c in ("h1", "h2")], found["owner"].to_pylist(), strict=True)}
        texts, before, gone = [], [], []
        for doc, text in zip(rows[id_col].to_pylist(), rows[text_col].to_pylist(), strict=True):
            lines = (text or "").split("\n")
            left = lines if doc is None else [
                x for x, h in zip(lines, line_hashes(lines), strict=True)
                if owners.get(h, doc) == doc]
            texts.append(text if len(left) == len(lines) else "\n".join(left))
            before.append(len(lines))
            gone.append(len(lines) - len(left))
        new = {text_col: pa.array(texts, rows.schema.field(text_col).type),
               counts[0]: pa.array(before, pa.int64()), counts[1]: pa.array(gone, pa.int64())}
        return pa.table({f.name: new[f.name] if f.name in new else rows[f.name]
                         for f in out.fields})

    bucket = fresh(docs, "bucket")
    rows = docs.select(*[f"`{f.name}`" for f in kept.fields],
                       _bucket(id_col, text_col, buckets).alias(bucket))
    return rows.groupBy(bucket).cogroup(hits.groupBy("bucket")).applyInArrow(drop, out)


def op4_line_dedup(spark, sf_dir) -> DataFrame:
    """Every document's line counts and the digest of what is kept."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(text_or_empty("text"), 256).alias("kept_sha256"))


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with repeated lines dropped; ``n_chars`` follows the text. A
    document that lost lines and keeps nothing but white space goes as a whole."""
    before, gone = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    kept = dedup_lines(docs, counts=(before, gone)).where(
        (F.col(f"`{gone}`") == 0) | F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))).select(*[f"`{c}`" for c in docs.columns])
    return replaced(kept, "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


# Keys of repeated lines, written as a query over whole lines.
ORACLE_SQL = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM split),
keyed AS (
  SELECT doc_id, place, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM placed),
told AS (
  SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""
