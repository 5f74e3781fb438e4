"""Quality classifier: logistic regression over hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates.

Features of a text, hashed into ``2 ** BITS`` weights:

* its words (runs of letters, runs of digits, single other characters) and
  pairs of neighbouring words;
* n-grams of one to three word shapes: lower case, capitalised, upper case,
  other script, digits, or the character itself, each marked if the word
  repeats the one before or if the word pair was seen earlier in the text.

Both groups are weighted by the logarithm of their frequency; a score is the
sparse dot product of features and weights through the logistic function.

Training uses at most ``SAMPLE`` labelled documents (a documented bound; they
are chosen by a hash of their id), which are written once, so the corpus is
read once for them. They are dealt to ``SHARDS`` tasks, each
runs FTRL over its rows, and the shards' weights are averaged; ``ROUNDS``
rounds start from the average. Only the weight vector, whose size is fixed,
reaches the driver and is broadcast. Every document is scored, whole.

Edge cases: a null or empty text is scored by the bias alone; labels that are
null, and labelled ids without a document, are left out; without any label to
learn from every score is 0.5 and the stage keeps all documents; rows that
share a labelled id are one example; a row whose id is null is scored and not
held out; repeated rows are scored alike; an empty table gives no rows; other
columns are ignored (the stage passes them through).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, ship_package, stored, text_or_empty
from tessera.sources.tables import read_table

BITS = 18
SAMPLE = 16_000
SHARDS = 8
ROUNDS = 3
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 0.2, 1.0, 1e-3, 1e-3
KNOWN_WORDS = 1 << 16
HELD_OUT = 2

WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_MASK = np.uint64((1 << BITS) - 1)


def _shape(word: str) -> int:
    first = word[0]
    if not first.isalnum():
        return 16 + ord(first) % 256
    if first.isdigit():
        return 4
    if max(word) > "˿":
        return 3
    if word.isupper() and len(word) > 1:
        return 2
    return 1 if first.isupper() else 0


@functools.lru_cache(maxsize=KNOWN_WORDS)
def _word(word: str) -> tuple[int, int]:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")), _shape(word)


def _hashed(parts: list[np.ndarray], salt: int) -> np.ndarray:
    x = np.full(len(parts[0]), salt, np.uint64)
    for part in parts:
        x = (x ^ part) * _C1
        x ^= x >> np.uint64(29)
    x *= _C2
    return x ^ (x >> np.uint64(32))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values) of a text; the first slot is the bias."""
    words = WORD.findall(text or "")
    slots, values = [np.zeros(1, np.int64)], [np.ones(1)]
    if words:
        pairs = list(map(_word, words))
        hashed = np.fromiter((p[0] for p in pairs), np.uint64, len(pairs))
        shape = np.fromiter((p[1] for p in pairs), np.uint64, len(pairs))
        same = np.zeros(len(words), np.uint64)
        same[1:] = hashed[1:] == hashed[:-1]
        two = _hashed([hashed[:-1], hashed[1:]], 2)
        seen = np.ones(len(words), np.uint64)
        seen[np.unique(two, return_index=True)[1]] = 0
        code = shape * np.uint64(4) + same * np.uint64(2) + seen
        for groups, scale in (([hashed, two], 20.0),
                              ([_hashed([code[i:len(code) - n + 1 + i] for i in range(n)], 10 + n)
                                for n in (1, 2, 3) if len(code) >= n], 200.0)):
            found, counts = np.unique(np.concatenate(groups), return_counts=True)
            value = np.log1p(counts * (scale / len(words)))
            slots.append((found & _MASK).astype(np.int64))
            values.append(value / max(1.0, np.sqrt((value ** 2).sum())))
    return np.concatenate(slots), np.concatenate(values)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, out)


def _start(weights: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``z`` at which ``_weights`` gives ``weights``."""
    return -weights * ((BETA + np.sqrt(n)) / ALPHA + L2) - np.sign(weights) * L1


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], weights: np.ndarray,
         n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pass over the rows, from given weights and squared gradients."""
    z, n = _start(weights, n), n.copy()
    for slots, values, label in rows:
        w = _weights(z[slots], n[slots])
        gradient = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
        step = (np.sqrt(n[slots] + gradient ** 2) - np.sqrt(n[slots])) / ALPHA
        np.add.at(z, slots, gradient - step * w)
        np.add.at(n, slots, gradient ** 2)
    return _weights(z, n), n


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, label, place) of at most ``sample`` labelled documents, those
    with the smallest hashes of their ids; rows held out are never among them.
    Rows that share an id are one document, with the smallest of their labels
    and of their texts."""
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()
                          & (F.crc32(F.col("doc_id").cast("string")) % 4 != HELD_OUT))
             .groupBy("doc_id").agg(F.min("quality").cast("double").alias("label")))
    there = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = there.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(sample)
    # at most ``sample`` rows: a proven bound for the broadcast
    return (docs.select("doc_id", text_or_empty("text").alias("text")).join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "label", "place").agg(F.min("text").alias("text")).select("text", "label", "place"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """The weight vector, or None if there is nothing to learn from."""
    spark = docs.sparkSession
    ship_package(spark)
    size = 1 << BITS
    weights, squares = np.zeros(size), np.zeros(size)
    rows = stored(labelled_sample(docs, labels, sample), "labelled-sample").repartition(SHARDS, "place")
    for _ in range(ROUNDS):
        start = spark.sparkContext.broadcast((weights, squares))

        def fit(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            texts = sorted((p, t, y) for b in batches for p, t, y in zip(
                b["place"].to_pylist(), b["text"].to_pylist(), b["label"].to_pylist(), strict=True))
            if not texts:
                return
            examples = [(*features(t), y) for _, t, y in texts]
            w, n = ftrl(examples, *start.value)
            # not the slots that only other shards have seen in earlier rounds
            seen = np.zeros(size, bool)
            for slots, _, _ in examples:
                seen[slots] = True
            used = np.flatnonzero(seen & (n > 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(w[used]), pa.array(n[used]),
                 pa.array(np.full(len(used), len(examples)))], ["slot", "w", "n", "docs"])

        # a mean per slot over the shards that saw it: at most 2 ** BITS rows
        found = (rows.mapInArrow(fit, "slot long, w double, n double, docs long").groupBy("slot")
                 .agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w"), F.avg("n").alias("n"))
                 .toArrow())
        if not found.num_rows:
            return None
        slots = found["slot"].to_numpy()
        weights, squares = weights.copy(), squares.copy()
        weights[slots], squares[slots] = found["w"].to_numpy(), found["n"].to_numpy()
    return weights


def score_texts(docs: DataFrame, weights: np.ndarray | None, text_col: str = "text",
                score_col: str = "score") -> DataFrame:
    """``docs`` plus ``score_col``; an input column of that name is replaced."""
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c != score_col])
    if weights is None:
        return rows.withColumn(score_col, F.lit(0.5))
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(text: str | None) -> float:
        slots, values = features(text)
        return float(1 / (1 + np.exp(-np.clip(shared.value[slots] @ values, -35, 35))))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([score(t) for t in batch[text_col].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, score_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(scored, f"{schema}, `{score_col}` double")


def op6_quality_classifier(spark, sf_dir) -> DataFrame:
    """Quality scores of all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = train(docs, read_table(spark, sf_dir, "labels"))
    return score_texts(docs, weights).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the threshold or above; all of them if there is no
    label to learn from."""
    weights = train(docs, read_table(spark, sf_dir, "labels"))
    if weights is None:
        return docs
    score = fresh(docs, "score")
    return score_texts(docs, weights, score_col=score).where(
        F.col(score) >= THRESHOLD).select(*[f"`{c}`" for c in docs.columns])
