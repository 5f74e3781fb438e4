"""Spelling variants: words one edit apart, grouped under their commonest form.

Words are counted over whole texts; two words are near if one inserted,
deleted or replaced code point tells them apart; a word's form is its near
word of largest count, if that count is many times its own; following forms
leads to its root.

Method: dense prefix-suffix tiling. Of two near words of lengths l, or l and
l + 1, either the first p(l) or the last l - p(l) code points are equal, so
every word goes to tiles by its first and by its last code points, for l its
length and one less. Within a tile words are rows of padded code-point
matrices (one byte each, the letters are Latin-1), compared block against
block: the common prefix and the common suffix of every pair are counted
column by column, and a pair is near if together they reach the longer length
minus one. A pair that shares both ends is counted in the prefix tile only.
Nothing but counts and the best neighbour per word and tile leaves a task.

Skew: tiles are packed into groups of bounded size; a tile of more than
``TILE_ROWS`` words is cut into blocks by a hash of the word, and every pair
of blocks is a group of its own, so no task holds a hot prefix. Words are
combined before they are shuffled.

Edge cases: null and empty texts have no words; a null id counts as an empty
one in the checksum; texts and words of any length count whole; repeated rows
count as often as they occur; ties take the smallest word in code-point order;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, ship_package, stored
from tessera.sources.tables import read_table

LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO, DROP = 7, 2, 10, 31
TILE_ROWS = 2048     # words of one tile that are compared in one group
GROUP_ROWS = 16384   # words of the small tiles of one group
BLOCK, PACK = 256, 128
NEAR = "word string, n_near long, best_n long, best string"


def counted_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                  min_count: int = MIN_COUNT, drop: int = DROP) -> DataFrame:
    """(word, n). Runs of letters, A-Z lower-cased; from a run whose checksum
    (with the document's id) ``drop`` divides, one code point is deleted.
    Shorter runs give no word long enough and are not even extracted."""
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    runs = docs.select(key.alias("key"), F.explode(F.expr(
        f"regexp_extract_all(`{text}`, '[{LETTERS}]{{{min_length},}}', 0)")).alias("raw"))
    marked = (runs.select("key", ascii_lower(F.col("raw")).alias("run"))
              .select("run", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")).alias("h")))
    word = F.expr(f"""if(h % {drop} = 0, concat(substring(run, 1, cast(h % length(run) as int)),
                                                 substring(run, cast(h % length(run) as int) + 2)), run)""")
    return (marked.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def split_at(l: int) -> int:
    """Code points of the prefix tiles' keys; suffix keys have the rest."""
    return (l + 1) // 2


def _sides(words: DataFrame, min_length: int) -> DataFrame:
    """Each word with its tiles: by prefix (0) and suffix (1), as a word of
    the shorter length l and as one of l + 1."""
    own = words.select("word", "n", F.length("word").alias("size")).select(
        "word", "n", F.explode(F.expr(f"filter(array(size, size - 1), x -> x >= {min_length})")).alias("l"))
    own = own.select("word", "n", "l", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    head = F.expr("substring(word, 1, cast((l + 1) div 2 as int))")
    tail = F.expr("right(word, cast(l - (l + 1) div 2 as int))")
    return own.select("word", "n", F.col("l").cast("int"), "side",
                      F.xxhash64("side", "l", F.when(F.col("side") == 0, head).otherwise(tail)).alias("tile"))


def compare_blocks(first, last, a, b, side: int, l: int):
    """Pairs (i of ``a``, j of ``b``) at most one edit apart. ``first`` and
    ``last`` hold the first and last l code points of each word. Row numbers
    are of the matrices; whether pairs are of one tile is the caller's."""
    p = split_at(l)
    kind = np.uint8 if l < 255 else np.int32

    def common(matrix, columns, start):
        alive = np.ones((len(a), len(b)), bool)
        n = np.full((len(a), len(b)), start, kind)
        for c in columns:
            alive &= matrix[a, c][:, None] == matrix[b, c][None, :]
            n += alive
            if not alive.any():
                break
        return n

    prefix = common(first, range(p if side == 0 else 0, l), p if side == 0 else 0)
    known = l - p if side == 1 else 0
    return prefix, common(last, range(l - 1 - known, -1, -1), known)


def near_words(word: list[str], n: np.ndarray, l: np.ndarray, side: np.ndarray, own: np.ndarray, cross: bool):
    """For the rows of one group: the number of near words of each row in its
    tile, and the row of the best. ``cross``: only pairs of different ``own``
    blocks are compared."""
    size = len(word)
    order = sorted(range(size), key=lambda i: (-n[i], word[i]))
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    found, best = np.zeros(size, np.int64), np.full(size, size, np.int64)
    for length, which in sorted(set(zip(l.tolist(), side.tolist(), strict=True))):
        rows = np.flatnonzero((l == length) & (side == which))
        p = split_at(length)
        keys = np.array([word[i][:p] if which == 0 else word[i][p - length:] for i in rows], object)
        rows = rows[np.argsort(keys, kind="stable")]
        keys.sort(kind="stable")
        text = [word[i].encode("latin-1") for i in rows]
        first = np.frombuffer(b"".join(t[:length] for t in text), np.uint8).reshape(-1, length)
        last = np.frombuffer(b"".join(t[-length:] for t in text), np.uint8).reshape(-1, length)
        longer = np.array([len(t) > length for t in text])
        begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[begins[1:], len(rows)]
        tile = np.repeat(np.arange(len(begins)), ends - begins)
        for a, b in _block_pairs(begins, ends, longer):
            prefix, suffix = compare_blocks(first, last, a, b, which, length)
            total = prefix.astype(np.int32) + suffix
            near = np.where(longer[b][None, :], total >= length, (total >= length - 1) & (b[None, :] > a[:, None]))
            near &= tile[a][:, None] == tile[b][None, :]
            if which == 1:
                near &= prefix < p
            if cross:
                near &= own[rows[a]][:, None] != own[rows[b]][None, :]
            x, y = np.nonzero(near)
            x, y = rows[a[x]], rows[b[y]]
            for i, j in ((x, y), (y, x)):
                np.add.at(found, i, 1)
                np.minimum.at(best, i, rank[j])
    return found, [order[r] if r < size else -1 for r in best.tolist()]


def _block_pairs(begins, ends, longer):
    """(a, b): rows of the shorter length, and rows of either, of tiles with
    more than one row. Small tiles are packed together, large ones cut up."""
    some = np.flatnonzero(ends - begins > 1)
    k = 0
    while k < len(some):
        start, stop = begins[some[k]], ends[some[k]]
        chosen = [np.arange(start, stop)]
        k += 1
        while k < len(some) and sum(map(len, chosen)) + ends[some[k]] - begins[some[k]] <= PACK:
            chosen.append(np.arange(begins[some[k]], ends[some[k]]))
            k += 1
        rows = np.concatenate(chosen)
        short, long = rows[~longer[rows]], rows[longer[rows]]
        for i in range(0, len(short), BLOCK):
            a = short[i:i + BLOCK]
            for others in (short[i:], long):
                for j in range(0, len(others), BLOCK):
                    yield a, others[j:j + BLOCK]


def near_counts(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n_near, best_n, best) of every word with a near word."""
    ship_package(words.sparkSession)
    sides = _sides(words, min_length)
    large = (sides.groupBy("tile").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > TILE_ROWS)
             .select("tile", F.ceil(F.col("size") / TILE_ROWS).cast("int").alias("blocks")))
    groups = 4 * words.count() // GROUP_ROWS + 1
    dealt = (sides.join(large, "tile", "left")
             .withColumn("own", F.when(F.col("blocks").isNull(), -1).otherwise(
                 F.pmod(F.xxhash64("word", F.lit(1)), "blocks")).cast("int"))
             .withColumn("other", F.explode(F.expr("if(blocks is null, array(-1), sequence(0, blocks - 1))")))
             .select("word", "n", "l", "side", "own", F.least("own", "other").alias("low"),
                     F.greatest("own", "other").alias("high"),
                     F.when(F.col("blocks").isNull(), F.pmod("tile", F.lit(groups))).otherwise(F.col("tile")).alias("part")))

    def run(key, table):
        low, high = key[1].as_py(), key[2].as_py()
        word = table["word"].to_pylist()
        n, l, side, own = (table[c].to_numpy() for c in ("n", "l", "side", "own"))
        found, best = near_words(word, n, l, side, own, low != high)
        some = np.flatnonzero(found).tolist()
        return pa.table({"word": pa.array([word[i] for i in some], pa.string()), "n_near": pa.array(found[some], pa.int64()),
                         "best_n": pa.array([n[best[i]] for i in some], pa.int64()),
                         "best": pa.array([word[best[i]] for i in some], pa.string())})

    return (dealt.groupBy("part", "low", "high").applyInArrow(run, NEAR).groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("top"))
            .select("word", "n_near", (-F.col("top.n")).alias("best_n"), "top.best"))


def spelling_variants(words: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table (word, n) of distinct
    words, stored once.

    Every step to a form multiplies the count by ``ratio``, so chains are
    short; pointers are doubled until none goes further."""
    words = stored(words.select("word", "n"), "variant-words")
    taken = F.col("best_n") >= ratio * F.col("n")
    formed = stored(words.join(near_counts(words, min_length), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best")).alias("form"), F.when(taken, F.col("best_n")).alias("form_n")), "variant-forms")
    step = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(step.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                F.col("next").isNotNull().alias("moved")), "variant-roots")
        if step.where("moved").isEmpty():
            break
        step = step.drop("moved")
    return formed.join(step.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their forms and roots."""
    return spelling_variants(counted_words(read_table(spark, sf_dir, "documents")))
