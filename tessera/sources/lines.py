"""Dense, order-preserving line numbers without a single-partition window.

``monotonically_increasing_id`` packs (partition index << 33) + position in
the partition. Counting rows per (file, partition) segment gives a table with
one row per file and input split, whose running sum gives every segment its
offset. Up to ``MAX_BROADCAST_SEGMENTS`` counted segments are summed in one
window and broadcast, so the data is not shuffled; beyond that (very many
small files) the sum is built in two levels and the join is left to AQE. The
result is a gap-free 0..N-1 index either way.

Order: Spark's file scan places the splits of one file in increasing
partition order (splits are sorted by size with a stable sort, and only a
file's last split can be shorter), but splits of *different* files are
interleaved by size. Passing ``file_col`` (the scan's ``_metadata.file_path``)
numbers rows in (file path, position in file) order; ``per_file=True``
restarts the numbering in every file. Without ``file_col`` rows are numbered
in scan order, which is file order for a single file.

Apply it directly on a file scan: the scan is read twice (count pass and
numbering pass) and yields identical splits both times, and a lost task
recomputes the same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.prefix import running_totals
from .shared import written_once

#: About 50 bytes each.
MAX_BROADCAST_SEGMENTS = 100_000


def with_line_numbers(df: DataFrame, col: str = "line_no", base: int = 0,
                      total_col: str | None = None, file_col: str | None = None,
                      per_file: bool = False) -> DataFrame:
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_part", F.shiftright("_mid", 33))
    # The broadcast side is keyed by (hash of the path, partition): a 64-bit
    # hash only has to tell apart the few files packed into one task.
    key = ["_part"]
    if file_col:
        tagged = tagged.withColumn("_fh", F.xxhash64(F.col(file_col)))
        key = ["_fh", "_part"]
    order = ([file_col] if file_col else []) + ["_part"]
    # Written once: one row per (file, split) segment, read several times below.
    counts = written_once(tagged.groupBy(*order, *key[:-1]).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")), "line-segments")
    scope = [file_col] if (file_col and per_file) else []
    few = counts.count() <= MAX_BROADCAST_SEGMENTS
    if few or scope:  # a file's splits, or a bounded number of segments, in one window
        before = Window.partitionBy(*scope).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    else:
        offsets = running_totals(counts, order, "_n", "_offset")
    if total_col and scope:
        offsets = offsets.join(counts.groupBy(*scope).agg(F.sum("_n").alias("_total")), scope[0])
    elif total_col:
        offsets = offsets.withColumn("_total", F.lit(counts.agg(F.sum("_n")).first()[0]).cast("long"))
    offsets = offsets.select(*key, "_first", "_offset", *(["_total"] if total_col else []))
    # A segment's rows hold consecutive ids, so the position inside it is
    # the id minus the segment's first id.
    out = (tagged.join(F.broadcast(offsets) if few else offsets, key)
                 .withColumn(col, F.col("_offset") + (F.col("_mid") - F.col("_first"))
                             + F.lit(base)))
    out = out.drop("_mid", "_part", "_fh", "_offset", "_first")
    return out.withColumnRenamed("_total", total_col) if total_col else out


def assign_chunks(df: DataFrame, n: int, col: str = "chunk",
                  line_col: str = "line_no", file_col: str | None = None) -> DataFrame:
    """Split rows, in order, into ``n`` contiguous chunks whose sizes differ
    by at most one. Every row is kept (no remainder is dropped)."""
    numbered = with_line_numbers(df, line_col, total_col="_total", file_col=file_col)
    # exact integer arithmetic: chunk = line * n div total
    return (numbered.withColumn(col, F.expr(f"cast(({line_col} * {int(n)}) div _total as int)"))
                    .drop("_total"))


def assign_chunks_by_bytes(df: DataFrame, n: int, text_col: str = "value", col: str = "chunk",
                           file_col: str | None = None) -> DataFrame:
    """Split rows, in order, into ``n`` contiguous chunks of equal bytes (a
    line counts its UTF-8 bytes and its line end), to within one line: a line
    belongs to the chunk that its first byte falls into.

    Two levels, as for line numbers: bytes before each (file, split) segment,
    and running bytes within it, so a hot file is summed split by split and
    many small files segment by segment. Adds ``col`` and ``first_byte``.
    """
    order = [file_col] if file_col else []
    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumns({"_part": F.shiftright("_mid", 33), "_bytes": F.octet_length(text_col).cast("long") + 1})
    tagged = tagged.withColumn("_fh", F.xxhash64(*order) if order else F.lit(0).cast("long"))
    segments = written_once(tagged.groupBy(*order, "_fh", "_part").agg(F.sum("_bytes").alias("_sum")), "byte-segments")
    total = segments.agg(F.coalesce(F.sum("_sum"), F.lit(0))).first()[0]
    starts = running_totals(segments, [*order, "_part"], "_sum", "_start").select("_fh", "_part", "_start")
    if segments.count() <= MAX_BROADCAST_SEGMENTS:
        starts = F.broadcast(starts)
    within = Window.partitionBy("_fh", "_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    placed = (tagged.withColumn("_inner", F.coalesce(F.sum("_bytes").over(within), F.lit(0)))
              .join(starts, ["_fh", "_part"]).withColumn("first_byte", F.col("_start") + F.col("_inner")))
    return (placed.withColumn(col, F.expr(f"cast(cast(first_byte as decimal(38,0)) * {int(n)} div {max(1, int(total))} as int)"))
            .drop("_mid", "_part", "_bytes", "_fh", "_inner", "_start"))
