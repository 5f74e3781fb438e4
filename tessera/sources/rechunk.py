"""Re-chunk a line-delimited file set into N balanced files, and audit them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import assign_chunks


def rechunk_text(spark: SparkSession, src: str, dst: str, n: int = 25,
                 mode: str = "overwrite") -> None:
    """Write ``src`` lines to ``dst/chunk=i/`` for i in 0..n-1, contiguous and
    in input order (files in path order), sizes within one line of each other.

    No single writer per chunk: a chunk is written by every task whose slice
    of lines overlaps it, each slice sorted by line number. Part files are
    named by task index, so the tasks must hold consecutive line ranges for a
    chunk folder's files, in name order, to hold its lines in order. A single
    input file is scanned in line order already (its splits keep file order),
    so it is written straight from the scan tasks without a shuffle; a file
    set, whose splits Spark interleaves by size, is range-partitioned by line
    number first.
    """
    text = spark.read.text(src)
    single_file = len(text.inputFiles()) == 1
    lines = assign_chunks(text.withColumn("_file", F.col("_metadata.file_path")), n,
                          file_col="_file")
    if not single_file:
        lines = lines.repartitionByRange("line_no")
    (lines.sortWithinPartitions("chunk", "line_no")
          .select("chunk", "value")
          .write.mode(mode).partitionBy("chunk").text(dst))


def file_audit(df: DataFrame, size: bool = True) -> DataFrame:
    """Rows and bytes per input file, from the hidden ``_metadata`` column
    (no listing on the driver). Files are told apart by their path: chunk
    folders hold part files of the same name."""
    keys = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")]
    if size:
        keys.append(F.col("_metadata.file_size").alias("file_size"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def audit_path(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    out = file_audit(spark.read.format(fmt).load(path))
    return out.withColumn("size_mb", F.round(F.col("file_size") / F.lit(1024 * 1024), 2))
