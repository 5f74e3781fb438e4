"""Profiling, null-token cleanup, re-chunking and file audits over the
shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleanse import replace_null_tokens
from ..sources.jsonl import invalid_json_lines
from ..sources.lines import assign_chunks, with_line_numbers
from ..sources.rechunk import file_audit
from ..sources.tables import TABLES, read_table, table_path


def null_tokens(spark: SparkSession, sf_dir: str, tokens) -> DataFrame:
    return replace_null_tokens(read_table(spark, sf_dir, "orders"), tokens)


def rechunk_counts(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Lines per chunk when the events records, in stored order, are split
    into ``n`` balanced contiguous chunks (files in path order), with each
    chunk's first and last event id (showing order is kept)."""
    lines = read_table(spark, sf_dir, "events").select(
        "event_id", F.col("_metadata.file_path").alias("_file"))
    return (assign_chunks(lines, n, file_col="_file").groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.min("event_id").alias("first_event"),
                 F.max("event_id").alias("last_event")))


def table_file_audit(spark: SparkSession, sf_dir: str, size: bool = False) -> DataFrame:
    paths = [table_path(sf_dir, t) for t in TABLES]
    return file_audit(spark.read.format("parquet").load(paths), size=size).drop("file_path")


def invalid_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed JSON among the events' semi-structured records, numbered
    1.. in stored order (files in path order)."""
    lines = read_table(spark, sf_dir, "events").select(
        F.col("props").alias("value"), F.col("_metadata.file_path").alias("_file"))
    return invalid_json_lines(with_line_numbers(lines, "line_no", base=1, file_col="_file"))
