"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(data_dir, name))
