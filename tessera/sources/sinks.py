"""Table sinks: append, create-or-replace, insert-select, drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, name: str, mode: str = "append",
               fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """``to_sql(..., if_exists=mode)`` / ``create or replace table as select``."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def insert_into(df: DataFrame, name: str) -> None:
    """``insert into t select ...``: columns matched by name, rows appended."""
    cols = df.sparkSession.table(name).columns
    df.select(*cols).write.insertInto(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def save_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
              properties: dict | None = None, max_connections: int = 16,
              batch_size: int = 10_000) -> None:
    """Append to a database table over JDBC (the driver jar must be on the
    classpath). Spark opens one connection per written partition; at most
    ``max_connections`` are used (Spark coalesces down to it), with rows
    sent in batches of ``batch_size``."""
    props = {"numPartitions": str(max_connections), "batchsize": str(batch_size)}
    props.update(properties or {})
    df.write.jdbc(url, table, mode=mode, properties=props)
