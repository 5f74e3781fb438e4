"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir

ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers: the code is sent once
    per session, wherever the driver itself has it from."""
    root = Path(__file__).resolve().parents[2]
    sc = spark.sparkContext
    if getattr(sc, "_tessera_sent", False):
        return
    name = Path(tempfile.mkdtemp()) / "tessera.zip"
    with zipfile.ZipFile(name, "w") as out:
        for file in sorted((root / "tessera").rglob("*.py")):
            out.write(file, file.relative_to(root))
    sc.addPyFile(str(name))
    sc._tessera_sent = True


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs inside removes its shuffle files as it ends; else they stay on
    disk, step after step, until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage,
    survives lost executors, and is computed once however often it is read."""
    path = shared_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def replaced(df: DataFrame, name: str, col: Column) -> DataFrame:
    """``df`` with ``name`` set, other columns and their order kept."""
    return df.select(*[col.alias(c) if c == name else F.col(f"`{c}`") for c in df.columns])


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """``schema`` plus ``fields``; a field of the same name is replaced."""
    names = {f.name for f in fields}
    return T.StructType([f for f in schema.fields if f.name not in names] + list(fields))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint only when the measured row count is within the bound;
    beyond it the join shuffles."""
    return F.broadcast(df) if is_small(df, max_rows) else df
