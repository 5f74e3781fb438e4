"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from ..session import checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what depends on how
    a run happened to deal its rows is fixed, and lost executors cost tasks
    of one step only."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, or no rows of ``schema`` if there is none yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
