"""Line-delimited JSON: bulk load as VARIANT, malformed-line detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import with_line_numbers


def read_variant(spark: SparkSession, path: str, column: str = "v") -> DataFrame:
    """Schema-on-read load: each record becomes one VARIANT value."""
    return spark.read.format("json").option("singleVariantColumn", column).load(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def invalid_json_lines(lines: DataFrame, line_col: str = "value",
                       number_col: str = "line_no") -> DataFrame:
    """Lines that do not parse as JSON. ``lines`` must carry a line number
    (see ``lines.with_line_numbers``); blank lines count as invalid."""
    return lines.filter(F.try_parse_json(F.col(line_col)).isNull()).select(number_col, line_col)


def invalid_json_in_file(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    """(file_path, line_no, value) of every malformed line of a file set.
    Line numbers are 1-based, in (file path, line) order; ``per_file=True``
    numbers the lines of each file from 1."""
    lines = read_lines(spark, path).withColumn("file_path", F.col("_metadata.file_path"))
    numbered = with_line_numbers(lines, "line_no", base=1, file_col="file_path",
                                 per_file=per_file)
    return numbered.filter(F.try_parse_json(F.col("value")).isNull()).select(
        "file_path", "line_no", "value")


def line_count(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()
