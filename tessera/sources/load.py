"""Loading line-delimited files into a table, each file once.

``load_new_files`` finds the files below a path that the store's ledger does
not hold yet (by path and time of writing, so a file that was replaced is
loaded again, and a folder that is loaded twice adds nothing), parses them,
and commits the records, the lines that do not parse and the ledger's new rows
as one batch. Its id is a digest of the files it loads: a load that was cut
and is run again loads the same files under the same id.

Lines that do not parse follow ``on_error``:

* ``"abort"``: the load raises ``LoadAborted`` and nothing becomes visible;
* ``"continue"``: good lines are loaded, bad ones go to the quarantine table;
* ``"skip_file"``: a file whose share of bad lines is over ``max_bad_share``
  is left out whole and noted as skipped; other files as with ``"continue"``.

Files are listed by Spark; the driver holds the paths of one load's files, at
most ``max_files``, as Spark's own file sources do. Counts of lines per file
are one aggregate, and the policy meets the lines by a join on the path.

``stream_new_files`` does the same as a stream that ends when all files that
are there have been loaded (``availableNow``); its checkpoint is the ledger.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .batches import BatchStore
from .lines import with_line_numbers

POLICIES = ("abort", "continue", "skip_file")
FILES = "file_path string, modified timestamp, file_bytes long, n_lines long, n_bad long, status string"
QUARANTINE = "file_path string, line_no long, value string"


class LoadAborted(ValueError):
    """Lines that do not parse, under the policy ``abort``."""


def json_records(schema: str | T.StructType) -> Callable[[Column], Column]:
    """Parser of JSON lines into a struct; null for a line that is no JSON
    object or holds a value of another type."""
    ddl = schema if isinstance(schema, str) else schema.toDDL()

    def parse(line: Column) -> Column:
        bad = "__corrupt"
        read = F.from_json(line, f"{ddl}, {bad} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
        names = T.StructType.fromDDL(ddl).fieldNames()
        kept = F.struct(*[read[n].alias(n) for n in names])
        return F.when(F.try_parse_json(line).isNotNull() & read[bad].isNull(), kept)

    return parse


def json_variant(line: Column) -> Column:
    """Parser of JSON lines into one VARIANT field."""
    value = F.try_parse_json(line)
    return F.when(value.isNotNull(), F.struct(value.alias("v")))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, modified, file_bytes, path) of the files below ``path`` that
    hold anything; contents unread. ``file_path`` is as ``_metadata`` gives it,
    ``path`` as it is written."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file_path string, modified timestamp, file_bytes long, path string")
    return files.select(F.col("_metadata.file_path").alias("file_path"), F.col("modificationTime").alias("modified"),
                        F.col("length").alias("file_bytes"), "path")


def literal_path(path: str) -> str:
    """``path`` with the characters that Spark would take for a pattern escaped."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def load_new_files(store: BatchStore, path: str, table: str, parse: Callable[[Column], Column],
                   on_error: str = "abort", max_bad_share: float = 0.0, max_files: int = 100_000,
                   before_commit: Callable[[], None] | None = None) -> DataFrame:
    """Load the files below ``path`` that ``table`` does not hold yet, oldest
    first, and return the ledger's rows of this load (none: nothing new).

    Tables of the store: ``table`` (the parsed fields and ``file_path``),
    ``<table>_quarantine`` and ``<table>_files``."""
    if on_error not in POLICIES:
        raise ValueError(f"on_error is one of {POLICIES}")
    spark = store.spark
    ledger = store.read(f"{table}_files", FILES)
    new = (list_files(spark, path).join(ledger, ["file_path", "modified"], "left_anti")
           .orderBy("modified", "file_path").limit(max_files).collect())
    if not new:
        return spark.createDataFrame([], FILES)
    batch_id = hashlib.sha256("\n".join(f"{r.file_path}\t{r.modified}" for r in new).encode()).hexdigest()[:32]
    lines = _numbered(spark.read.text([literal_path(r.path) for r in new]))
    files = spark.createDataFrame([(r.file_path, r.modified, r.file_bytes) for r in new],
                                  "file_path string, modified timestamp, file_bytes long")
    frames = _by_policy(lines, files, table, parse, on_error, max_bad_share)
    store.write(batch_id, frames, before_commit)
    return store.read(f"{table}_files", FILES).where(F.col("batch_id") == batch_id).drop("batch_id")


def _numbered(text: DataFrame) -> DataFrame:
    located = text.withColumn("file_path", F.col("_metadata.file_path"))
    return with_line_numbers(located, "line_no", base=1, file_col="file_path", per_file=True)


def _by_policy(lines: DataFrame, files: DataFrame, table: str, parse: Callable[[Column], Column],
               on_error: str, max_bad_share: float) -> dict[str, DataFrame]:
    parsed = lines.withColumn("__record", parse(F.col("value")))
    bad = F.col("__record").isNull()
    counts = parsed.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(bad).alias("n_bad"))
    if on_error == "abort":
        odd = counts.where("n_bad > 0").orderBy("file_path").take(3)
        if odd:
            raise LoadAborted("; ".join(f"{r.n_bad} of {r.n_lines} lines of {r.file_path} do not parse" for r in odd))
    over = (F.col("n_bad") > F.lit(max_bad_share) * F.col("n_lines")) if on_error == "skip_file" else F.lit(False)
    judged = counts.withColumn("status", F.when(over, "skipped").otherwise("loaded"))
    loaded = parsed.join(judged.where("status = 'loaded'").select("file_path"), "file_path", "left_semi") \
        if on_error == "skip_file" else parsed
    none = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)  # noqa: E731  a file without a line
    return {
        table: loaded.where(~bad).select("__record.*", "file_path"),
        f"{table}_quarantine": loaded.where(bad).select("file_path", F.col("line_no").cast("long"), "value"),
        f"{table}_files": files.join(judged, "file_path", "left").select(
            "file_path", "modified", "file_bytes", none("n_lines"), none("n_bad"),
            F.coalesce("status", F.lit("loaded")).alias("status")),
    }


def stream_new_files(store: BatchStore, path: str, table: str, parse: Callable[[Column], Column], checkpoint: str,
                     on_error: str = "continue", max_bad_share: float = 0.0, files_per_batch: int = 1000) -> None:
    """Load all files that are there and new to the stream's checkpoint, in
    batches of ``files_per_batch``, then stop. An epoch that runs again after
    a failure is the same batch, so its rows are there once."""
    if on_error not in POLICIES:
        raise ValueError(f"on_error is one of {POLICIES}")
    text = (store.spark.readStream.format("text").option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", files_per_batch).load(path)
            .select("value", F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_modification_time").alias("modified"),
                    F.col("_metadata.file_size").alias("file_bytes")))

    def load(batch: DataFrame, epoch: int) -> None:
        files = batch.groupBy("file_path").agg(F.max("modified").alias("modified"), F.max("file_bytes").alias("file_bytes"))
        lines = with_line_numbers(batch.select("value", "file_path"), "line_no", base=1, file_col="file_path", per_file=True)
        store.write(f"{table}-{epoch}", _by_policy(lines, files, table, parse, on_error, max_bad_share))

    (text.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
