"""Tables written in batches that may be run again.

A plain append doubles its rows when a job is retried. Here every write has a
batch id chosen by the caller (a day, a streaming epoch, a digest of the files
it loads) and goes through two steps:

1. the rows are written under ``<root>/<table>/batch_id=../attempt=../`` with a
   new attempt id, where nobody reads them yet;
2. one row in ``<root>/commits/batch_id=..`` names the attempt that counts
   (the first one, should two runs commit the same batch at once).

Readers join the tables with the commits. A batch that is written twice is
found committed and not written again; one that was cut after step 1 is
written under a new attempt and the first attempt is never seen. Several
tables written in one batch become visible together. ``replace_partitions`` is
the other way to repeat a write: it replaces exactly the partitions that its
rows belong to.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from .shared import read_if_there

COMMITS = "commits"
COMMIT = "attempt string, n_rows map<string,long>, committed_at timestamp, batch_id string"


class BatchStore:
    """Tables under ``root`` that are written batch by batch."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self) -> DataFrame:
        """(batch_id, attempt, n_rows, committed_at) of the batches that count."""
        found = read_if_there(self.spark, f"{self.root}/{COMMITS}", COMMIT)
        first = F.min_by(F.struct("attempt", "n_rows", "committed_at"), F.struct("committed_at", "attempt"))
        return found.groupBy("batch_id").agg(first.alias("first")).select("batch_id", "first.*")

    def is_committed(self, batch_id: str) -> bool:
        return not self.commits().where(F.col("batch_id") == batch_id).isEmpty()

    def write(self, batch_id: str, frames: Mapping[str, DataFrame], before_commit: Callable[[], None] | None = None) -> bool:
        """Write ``frames`` (table name -> rows) as one batch; False if the
        batch was committed before. ``before_commit`` runs between the steps."""
        if not batch_id or COMMITS in frames:
            raise ValueError(f"a batch needs an id, and no table is called {COMMITS!r}")
        if self.is_committed(batch_id):
            return False
        attempt = uuid.uuid4().hex
        for name, df in frames.items():
            (df.withColumns({"batch_id": F.lit(batch_id), "attempt": F.lit(attempt)})
               .write.mode("append").partitionBy("batch_id", "attempt").parquet(f"{self.root}/{name}"))
        counts = {name: self._attempt(name, df.schema, batch_id, attempt).count() for name, df in frames.items()}
        if before_commit:
            before_commit()
        row = self.spark.createDataFrame([(attempt, counts)], "attempt string, n_rows map<string,long>").withColumn(
            "committed_at", F.current_timestamp())
        try:  # a commit of the same batch by another run stands
            row.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/{COMMITS}/batch_id={_escaped(batch_id)}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            return False
        return True

    def _attempt(self, name: str, schema: T.StructType, batch_id: str, attempt: str) -> DataFrame:
        both = (F.col("batch_id") == batch_id) & (F.col("attempt") == attempt)
        return self._all(name, schema).where(both)

    def _all(self, name: str, schema: T.StructType) -> DataFrame:
        whole = T.StructType([f for f in schema.fields if f.name not in ("batch_id", "attempt")]
                             + [T.StructField("batch_id", T.StringType()), T.StructField("attempt", T.StringType())])
        return read_if_there(self.spark, f"{self.root}/{name}", whole)

    def read(self, name: str, schema: T.StructType | str) -> DataFrame:
        """The rows of the committed attempts, with their ``batch_id``."""
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        return self._all(name, schema).join(self.commits().select("batch_id", "attempt"), ["batch_id", "attempt"]).drop("attempt")

    def streaming_sink(self, query: str, name: str) -> Callable[[DataFrame, int], None]:
        """For ``writeStream.foreachBatch``: each epoch is a batch, so an epoch
        that Spark runs again after a failure is written once."""
        def sink(df: DataFrame, epoch: int) -> None:
            self.write(f"{query}-{epoch}", {name: df})

        return sink


def _escaped(value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    odd = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in odd else c for c in value)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of and leave the others, so
    a day that is computed again takes the place of its first run."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def merge_statement(target: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """Standard SQL that puts the rows of ``staging`` into ``target`` by key:
    run twice it changes nothing the second time. ``keys`` must be unique in
    ``staging``; nulls in them are matched as equal."""
    rest = [c for c in columns if c not in keys]
    name = lambda c: '"' + c.replace('"', '""') + '"'
    same = " and ".join(f"(t.{name(k)} = s.{name(k)} or (t.{name(k)} is null and s.{name(k)} is null))" for k in keys)
    update = f"when matched then update set {', '.join(f'{name(c)} = s.{name(c)}' for c in rest)}\n" if rest else ""
    return (f"merge into {target} t using {staging} s on {same}\n{update}"
            f"when not matched then insert ({', '.join(map(name, columns))}) values ({', '.join(f's.{name(c)}' for c in columns)})")


def save_jdbc_merged(df: DataFrame, url: str, target: str, staging: str, keys: Sequence[str],
                     properties: dict | None = None, max_connections: int = 16,
                     execute: Callable[[str], None] | None = None) -> None:
    """Rows into a database table by key: Spark replaces the staging table,
    then one statement merges it, so a repeated run gives the rows once.
    ``execute`` runs the statement; by default over the same JDBC driver."""
    twice = df.groupBy(*keys).count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"rows share a key of {list(keys)}: {[tuple(r) for r in twice.take(3)]}")
    props = {"numPartitions": str(max_connections), "truncate": "true"} | (properties or {})
    df.write.jdbc(url, staging, mode="overwrite", properties=props)
    (execute or _jdbc_execute(df.sparkSession, url, props))(merge_statement(target, staging, keys, df.columns))


def _jdbc_execute(spark: SparkSession, url: str, properties: dict) -> Callable[[str], None]:
    def run(statement: str) -> None:
        jvm = spark._jvm
        given = jvm.java.util.Properties()
        for k, v in properties.items():
            given.setProperty(k, v)
        connection = jvm.java.sql.DriverManager.getConnection(url, given)
        try:
            connection.createStatement().execute(statement)
        finally:
            connection.close()

    return run
