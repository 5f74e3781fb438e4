"""Declared tables: lengths, keys and references, checked against the data.

A declaration carries what a ``create table`` statement says and Spark's
schema cannot: the length of a text column, whether it may be null, the key
and references to other tables (all of it is kept in the fields' metadata).
``violations`` counts every constraint: those of a row alone in one aggregate
over the table, keys and references by aggregates and anti joins of the key
columns only. ``split_rows`` marks the rows themselves, and ``load_declared``
sends rows that break a constraint to a quarantine table while the others are
loaded, in one batch that may be run again.

Meaning of a constraint, as in SQL: a null breaks ``not null`` only; a key is
broken by rows that share all its (non-null) columns, and every one of them
counts; a reference is broken by a row whose columns are all non-null and
equal to no row of the other table. A text column's length is in characters.
Text given for a column of another type breaks ``type`` if it cannot be cast.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import BatchStore
from .shared import written_once

COUNTS = "constraint_name string, n_violations long"
MAX_BROADCAST_VALUES = 100_000


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    length: int | None = None
    nullable: bool = True


@dataclass(frozen=True)
class Reference:
    """``columns`` name a row of ``table`` by its ``target`` columns."""

    columns: tuple[str, ...]
    table: str
    target: tuple[str, ...]

    @property
    def label(self) -> str:
        return f"reference({', '.join(self.columns)})"


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    references: tuple[Reference, ...] = field(default=())

    def schema(self) -> T.StructType:
        """Spark's schema; lengths, key and references as metadata."""
        out = []
        for f in self.fields:
            more = {"length": f.length} if f.length else {}
            if f.name in self.key:
                more["key"] = True
            for r in self.references:
                if f.name in r.columns:
                    more["references"] = f"{r.table}.{r.target[r.columns.index(f.name)]}"
            kind = T.StructType.fromDDL(f"c {f.type}").fields[0].dataType
            out.append(T.StructField(f.name, kind, f.nullable and f.name not in self.key, more))
        return T.StructType(out)

    @classmethod
    def of(cls, name: str, schema: T.StructType) -> Table:
        """The declaration that ``schema`` carries (references of one column)."""
        fields = tuple(Field(f.name, f.dataType.simpleString(), f.metadata.get("length"), f.nullable) for f in schema)
        links = [(f.name, f.metadata["references"].rpartition(".")) for f in schema if "references" in f.metadata]
        return cls(name, fields, tuple(f.name for f in schema if f.metadata.get("key")),
                   tuple(Reference((c,), t, (k,)) for c, (t, _, k) in links))

    @property
    def key_label(self) -> str:
        return f"key({', '.join(self.key)})"


def row_constraints(df: DataFrame, table: Table) -> dict[str, Column]:
    """Constraint -> whether a row breaks it, for those a row tells by itself."""
    out: dict[str, Column] = {}
    for f in table.fields:
        c, given = F.col(f"`{f.name}`"), df.schema[f.name].dataType
        kind = table.schema()[f.name].dataType
        if not f.nullable or f.name in table.key:
            out[f"not_null({f.name})"] = c.isNull()
        if f.length:
            out[f"length({f.name})"] = F.length(c) > f.length
        if isinstance(given, T.StringType) and not isinstance(kind, T.StringType):
            out[f"type({f.name})"] = c.isNotNull() & c.try_cast(kind).isNull()
    return out


def _complete(df: DataFrame, columns) -> DataFrame:
    for c in columns:
        df = df.where(F.col(f"`{c}`").isNotNull())
    return df


def _repeated(df: DataFrame, table: Table) -> DataFrame:
    """Key values of more than one row, with the number of rows."""
    return (_complete(df, table.key).groupBy(*table.key).agg(F.count(F.lit(1)).alias("__rows"))
            .where(F.col("__rows") > 1))


def _dangling(df: DataFrame, r: Reference, other: DataFrame) -> DataFrame:
    """Values of the reference that no row of ``other`` has, with the number
    of rows: combined before the join, so a hot value meets it once."""
    values = _complete(df, r.columns).groupBy(*r.columns).agg(F.count(F.lit(1)).alias("__rows"))
    known = other.select(*[F.col(f"`{t}`").alias(c) for c, t in zip(r.columns, r.target, strict=True)]).distinct()
    return values.join(known, list(r.columns), "left_anti")


def violations(df: DataFrame, table: Table, others: Mapping[str, DataFrame]) -> DataFrame:
    """(constraint_name, n_violations), a row per constraint, zeros included."""
    spark, alone = df.sparkSession, row_constraints(df, table)
    counted = []
    if alone:
        names = list(alone)
        once = df.agg(*[F.count_if(c).alias(f"v{i}") for i, c in enumerate(alone.values())])
        counted.append(once.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("constraint_name"), F.col(f"v{i}").alias("n_violations"))
            for i, n in enumerate(names)])).alias("x")).select("x.*"))
    total = F.coalesce(F.sum("__rows"), F.lit(0)).cast("long").alias("n_violations")
    if table.key:
        counted.append(_repeated(df, table).agg(total).select(F.lit(table.key_label).alias("constraint_name"), "n_violations"))
    for r in table.references:
        counted.append(_dangling(df, r, others[r.table]).agg(total)
                       .select(F.lit(r.label).alias("constraint_name"), "n_violations"))
    out = spark.createDataFrame([], COUNTS)
    for c in counted:
        out = out.unionByName(c)
    return out


def split_rows(df: DataFrame, table: Table, others: Mapping[str, DataFrame], broken: str = "broken") -> DataFrame:
    """``df`` plus ``broken``: the names of the constraints each row breaks.

    Repeated keys and dangling values are joined back to the rows. Both are
    found first and are one row per value: few are broadcast (counted, at most
    ``MAX_BROADCAST_VALUES``), many are joined by a shuffle in which AQE can
    split a hot value's rows."""
    out = df
    marks = [F.when(c, F.lit(n)) for n, c in row_constraints(df, table).items()]
    wanted = []
    if table.key:
        wanted.append((table.key_label, table.key, _repeated(df, table)))
    wanted += [(r.label, r.columns, _dangling(df, r, others[r.table])) for r in table.references]
    flags = []
    for i, (label, columns, values) in enumerate(wanted):
        flag = f"__broken_{i}"
        values = written_once(values, "broken-values")
        if values.count() <= MAX_BROADCAST_VALUES:
            values = F.broadcast(values)
        out = out.join(values.select(*columns, F.lit(True).alias(flag)), list(columns), "left")
        marks.append(F.when(F.col(flag), F.lit(label)))
        flags.append(flag)
    names = F.filter(F.array(*marks), lambda x: x.isNotNull()) if marks else F.array().cast("array<string>")
    return out.withColumn(broken, names).select(*df.columns, broken)


def load_declared(store: BatchStore, batch_id: str, df: DataFrame, table: Table,
                  others: Mapping[str, DataFrame]) -> dict[str, int]:
    """Load the rows that break nothing, cast to the declared types, into
    ``table.name`` and the others, as they came, into
    ``<table>_quarantine`` with the names of what they break. Returns the
    counts of rows, kept and broken, observed while the rows were marked."""
    seen = Observation(f"load {table.name}")
    marked = split_rows(df, table, others).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("broken") == 0).alias("kept"),
        F.count_if(F.size("broken") > 0).alias("broken"))
    marked = written_once(marked, f"declared-{table.name}")
    kept = marked.where(F.size("broken") == 0).select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in table.schema().fields])
    store.write(batch_id, {table.name: kept, f"{table.name}_quarantine": marked.where(F.size("broken") > 0)})
    return dict(seen.get)
