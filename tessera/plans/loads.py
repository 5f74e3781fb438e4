"""Loads over the shared tables: files once, batches that may be run again,
declared constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapters, declarations
from ..sources.batches import BatchStore
from ..sources.declared import split_rows, violations
from ..sources.load import FILES, json_records, load_new_files
from ..sources.shared import shared_folder
from ..sources.tables import read_table

EVENT = "event_id long, event_type string, user_id long"
#: Every so many records are written broken, and types from here on arrive late.
BROKEN_EVERY, LATE_FROM = 97, "p"


def load_each_file_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as line-delimited JSON, a folder per type, some lines cut
    short. Loaded, loaded again, then with the late types' folders beside the
    others, and once more: per type the lines seen, the bad ones, the records
    in the table and in the quarantine."""
    record = F.to_json(F.struct("event_id", "event_type", "user_id"))
    line = F.when(F.col("event_id") % BROKEN_EVERY == 0, F.expr("substring(r, 1, length(r) - 1)")).otherwise(F.col("r"))
    lines = (read_table(spark, sf_dir, "events").withColumn("r", record)
             .select(F.col("event_type").alias("kind"), line.alias("value")))
    source, store = shared_folder(spark, "load-source"), BatchStore(spark, shared_folder(spark, "load-store"))
    for arrived in (F.col("kind") < LATE_FROM, F.col("kind") >= LATE_FROM):
        lines.where(arrived).write.mode("append").partitionBy("kind").text(source)
        for _ in range(2):
            load_new_files(store, source, "events", json_records(EVENT), on_error="continue")
    kind = F.regexp_extract("file_path", "kind=([^/]+)/", 1).alias("event_type")
    seen = store.read("events_files", FILES).groupBy(kind).agg(F.sum("n_lines").alias("n_lines"), F.sum("n_bad").alias("n_bad"))
    kept = store.read("events", f"{EVENT}, file_path string").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_loaded"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))
    apart = store.read("events_quarantine", "file_path string, line_no long, value string").groupBy(kind).agg(
        F.count(F.lit(1)).alias("n_quarantined"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return (seen.join(kept, "event_type", "left").join(apart, "event_type", "left")
            .select("event_type", "n_lines", "n_bad", zero("n_loaded"), zero("n_quarantined"), "first_event", "last_event"))


class _Cut(Exception):
    pass


def repeated_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as one batch per priority. Each is cut once between
    writing and committing, then written, then written again: per batch the
    rows, keys and cents in the table."""
    def cut() -> None:
        raise _Cut

    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    store = BatchStore(spark, shared_folder(spark, "batch-store"))
    # five priorities in the shared tables, as many batches as there are
    for (priority,) in orders.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect():
        batch = {"orders": orders.where(F.col("o_orderpriority") == priority)}
        try:
            store.write(priority, batch, before_commit=cut)
        except _Cut:
            pass
        for _ in range(2):
            store.write(priority, batch)
    return store.read("orders", orders.schema).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_orders"),
        F.sum("cents").cast("decimal(38,0)").alias("cents"))


def _declared(spark: SparkSession, sf_dir: str):
    table = lambda name: read_table(spark, sf_dir, name)
    others = {name: table(name) for name in ("customer", "orders", "part", "supplier")}
    return others, (
        (adapters.titles(spark, sf_dir), declarations.TITLES), (adapters.food_orders(spark, sf_dir), declarations.FOOD_ORDERS),
        (table("orders"), declarations.ORDERS), (table("lineitem"), declarations.LINEITEM),
        (table("part"), declarations.PART_OF_SUPPLIER))


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared constraint of five tables with the rows that break it."""
    others, declared = _declared(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        violations(df, table, others).select(F.lit(table.name).alias("table_name"), "constraint_name", "n_violations")
        for df, table in declared])


def quarantined_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts that break a constraint, with what they break."""
    marked = split_rows(read_table(spark, sf_dir, "part"), declarations.PART_OF_SUPPLIER,
                        {"supplier": read_table(spark, sf_dir, "supplier")})
    return marked.where(F.size("broken") > 0).select("p_partkey", "p_name", F.array_join(F.array_sort("broken"), "; ").alias("broken"))
