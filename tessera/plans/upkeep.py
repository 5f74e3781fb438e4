"""Profiles, states and joins kept up to date or spread out, over the shared tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapters
from . import params as P
from ..operators import bitmaps, sketches
from ..operators.customer_state import CustomerState
from ..operators.heavy_join import join_heavy
from ..operators.variant import inferred_schema, project_inferred, to_variant, widened_schema
from ..sources.batches import BatchStore
from ..sources.lines import assign_chunks_by_bytes
from ..sources.shared import shared_folder, written_once
from ..sources.tables import read_table

#: Batches and parts that the orders are dealt to, standing for days or files.
PARTS = 4


def sketch_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' columns profiled by sketches of parts, merged: exact counts
    of rows and nulls, and whether distinct count, median and the counts of
    the listed values are within their bounds of the exact answers."""
    orders = read_table(spark, sf_dir, "orders")
    made = written_once(sketches.column_sketches(orders, F.pmod("o_orderkey", F.lit(PARTS))), "sketches")
    said = {r.column_name: r for r in sketches.estimates(sketches.merged_sketches(made), [0.5]).collect()}
    checks = []
    for c in orders.columns:
        r = said[c]
        distinct = F.abs(F.count_distinct(c) - r.n_distinct) <= 4 * sketches.DISTINCT_ERROR * F.count_distinct(c)
        if r.quantiles:
            kind = orders.schema[c].dataType.typeName()
            number = (F.unix_micros(c) if kind.startswith("timestamp") else F.col(c)).cast("double")
            median = ((F.count_if(number < r.quantiles[0]) <= (0.5 + sketches.RANK_ERROR) * F.count(c))
                      & (F.count_if(number <= r.quantiles[0]) >= (0.5 - sketches.RANK_ERROR) * F.count(c)))
        else:
            median = F.lit(True)
        checks.append(orders.agg(F.lit(c).alias("column_name"), F.lit(r.n_rows).cast("long").alias("n_rows"), F.lit(r.n_null).cast("long").alias("n_null"),
                                 distinct.alias("distinct_ok"), median.alias("median_ok")))
    return reduce(DataFrame.unionByName, checks)


def frequent_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent priorities from merged tables of counters, which are
    exact while there are fewer values than counters."""
    orders = read_table(spark, sf_dir, "orders")
    made = sketches.frequent_sketches(orders, F.pmod("o_orderkey", F.lit(PARTS)), "o_orderpriority")
    return sketches.frequent_values(made, sketches.TOP).select(F.col("value").alias("o_orderpriority"), "n")


def _hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which a third belong to one customer, and some to none."""
    key = F.when(F.col("o_orderkey") % 3 == 0, 7).when(F.col("o_orderkey") % 11 == 0, -1).otherwise(F.col("o_custkey"))
    return read_table(spark, sf_dir, "orders").select("o_orderkey", key.cast("long").alias("c_custkey"),
                                                      F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


def hot_customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and cents per customer segment, orders without a customer too."""
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = join_heavy(_hot_orders(spark, sf_dir), customers, ["c_custkey"], "left")
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"),
                                              F.sum("cents").cast("decimal(38,0)").alias("cents"))


def orders_without_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer").select("c_custkey")
    return join_heavy(_hot_orders(spark, sf_dir), customers, ["c_custkey"], "left_anti").select("o_orderkey", "cents")


def distinct_customers_by_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers per status, per cuisine and in all, from one set of
    bitmaps per status and cuisine."""
    orders = adapters.food_orders(spark, sf_dir).select("customer_code", "order_status", "cuisine")
    ids = bitmaps.dense_ids(orders, "customer_code")
    fine = written_once(bitmaps.distinct_bitmaps(orders.join(ids, "customer_code", "left"), ["order_status", "cuisine"]), "bitmaps")
    out = []
    for level in ("order_status", "cuisine", None):
        groups = [level] if level else []
        counts = bitmaps.distinct_counts(bitmaps.merge_bitmaps(fine, groups), groups, "n_customers")
        out.append(counts.select(F.lit(level or "all").alias("level"), (F.col(level) if level else F.lit("all")).alias("value"), "n_customers"))
    return reduce(DataFrame.unionByName, out)


def director_type_counts_by_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct movies and TV shows per director, for directors with both:
    the same answer as ``director_type_counts_distinct``."""
    titles = adapters.titles(spark, sf_dir)
    ids = bitmaps.dense_ids(titles, "show_id")
    each = titles.join(ids, "show_id").select(
        "dense_id", F.lower("type").alias("t"), F.explode(F.expr("transform(split(director, ','), x -> trim(x))")).alias("director"))
    made = bitmaps.distinct_bitmaps(each, ["director", "t"])
    per = bitmaps.distinct_counts(made, ["director", "t"], "n")
    of = lambda t: F.coalesce(F.sum(F.when(F.col("t") == t, F.col("n"))), F.lit(0))
    return (per.groupBy("director").agg(of("movie").alias("num_movies"), of("tv show").alias("num_tv_shows"))
            .where("num_movies > 0 and num_tv_shows > 0"))


def customer_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's state after batches that came in any order, one of
    them twice, with the state compacted in between."""
    orders = adapters.food_orders(spark, sf_dir)
    state = CustomerState(BatchStore(spark, shared_folder(spark, "customer-state")))
    for k in (2, 0, 2, 3, 1):
        state.update(f"{k}", orders.where(F.pmod("order_id", F.lit(PARTS)) == k))
        if k == 3:
            state.compact()
    return state.current().select(
        "customer_code", "n_orders", "n_promo", "first_day", "last_day", F.col("first_order.order_id").alias("first_order"),
        F.col("first_order.promo").alias("first_promo"), F.array_join("first_day_promos", ",").alias("first_day_promos"))


def inferred_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records whose fields are found, not given: a second load
    brings a wider type for one field and a new nested one."""
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    late = F.col("event_id") % 2 == 1
    first = F.to_json(F.struct(F.col("event_id").alias("n"), F.col("event_type").alias("kind")))
    second = F.to_json(F.struct(F.col("value").cast("decimal(12,2)").alias("n"), F.col("event_type").alias("kind"),
                                F.struct(F.col("user_id").alias("id")).alias("user")))
    records = events.select("event_id", to_variant(F.when(late, second).otherwise(first)).alias("v"))
    one = inferred_schema(records.where(~late), "v")
    both = widened_schema(one, inferred_schema(records.where(late), "v"))
    return project_inferred(records, "v", both, ("event_id",), rest=None).select(
        "event_id", F.col("n").cast("decimal(20,2)").alias("n"), "kind", F.col("user.id").alias("user_id"))


def byte_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and bytes per chunk when the events' records, in stored order,
    are split into chunks of equal bytes."""
    lines = read_table(spark, sf_dir, "events").select("event_id", "props", F.col("_metadata.file_path").alias("_file"))
    return (assign_chunks_by_bytes(lines, P.CHUNKS, "props", file_col="_file").groupBy("chunk")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.octet_length("props") + 1).alias("n_bytes"),
                 F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")))
