"""Views that put the shared test tables into the reference projects' shapes.

Each adapter is a lazy projection/join over the Parquet tables, so every
query built on it reads (and scales with) the whole tables.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.variant import project, to_variant
from ..sources.tables import read_table

# nation (25 rows) and region (5 rows) are fixed-size dimension tables, so a
# broadcast of them is bounded whatever the scale factor.
_FIXED_DIMENSIONS = ("nation", "region")


def _dim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    assert name in _FIXED_DIMENSIONS
    return F.broadcast(read_table(spark, sf_dir, name))


def food_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id, customer_code, placed_at, restaurant_id, cuisine,
    order_status, promo_code_name (null for status 'P')."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_custkey") * 5 + F.col("o_orderkey") % 5).alias("customer_code"),
        F.col("o_orderdate").alias("placed_at"),
        (F.col("o_orderkey") % 17).alias("restaurant_id"),
        F.col("o_orderpriority").alias("cuisine"),
        F.col("o_orderstatus").alias("order_status"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("promo_code_name"),
    )


RETAIL_PRICE_SCALE = 2
RETAIL_COLUMNS = ("order_id", "order_date", "region", "category", "sub_category",
                  "product_id", "list_price", "discount_percent", "cost_price")


def retail_orders(spark: SparkSession, sf_dir: str,
                  columns: Iterable[str] = RETAIL_COLUMNS) -> DataFrame:
    """Retail order lines (one per lineitem) with only the joins the
    requested columns need.

    lineitem -> orders -> customer -> nation -> region and lineitem -> part
    are many-to-one foreign keys, so a join that contributes no requested
    column cannot change the row set and is left out: ``top_products`` reads
    lineitem alone, ``month_over_year`` adds orders, only the per-region
    query pays for the customer join. nation/region are broadcast (fixed
    size); the other joins are planned by AQE from measured sizes.
    """
    cols = list(columns)
    need = set(cols)
    li = read_table(spark, sf_dir, "lineitem")
    df = li
    if need & {"order_date", "region"}:
        o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if "region" in need:
            # orders -> customer -> region first: the customer join then
            # shuffles orders, not the 4x larger order lines, and the order
            # lines are shuffled once, by order key.
            c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            n = _dim(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
            r = _dim(spark, sf_dir, "region").select("r_regionkey", "r_name")
            geo = (c.join(n, c.c_nationkey == n.n_nationkey)
                    .join(r, F.col("n_regionkey") == r.r_regionkey)
                    .select("c_custkey", "r_name"))
            o = o.join(geo, o.o_custkey == geo.c_custkey)
        df = df.join(o, df.l_orderkey == o.o_orderkey)
    if need & {"category", "sub_category", "cost_price"}:
        p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand",
                                                     "p_retailprice")
        df = df.join(p, df.l_partkey == p.p_partkey)
    exprs = {
        "order_id": F.col("l_orderkey"),
        "order_date": F.to_date("o_orderdate"),
        "region": F.col("r_name"),
        "category": F.col("p_type"),
        "sub_category": F.col("p_brand"),
        "product_id": F.col("l_partkey"),
        # integer money, as in the projects' CSV: prices in cents
        # (RETAIL_PRICE_SCALE), the discount as a whole percent
        "list_price": F.round(F.col("l_extendedprice") * F.lit(100)).cast("long"),
        "discount_percent": F.round(F.col("l_discount") * F.lit(100)).cast("int"),
        "cost_price": F.round(F.col("l_quantity") * F.col("p_retailprice") * F.lit(100))
                       .cast("long"),
    }
    return df.select(*[exprs[c].alias(c) for c in cols])


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title catalogue (show_id, type, title, director, cast, country,
    date_added, release_year, rating, duration, listed_in, description)
    derived from ``part``; list columns are comma-separated strings."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    s = lambda c: c.cast("string")
    listed_in = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")),
                         F.lit(", "), F.col("p_type"))
    return p.select(
        F.concat(F.lit("s"), s(k)).alias("show_id"),
        F.when(F.col("p_size") % 3 == 0, "TV Show").otherwise("Movie").alias("type"),
        F.col("p_name").alias("title"),
        F.when(k % 4 == 0, F.concat(F.col("p_brand"), F.lit(", Brand#"),
                                    s(F.col("p_size") % 25 + 1)))
         .otherwise(F.col("p_brand")).alias("director"),
        listed_in.alias("cast"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .when(k % 5 == 0, F.concat(F.lit("C"), s(k % 9), F.lit(", C"), s(k % 4)))
         .otherwise(F.concat(F.lit("C"), s(k % 9))).alias("country"),
        F.concat(F.lit("March "), s(k % 28 + 1), F.lit(", "), s(k % 7 + 2015)).alias("date_added"),
        (k % 7 + 2015).alias("release_year"),
        F.when(k % 50 == 0, F.concat(s(F.col("p_size")), F.lit(" min")))
         .otherwise(F.lit("PG")).alias("rating"),
        F.when(k % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(s(F.col("p_size") + 60), F.lit(" min"))).alias("duration"),
        listed_in.alias("listed_in"),
        F.col("p_type").alias("description"),
    )


def businesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """business_id, name, city, state, categories (comma list)."""
    s = read_table(spark, sf_dir, "supplier")
    n = _dim(spark, sf_dir, "nation")
    r = _dim(spark, sf_dir, "region")
    j = (s.join(n, s.s_nationkey == n.n_nationkey)
          .join(r, F.col("n_regionkey") == r.r_regionkey))
    kind = F.when(F.col("s_suppkey") % 3 == 0, "Restaurants").otherwise("Shopping")
    return j.select(
        F.col("s_suppkey").alias("business_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.concat(F.col("r_name"), F.lit(", "), kind, F.lit(", Cat"),
                 (F.col("s_suppkey") % 7).cast("string")).alias("categories"),
    )


REVIEW_FIELDS = {"business_id": ("$.k", "bigint")}


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed reviews projected from the semi-structured ``props`` record:
    event_id, business_id, review_date, user_id, star, review_msg."""
    e = read_table(spark, sf_dir, "events")
    v = e.select("event_id", "user_id", "event_type",
                 to_variant("props").alias("rec"))
    typed = project(v, "rec", REVIEW_FIELDS, keep=("event_id", "user_id", "event_type"))
    return typed.select(
        "event_id",
        "business_id",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("event_id") % 330).cast("int"))
         .alias("review_date"),
        "user_id",
        (F.col("event_id") % 5 + 1).cast("int").alias("star"),
        F.col("event_type").alias("review_msg"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


# Test lexicon for the sentiment job: the invented prose carries no opinion
# words, so common tokens it does contain stand in for them.
# Fixed values (word, polarity):
DEMO_LEXICON = {"with": Decimal("0.5"), "this": Decimal("0.3"),
                "was": Decimal("-0.4"), "from": Decimal("-0.2")}
