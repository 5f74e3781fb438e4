"""Retail order analyses over cleansed order lines.

Each analysis asks ``retail_orders`` only for the columns it uses, so the
lineitem scan joins orders/customer/part only when needed, and the derived
money columns are computed in the same codegen stage as the scan. Money is
exact long arithmetic per row (``sale_u``/``profit_u``, units of 10^-4);
only the per-group totals become decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import sum_units
from ..operators.cleanse import derive_profit, profit_units
from ..operators.topk import top_k_per_group, top_n
from . import adapters as A

SALE_INPUTS = ("list_price", "discount_percent")
PROFIT_INPUTS = ("list_price", "discount_percent", "cost_price")


# scale of the sale_u / profit_u amounts
UNITS = A.RETAIL_PRICE_SCALE + 2


def cleansed(spark: SparkSession, sf_dir: str, *cols: str, profit: bool = False) -> DataFrame:
    """``df_orders`` restricted to ``cols`` plus sale_u (and profit_u)."""
    inputs = PROFIT_INPUTS if profit else SALE_INPUTS
    raw = A.retail_orders(spark, sf_dir, list(cols) + list(inputs))
    return profit_units(raw).drop(*inputs, "discount_u")


def profit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full cleansed table: inputs replaced by discount, sale_price, profit."""
    return derive_profit(A.retail_orders(spark, sf_dir), price_scale=A.RETAIL_PRICE_SCALE)


def revenue(col: str = "sale_u"):
    return sum_units(F.col(col), UNITS)


def top_products(df: DataFrame, n: int) -> DataFrame:
    rev = df.groupBy("product_id").agg(revenue().alias("revenue"))
    return top_n(rev, n, [F.desc("revenue"), F.asc("product_id")])


def top_products_by_region(df: DataFrame, k: int) -> DataFrame:
    """rank() <= k per region: ties are kept."""
    rev = df.groupBy("product_id", "region").agg(revenue().alias("revenue"))
    return top_k_per_group(rev, ["region"], [F.desc("revenue")], k=k, ranker="rank",
                           rank_col="rk")


def month_over_year(df: DataFrame, year_a: int, year_b: int) -> DataFrame:
    """Sales per calendar month, year A next to year B (0 when absent).

    One aggregation: the per-(year, month) pre-aggregate of the two-level
    formulation folds into conditional sums keyed by month alone."""
    yr, mn = F.year("order_date"), F.month("order_date")

    def for_year(y):
        return sum_units(F.when(yr == y, F.col("sale_u")).otherwise(F.lit(0)), UNITS)

    return (df.groupBy(mn.alias("mn"))
              .agg(for_year(year_a).alias(f"sales_{year_a}"),
                   for_year(year_b).alias(f"sales_{year_b}"))
              .orderBy("mn"))


def best_month_by_category(df: DataFrame, literal: bool = False) -> DataFrame:
    """Month (yyyyMM) with the highest sales per category.

    ``literal=True`` reproduces the written query, whose window is also
    partitioned by month, so every (category, month) ranks 1. Lines are
    grouped by the month's number; its text is made once a group."""
    month = F.year("order_date") * 100 + F.month("order_date")
    rev = (df.groupBy("category", month.alias("_month")).agg(revenue().alias("rev"))
             .select("category", F.lpad(F.col("_month").cast("string"), 6, "0").alias("mn"), "rev"))
    groups = ["category", "mn"] if literal else ["category"]
    return top_k_per_group(rev, groups, [F.desc("rev")], k=1, ranker="rank", rank_col="rnk")


def top_profit_growth(df: DataFrame, year_a: int, year_b: int, n: int = 1) -> DataFrame:
    """Sub-category with the largest profit increase from A to B: one
    conditional sum, +profit in year B and -profit in year A."""
    yr, p = F.year("order_date"), F.col("profit_u")
    signed = F.when(yr == year_b, p).when(yr == year_a, -p).otherwise(F.lit(0))
    growth = df.groupBy("sub_category").agg(sum_units(signed, UNITS).alias("profit_growth"))
    return top_n(growth, n, [F.desc("profit_growth"), F.asc("sub_category")])
