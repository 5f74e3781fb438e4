"""Food-order customer lifecycle questions.

Every question is answered from per-customer aggregates where the
reference used windows or self-joins: hash aggregation combines map-side,
so a customer holding a third of all orders still ships one partial row per
map task.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, before_day, days_before, months_before, on_day
from ..functions.numeric import percent
from ..operators.sliced_ranks import sliced_ranks
from ..operators.topk import rank_within, top_k_per_group


def _day():
    return F.to_date("placed_at")


def top_outlet_by_cuisine(orders: DataFrame) -> DataFrame:
    """Busiest restaurant per cuisine without LIMIT/TOP (ties: lowest id)."""
    counts = orders.groupBy("cuisine", "restaurant_id").agg(
        F.count(F.lit(1)).alias("no_of_orders"))
    return top_k_per_group(counts, ["cuisine"],
                           [F.desc("no_of_orders"), F.asc("restaurant_id")],
                           k=1, rank_col="restaurant_rank")


def first_orders(orders: DataFrame) -> DataFrame:
    """customer_code, first and last order day, order count."""
    return orders.groupBy("customer_code").agg(
        F.min(_day()).alias("min_order_date"),
        F.max(_day()).alias("max_order_date"),
        F.count(F.lit(1)).alias("order_cnt"))


def daily_new_customers(orders: DataFrame) -> DataFrame:
    firsts = orders.groupBy("customer_code").agg(F.min(_day()).alias("order_dt"))
    return firsts.groupBy("order_dt").agg(F.count("customer_code").alias("new_cust_count"))


def single_order_acquired(orders: DataFrame, year: int, month: int) -> DataFrame:
    """Customers acquired in (year, month) whose only order is that one."""
    c = first_orders(orders)
    return (c.filter((F.month("min_order_date") == month) & (F.month("max_order_date") == month)
                     & (F.col("order_cnt") == 1) & (F.year("min_order_date") == year))
             .agg(F.count(F.lit(1)).alias("user_count")))


def lapsed_promo_customers(orders: DataFrame, as_of, quiet_days: int = 7,
                           acquired_months: int = 1) -> DataFrame:
    """No order in the last ``quiet_days``, first order over
    ``acquired_months`` ago, first-day order(s) on a promo: one row per
    promo order placed on the first day."""
    c = (orders.groupBy("customer_code")
               .agg(F.min(_day()).alias("min_order_date"), F.max(_day()).alias("max_order_date"))
               .filter((F.col("max_order_date") < F.lit(days_before(as_of, quiet_days)))
                       & (F.col("min_order_date") < F.lit(months_before(as_of, acquired_months)))))
    promo = orders.filter(F.col("promo_code_name").isNotNull()).withColumn("_day", _day())
    j = c.join(promo, (c.customer_code == promo.customer_code)
               & (c.min_order_date == promo._day))
    return j.select(c.customer_code, "min_order_date", "max_order_date", "order_id",
                    "placed_at", "restaurant_id", "cuisine", "order_status", "promo_code_name")


def third_order_customers(orders: DataFrame, as_of, every: int = 3) -> DataFrame:
    """Customers whose order count is a multiple of ``every`` and whose last
    order is on ``as_of``."""
    d = as_date(as_of)
    return (orders.groupBy("customer_code")
                  .agg(F.count(F.lit(1)).alias("number_of_orders"),
                       F.max(_day()).alias("_last"))
                  .filter((F.col("number_of_orders") % every == 0) & (F.col("_last") == F.lit(d)))
                  .drop("_last"))


def every_third_order(orders: DataFrame, as_of, every: int = 3) -> DataFrame:
    """The orders placed on ``as_of`` that are each customer's 3rd, 6th, ...
    (order by placed_at, then order_id).

    The running number of an as-of-day order is (orders before that day) +
    (its position within the day). The first term is a per-customer count --
    an aggregate, safe for a hot customer -- and the window only numbers the
    one day's orders, so no task ever sorts a customer's full history.
    """
    day = orders.filter(on_day("placed_at", as_of))
    day_customers = day.select("customer_code").distinct()
    prior = (orders.filter(before_day("placed_at", as_of))
                   .join(day_customers, "customer_code", "left_semi")
                   .groupBy("customer_code").agg(F.count(F.lit(1)).alias("_before")))
    ranked = day.withColumn("_in_day", rank_within(["customer_code"],
                                                   [F.asc("placed_at"), F.asc("order_id")]))
    out = (ranked.join(prior, "customer_code", "left")
                 .withColumn("rn", (F.coalesce(F.col("_before"), F.lit(0)) + F.col("_in_day"))
                             .cast("int"))
                 .filter(F.col("rn") % every == 0))
    return out.select("order_id", "customer_code", "placed_at", "restaurant_id", "cuisine",
                      "order_status", "promo_code_name", "rn")


def every_third_order_all_days(orders: DataFrame, every: int = 3) -> DataFrame:
    """Each customer's 3rd, 6th, ... order over all days. Whole histories are
    numbered, in slices, so a customer with a third of all orders is spread
    over many tasks."""
    numbered = sliced_ranks(orders, ["customer_code"], ["placed_at", "order_id"], row_number="rn")
    return numbered.where(F.col("rn") % every == 0).withColumn("rn", F.col("rn").cast("int"))


def order_ranks_by_status(orders: DataFrame) -> DataFrame:
    """Number, rank and dense rank of every order among those of its status,
    latest first: a few keys hold all rows, and days tie."""
    return sliced_ranks(orders.select("order_id", "order_status", "placed_at"), ["order_status"], ["placed_at desc"],
                        ["order_id"], "rn", "rnk", "dense_rnk")


def all_promo_customers_anti(orders: DataFrame) -> DataFrame:
    """More than one order and none without a promo, via an anti join.

    Both sides are reduced to one row per customer first, so the anti join
    never meets a hot key."""
    counts = (orders.groupBy("customer_code").agg(F.count(F.lit(1)).alias("_n"))
                    .filter(F.col("_n") > 1))
    organic = orders.filter(F.col("promo_code_name").isNull()).select("customer_code").distinct()
    return counts.join(organic, "customer_code", "left_anti").select("customer_code")


def all_promo_customers(orders: DataFrame) -> DataFrame:
    return (orders.groupBy("customer_code")
                  .agg(F.count(F.lit(1)).alias("order_cnt"),
                       F.count("promo_code_name").alias("promo_count"))
                  .filter((F.col("order_cnt") > 1)
                          & (F.col("order_cnt") == F.col("promo_count"))))


def organic_share_never_promo(orders: DataFrame, year: int, month: int = 1) -> DataFrame:
    """Percent of all customers who were acquired in (year, month) and never
    used a promo. The reference's left self-join is one conditional count."""
    c = orders.where("customer_code is not null").groupBy("customer_code").agg(
        F.min(_day()).alias("min_order_dt"), F.min("promo_code_name").alias("first_promo"))
    hit = ((F.month("min_order_dt") == month) & (F.year("min_order_dt") == year)
           & F.col("first_promo").isNull())
    return c.agg(percent(F.count_if(hit), F.count(F.lit(1))).alias("user_percent"))


def organic_share_first_order(orders: DataFrame, month: int = 1) -> DataFrame:
    """Among customers with an order in ``month`` (any year), percent whose
    first such order had no promo. The row_number = 1 pick is a min_by per
    customer (ties on placed_at broken by order_id)."""
    m = orders.filter((F.month("placed_at") == month) & F.col("customer_code").isNotNull())
    first = m.groupBy("customer_code").agg(
        F.min_by(F.struct(F.col("promo_code_name").alias("p")),
                 F.struct("placed_at", "order_id")).alias("_first"))
    hit = F.col("_first.p").isNull()
    return first.agg(percent(F.count_if(hit), F.count(F.lit(1)), hundred="100.0")
                     .alias("user_percent"))
