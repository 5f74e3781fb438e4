"""A customer holding a third of all orders: results equal a brute-force
answer, and the plans combine per customer before any shuffle."""

import pandas as pd
import pytest
from data_dirs import SF_SMALL
from pyspark.sql import functions as F

from tessera.plans import adapters as A
from tessera.plans import food

HOT = "HOT-CUSTOMER"


@pytest.fixture(scope="module")
def hot(spark):
    o = A.food_orders(spark, SF_SMALL)
    return o.withColumn("customer_code",
                        F.when(F.col("order_id") % 3 == 0, F.lit(HOT))
                         .otherwise(F.col("customer_code").cast("string")))


@pytest.fixture(scope="module")
def pdf(hot):
    p = hot.toPandas()
    p["day"] = pd.to_datetime(p["placed_at"]).dt.date
    p = p.sort_values(["customer_code", "placed_at", "order_id"], kind="stable")
    p["rn"] = p.groupby("customer_code").cumcount() + 1
    return p


def test_hot_customer_holds_a_third(pdf):
    assert (pdf.customer_code == HOT).mean() >= 1 / 3 - 0.01


def test_every_third_order_on_hot_day(hot, pdf):
    # the hot customer's busiest day
    as_of = pdf[pdf.customer_code == HOT].day.value_counts().idxmax()
    got = {(r.order_id, r.rn) for r in food.every_third_order(hot, as_of, 3).collect()}
    want = pdf[(pdf.day == as_of) & (pdf.rn % 3 == 0)]
    assert got == set(zip(want.order_id, want.rn))
    assert any(c == HOT for c in pdf[pdf.day == as_of].customer_code)


def test_per_customer_counts(hot, pdf):
    g = pdf.groupby("customer_code").agg(n=("order_id", "size"),
                                         promo=("promo_code_name", "count"))
    want = set(g[(g.n > 1) & (g.n == g.promo)].index)
    got = {r.customer_code for r in food.all_promo_customers(hot).collect()}
    got_anti = {r.customer_code for r in food.all_promo_customers_anti(hot).collect()}
    assert got == want == got_anti


@pytest.mark.parametrize("fn", [food.all_promo_customers, food.all_promo_customers_anti,
                                food.daily_new_customers])
def test_per_customer_aggregates_combine_before_shuffle(hot, fn):
    plan = fn(hot)._jdf.queryExecution().executedPlan().toString()
    # a partial aggregate per map task precedes the shuffle by customer
    assert "partial_count" in plan or "partial_min" in plan
    first_exchange = plan.rfind("Exchange hashpartitioning(customer_code")
    first_partial = plan.rfind("HashAggregate(keys=[customer_code")
    assert first_partial > first_exchange >= 0


def test_every_third_order_over_all_days(hot, pdf):
    got = {(r.order_id, r.rn) for r in food.every_third_order_all_days(hot, 3).collect()}
    assert got == set(pdf[pdf.rn % 3 == 0][["order_id", "rn"]].itertuples(index=False, name=None))
