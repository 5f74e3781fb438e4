"""Golden answers on the 73-row seed (as-of 2025-03-31)."""

import datetime as dt
from decimal import Decimal

import pytest
from food_seed import seed_orders

from tessera.plans import food

AS_OF = dt.date(2025, 3, 31)


@pytest.fixture(scope="module")
def orders(spark):
    return seed_orders(spark).cache()


def test_shape(orders):
    from pyspark.sql import functions as F

    r = orders.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("customer_code").alias("c"),
                   F.count_distinct("restaurant_id").alias("r"),
                   F.count_distinct("cuisine").alias("k"),
                   F.count("promo_code_name").alias("p")).first()
    assert (r.n, r.c, r.r, r.k, r.p) == (73, 47, 10, 5, 33)


def test_top_outlet_by_cuisine(orders):
    got = {(r.cuisine, r.restaurant_id, r.no_of_orders, r.restaurant_rank)
           for r in food.top_outlet_by_cuisine(orders).collect()}
    assert got == {("American", "BURGER99", 8, 1), ("Italian", "PIZZA123", 10, 1),
                   ("Japanese", "SUSHI456", 6, 1), ("Lebanese", "KMKMH6787", 10, 1),
                   ("Mexican", "TACO789", 7, 1)}


def test_daily_new_customers(orders):
    rows = {r.order_dt: r.new_cust_count for r in food.daily_new_customers(orders).collect()}
    assert len(rows) == 35 and sum(rows.values()) == 47
    d = lambda m, day: dt.date(2025, m, day)
    expect = {d(1, 1): 2, d(1, 5): 3, d(1, 10): 3, d(1, 15): 2, d(1, 20): 2, d(1, 31): 4,
              d(2, 1): 2, d(2, 5): 1, d(2, 10): 1, d(3, 20): 2}
    for k, v in expect.items():
        assert rows[k] == v
    for day in range(2, 31):
        if d(1, day) not in expect:
            assert rows[d(1, day)] == 1


def test_single_order_acquired(orders):
    assert food.single_order_acquired(orders, 2025, 1).first().user_count == 32


def test_lapsed_promo_customers(orders):
    rows = food.lapsed_promo_customers(orders, AS_OF).collect()
    assert len(rows) == 24
    assert len({r.customer_code for r in rows}) == 24
    suffixes = {"06", "08", "09", "10", "12", "14", "16", "18", "21", "23", "26", "28", "33",
                "36", "38", "41", "42", "43", "44", "45", "48", "56", "57", "59"}
    assert {r.order_id for r in rows} == {"OF19001918" + s for s in suffixes}


def test_third_order_customers(orders):
    got = {(r.customer_code, r.number_of_orders)
           for r in food.third_order_customers(orders, AS_OF).collect()}
    assert got == {("LAST_ORDER_7DAYS", 3), ("MULTI_CUISINE_CUST", 6)}


def test_every_third_order(orders):
    got = {(r.order_id, r.rn) for r in food.every_third_order(orders, AS_OF).collect()}
    assert got == {("OF1900191864", 3), ("OF1900191870", 6)}


def test_all_promo_customers_two_ways_agree(orders):
    anti = {r.customer_code for r in food.all_promo_customers_anti(orders).collect()}
    counted = {(r.customer_code, r.order_cnt)
               for r in food.all_promo_customers(orders).collect()}
    assert counted == {("DEF9876543210XYZ", 2), ("UVW7890123456JKL", 3)}
    assert anti == {c for c, _ in counted}


def test_organic_shares(orders):
    assert food.organic_share_never_promo(orders, 2025, 1).first().user_percent == Decimal("38.30")
    assert food.organic_share_first_order(orders, 1).first().user_percent == Decimal("43.90")
