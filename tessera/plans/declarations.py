"""The projects' tables as they are declared, and the shared tables with keys
and references of their own.

Lengths, types and keys of the projects' tables are fixed values.
"""

from __future__ import annotations

from ..sources.declared import Field, Reference, Table

TITLES = Table("titles", (
    Field("show_id", length=10, nullable=False), Field("type", length=10), Field("title", length=200),
    Field("director", length=250), Field("cast", length=1000), Field("country", length=150),
    Field("date_added", length=20), Field("release_year", "bigint"), Field("rating", length=10),
    Field("duration", length=10), Field("listed_in", length=100), Field("description", length=500)), key=("show_id",))

RETAIL_ORDERS = Table("retail_orders", (
    Field("order_id", "int", nullable=False), Field("order_date", "date"), Field("ship_mode", length=20),
    Field("segment", length=20), Field("country", length=20), Field("city", length=20), Field("state", length=20),
    Field("postal_code", length=20), Field("region", length=20), Field("category", length=20),
    Field("sub_category", length=20), Field("product_id", length=50), Field("quantity", "int"),
    Field("discount", "decimal(7,2)"), Field("sale_price", "decimal(7,2)"), Field("profit", "decimal(7,2)")), key=("order_id",))

BUSINESSES = Table("businesses", (
    Field("business_id", nullable=False), Field("name"), Field("city"), Field("state"), Field("review_count", "decimal(38,0)"),
    Field("stars", "decimal(38,0)"), Field("categories")), key=("business_id",))

REVIEWS = Table("reviews", (
    Field("business_id"), Field("review_date", "date"), Field("user_id"), Field("star", "decimal(38,0)"), Field("review_msg")),
    references=(Reference(("business_id",), "businesses", ("business_id",)),))

FOOD_ORDERS = Table("food_orders", (
    Field("order_id", length=20), Field("customer_code", length=20), Field("placed_at", "timestamp"),
    Field("restaurant_id", length=10), Field("cuisine", length=20), Field("order_status", length=20),
    Field("promo_code_name", length=20)))

PROJECT_TABLES = (TITLES, RETAIL_ORDERS, BUSINESSES, REVIEWS, FOOD_ORDERS)

#: The shared tables; a priority of eight characters is too short for one of them on purpose.
ORDERS = Table("orders", (
    Field("o_orderkey", "bigint", nullable=False), Field("o_custkey", "bigint", nullable=False),
    Field("o_orderstatus", length=1), Field("o_orderpriority", length=8)), key=("o_orderkey",),
    references=(Reference(("o_custkey",), "customer", ("c_custkey",)),))

LINEITEM = Table("lineitem", (
    Field("l_orderkey", "bigint", nullable=False), Field("l_linenumber", "int", nullable=False),
    Field("l_partkey", "bigint"), Field("l_suppkey", "bigint"), Field("l_returnflag", length=1)),
    key=("l_orderkey", "l_linenumber"),
    references=(Reference(("l_orderkey",), "orders", ("o_orderkey",)), Reference(("l_partkey",), "part", ("p_partkey",)),
                Reference(("l_suppkey",), "supplier", ("s_suppkey",))))

#: Suppliers as the parents of order lines' parts: most part numbers have none.
PART_OF_SUPPLIER = Table("part", (Field("p_partkey", "bigint", nullable=False), Field("p_name", length=12), Field("p_type", length=30),
                                  Field("p_size", "int")), key=("p_name", "p_type", "p_size"),
                         references=(Reference(("p_partkey",), "supplier", ("s_suppkey",)),))
