"""Register the projects' tables as temporary views, so their analyses can
also be written as Spark SQL over the familiar names.

All views are lazy; nothing is materialised.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.cleanse import derive_profit
from . import adapters as A
from .titles import Catalogue


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    cat = Catalogue(spark, sf_dir)
    views = {
        "orders_food": A.food_orders(spark, sf_dir),
        "df_orders": derive_profit(A.retail_orders(spark, sf_dir),
                                   price_scale=A.RETAIL_PRICE_SCALE),
        "df_netflix_raw": cat.raw,
        "netflix_director": cat.directors(),
        "netflix_cast": cat.cast(),
        "netflix_genre": cat.genres(),
        "netflix_country": cat.countries(),
        "netflix_land": cat.land(literal=True),
        "tbl_yelp_reviews": A.reviews(spark, sf_dir),
        "tbl_yelp_businesses": A.businesses(spark, sf_dir),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
