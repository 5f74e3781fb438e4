"""The analyses written as Spark SQL over registered views agree with the
DataFrame plans (dialect notes: TOP n -> LIMIT n; QUALIFY -> filtered
subquery; case-insensitive literals -> lower())."""

import pytest
from data_dirs import SF_ORACLE

from tessera.plans.registry import QUERIES
from tessera.plans.views import register_views


@pytest.fixture(scope="module")
def views(spark):
    return register_views(spark, SF_ORACLE)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_views_registered(spark, views):
    assert {"df_orders", "netflix_land", "tbl_yelp_reviews", "orders_food"} <= set(views)


def test_sql_top_products(spark, views):
    sql = spark.sql("""select product_id, cast(sum(sale_price) as decimal(38,4)) as revenue
                       from df_orders group by product_id
                       order by revenue desc, product_id limit 10""")
    assert rows(sql) == rows(QUERIES["top_products"](spark, SF_ORACLE))


def test_sql_all_promo_not_exists(spark, views):
    sql = spark.sql("""select t.customer_code
                       from (select customer_code, count(order_id) as n from orders_food group by all) t
                       where t.n >= 2 and not exists (
                         select * from orders_food plain
                         where plain.promo_code_name is null and plain.customer_code = t.customer_code)""")
    assert rows(sql) == rows(QUERIES["all_promo_customers_anti"](spark, SF_ORACLE))


def test_sql_alias_reuse_ordinals_having(spark, views):
    sql = spark.sql("""select business_id, count(star) as num_reviews,
                              round(sum(star) / num_reviews, 4) as average_rating
                       from tbl_yelp_reviews group by 1 having num_reviews > 99""")
    assert rows(sql) == rows(QUERIES["avg_rating_min_reviews"](spark, SF_ORACLE))


def test_sql_lateral_split(spark, views):
    sql = spark.sql("""select btrim(part.item) as category, count(1) as number_of_business
                       from tbl_yelp_businesses, lateral explode(split(categories, ',')) as part(item)
                       group by all""")
    assert rows(sql) == rows(QUERIES["category_counts"](spark, SF_ORACLE))


def test_sql_director_types(spark, views):
    sql = spark.sql("""select * from (
                         select director, count_if(type ilike 'movie') as num_movies,
                                count_if(type ilike 'tv show') as num_tv_shows
                         from netflix_director join netflix_land using (show_id) group by director)
                       where least(num_movies, num_tv_shows) > 0""")
    assert rows(sql) == rows(QUERIES["director_type_counts"](spark, SF_ORACLE))
