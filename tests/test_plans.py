"""Plan-shape assertions: the physical operators the scale design relies on."""

import pytest
from data_dirs import SF_SMALL

from tessera.plans.registry import QUERIES


def plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString() + \
        df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["top5_products_by_region", "recent_reviews",
                                  "top_outlet_by_cuisine", "dedupe_titles",
                                  "top_director_per_year", "top5_businesses_by_city"])
def test_top_k_per_group_limits_before_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize("name", ["top_products", "busiest_month", "top_category_reviewers",
                                  "top_positive_businesses", "top_country_for_genre"])
def test_global_top_n(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_anti_and_semi_joins(spark):
    assert "LeftAnti" in plan(spark, "all_promo_customers_anti")
    assert "LeftSemi" in plan(spark, "duplicate_rows")


@pytest.mark.parametrize("name, joins", [
    ("director_type_counts", 0), ("director_type_counts_distinct", 0), ("top_director_per_year", 0),
    ("avg_duration_by_genre", 0), ("both_genre_directors", 0), ("top_country_for_genre", 1), ("country_filled", 1)])
def test_titles_join_only_for_learned_countries(spark, name, joins):
    p = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Join ") == joins


def test_as_of_day_filter_reaches_scan(spark):
    p = plan(spark, "every_third_order")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_column_pruning_single_table(spark):
    """top_products needs no join and reads three lineitem columns."""
    p = plan(spark, "top_products")
    assert "Join" not in p.split("== Optimized")[0]
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_discount:double>" in p


def test_sentiment_stays_inside_the_row(spark):
    p = plan(spark, "sentiment_labels")
    assert "Exchange" not in p and "Join" not in p and "Generate" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_bitmap_counts_need_no_expand(spark):
    assert "Expand" not in plan(spark, "distinct_customers_by_bitmaps")
    assert "Expand" not in plan(spark, "director_type_counts_by_bitmaps")


def test_reviews_aggregated_before_business_join(spark):
    p = plan(spark, "category_reviews")
    assert "partial_count" in p


def test_no_python_in_any_query(spark):
    for name in QUERIES:
        p = plan(spark, name)
        assert "EvalPython" not in p and "FlatMapGroupsInPandas" not in p, name


@pytest.mark.parametrize("name", ["top_products", "month_over_year", "top_profit_growth"])
def test_money_is_long_per_row_decimal_per_group(spark, name):
    """Per-row money stays long arithmetic in the scan stage; only the
    partial sums take decimals (no per-row decimal multiply)."""
    df = QUERIES[name](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(" in p and "as decimal(18,0))" in p
    assert "decimal(12,2)" not in p and "0.01" not in p
