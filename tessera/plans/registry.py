"""Query registry: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import adapters as A
from . import food, loads, quality, retail, reviews, titles, upkeep
from ..operators import profile
from ..operators.sentiment import Lexicon
from .titles import Catalogue
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]


def _food(fn, *args, **kw) -> Query:
    return lambda spark, sf: fn(A.food_orders(spark, sf), *args, **kw)


QUERIES: dict[str, Query] = {
    # food-order customer lifecycle
    "top_outlet_by_cuisine": _food(food.top_outlet_by_cuisine),
    "daily_new_customers": _food(food.daily_new_customers),
    "single_order_acquired": _food(food.single_order_acquired, P.ACQ_YEAR, P.ACQ_MONTH),
    "lapsed_promo_customers": _food(food.lapsed_promo_customers, P.AS_OF),
    "third_order_customers": _food(food.third_order_customers, P.AS_OF, P.EVERY_NTH),
    "every_third_order": _food(food.every_third_order, P.AS_OF, P.EVERY_NTH),
    "every_third_order_all_days": _food(food.every_third_order_all_days, P.EVERY_NTH),
    "order_ranks_by_status": _food(food.order_ranks_by_status),
    "all_promo_customers_anti": _food(food.all_promo_customers_anti),
    "all_promo_customers": _food(food.all_promo_customers),
    "organic_share_never_promo": _food(food.organic_share_never_promo, P.ACQ_YEAR, P.ACQ_MONTH),
    "organic_share_first_order": _food(food.organic_share_first_order, P.ACQ_MONTH),
    # retail orders
    "profit_columns": retail.profit_columns,
    "top_products": lambda s, d: retail.top_products(retail.cleansed(s, d, "product_id"), P.TOP_N),
    "top5_products_by_region": lambda s, d: retail.top_products_by_region(
        retail.cleansed(s, d, "product_id", "region"), P.TOP_K),
    "month_over_year": lambda s, d: retail.month_over_year(
        retail.cleansed(s, d, "order_date"), P.YEAR_A, P.YEAR_B),
    "best_month_by_category": lambda s, d: retail.best_month_by_category(
        retail.cleansed(s, d, "category", "order_date")),
    "best_month_by_category_literal": lambda s, d: retail.best_month_by_category(
        retail.cleansed(s, d, "category", "order_date"), literal=True),
    "top_profit_growth": lambda s, d: retail.top_profit_growth(
        retail.cleansed(s, d, "sub_category", "order_date", profit=True), P.YEAR_A, P.YEAR_B),
    # title catalogue
    "bridge_director": lambda s, d: Catalogue(s, d).directors(),
    "bridge_cast": lambda s, d: Catalogue(s, d).cast(),
    "bridge_genre": lambda s, d: Catalogue(s, d).genres(),
    "bridge_country": lambda s, d: Catalogue(s, d).countries_split(),
    "country_filled": lambda s, d: Catalogue(s, d).countries(),
    "country_filled_each_director": lambda s, d: Catalogue(s, d).countries(each_director=True),
    "titles_ignoring_case": lambda s, d: titles.titles_ignoring_case(A.titles(s, d)),
    "dedupe_titles": lambda s, d: Catalogue(s, d).deduped(),
    "titles_land": lambda s, d: Catalogue(s, d).land(),
    "titles_land_literal": lambda s, d: Catalogue(s, d).land(literal=True),
    "parse_dates": lambda s, d: titles.parse_dates(A.titles(s, d)),
    "director_type_counts": lambda s, d: titles.director_type_counts(Catalogue(s, d)),
    "director_type_counts_distinct": lambda s, d: titles.director_type_counts(
        Catalogue(s, d), distinct=True),
    "top_country_for_genre": lambda s, d: titles.top_country_for_genre(Catalogue(s, d), P.COMEDY),
    "top_director_per_year": lambda s, d: titles.top_director_per_year(Catalogue(s, d)),
    "avg_duration_by_genre": lambda s, d: titles.avg_duration_by_genre(Catalogue(s, d)),
    "both_genre_directors": lambda s, d: titles.both_genre_directors(
        Catalogue(s, d), P.COMEDY, P.HORROR),
    "scalar_functions": lambda s, d: titles.scalar_functions(A.titles(s, d)),
    # business reviews
    "variant_projection": A.reviews,
    "category_counts": lambda s, d: reviews.category_counts(A.businesses(s, d)),
    "top_category_reviewers": lambda s, d: reviews.top_category_reviewers(
        A.reviews(s, d), A.businesses(s, d), P.CATEGORY_PATTERN, P.TOP_N),
    "category_reviews": lambda s, d: reviews.category_reviews(A.reviews(s, d), A.businesses(s, d)),
    "recent_reviews": lambda s, d: reviews.recent_reviews(A.reviews(s, d), P.RECENT_K),
    "busiest_month": lambda s, d: reviews.busiest_month(A.reviews(s, d)),
    "five_star_share": lambda s, d: reviews.five_star_share(A.reviews(s, d)),
    "top5_businesses_by_city": lambda s, d: reviews.top_businesses_by_city(
        A.reviews(s, d), A.businesses(s, d), P.TOP_K),
    "avg_rating_min_reviews": lambda s, d: reviews.avg_rating_min_reviews(
        A.reviews(s, d), P.MIN_REVIEWS),
    "top_users_businesses": lambda s, d: reviews.top_users_businesses(A.reviews(s, d), P.TOP_N),
    "sentiment_labels": lambda s, d: reviews.sentiment_labels(
        A.documents(s, d), Lexicon(s, A.DEMO_LEXICON)),
    "top_positive_businesses": lambda s, d: reviews.top_positive_businesses(
        A.documents(s, d), Lexicon(s, A.DEMO_LEXICON), P.TOP_N),
    # profiling and quality
    "null_profile": lambda s, d: profile.null_profile(A.titles(s, d)),
    "max_len": lambda s, d: profile.max_length(A.titles(s, d), "cast"),
    "distinct_values": lambda s, d: profile.distinct_values(A.titles(s, d), "rating"),
    "duplicate_keys": lambda s, d: profile.duplicate_keys(A.titles(s, d), ["title", "type"]),
    "duplicate_rows": lambda s, d: profile.duplicate_rows(A.titles(s, d), ["title", "type"]),
    # sources
    "null_tokens": lambda s, d: quality.null_tokens(s, d, P.NULL_TOKENS),
    "rechunk_counts": lambda s, d: quality.rechunk_counts(s, d, P.CHUNKS),
    "file_audit": quality.table_file_audit,
    "invalid_json_lines": quality.invalid_props,
    # loads
    "load_each_file_once": loads.load_each_file_once,
    "repeated_batches": loads.repeated_batches,
    "constraint_violations": loads.constraint_violations,
    "quarantined_parts": loads.quarantined_parts,
    # profiles, states and joins
    "sketch_bounds": upkeep.sketch_bounds,
    "frequent_priorities": upkeep.frequent_priorities,
    "hot_customer_segments": upkeep.hot_customer_segments,
    "orders_without_customer": upkeep.orders_without_customer,
    "distinct_customers_by_bitmaps": upkeep.distinct_customers_by_bitmaps,
    "director_type_counts_by_bitmaps": upkeep.director_type_counts_by_bitmaps,
    "customer_state": upkeep.customer_state,
    "inferred_records": upkeep.inferred_records,
    "byte_chunks": upkeep.byte_chunks,
}
