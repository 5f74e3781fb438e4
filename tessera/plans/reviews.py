"""Business-review analyses over typed reviews and businesses.

Reviews are the big side. Wherever only per-business numbers are needed,
reviews are aggregated per business *before* the join with businesses, so
the join meets one row per business and a business with a third of all
reviews is just one partial-aggregate row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..operators.lists import bridge
from ..operators.sentiment import Lexicon, sentiment
from ..operators.topk import top_k_per_group, top_n


def business_categories(businesses: DataFrame) -> DataFrame:
    return bridge(businesses, "business_id", "categories", "category")


def reviews_per_business(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("business_id").agg(F.count(F.lit(1)).alias("_reviews"))


def category_counts(businesses: DataFrame) -> DataFrame:
    return (business_categories(businesses).groupBy("category")
            .agg(F.count(F.lit(1)).alias("number_of_business")))


def top_category_reviewers(reviews: DataFrame, businesses: DataFrame, pattern: str,
                           n: int) -> DataFrame:
    """Users who reviewed the most distinct businesses whose categories match
    ``pattern`` (case-insensitive LIKE). (user, business) pairs are made
    distinct before the join."""
    matching = businesses.filter(F.col("categories").ilike(pattern)).select("business_id")
    pairs = reviews.select("user_id", "business_id").distinct()
    counts = (pairs.join(matching, "business_id", "left_semi")
                   .groupBy("user_id").agg(F.count(F.lit(1)).alias("num_businesses")))
    return top_n(counts, n, [F.desc("num_businesses"), F.asc("user_id")])


def category_reviews(reviews: DataFrame, businesses: DataFrame) -> DataFrame:
    per = reviews_per_business(reviews)
    return (business_categories(businesses).join(per, "business_id")
            .groupBy("category").agg(F.sum("_reviews").alias("num_reviews")))


def recent_reviews(reviews: DataFrame, k: int) -> DataFrame:
    """k most recent reviews per business (ties: higher event_id first)."""
    return top_k_per_group(reviews.select("business_id", "event_id", "review_msg", "review_date"),
                           ["business_id"], [F.desc("review_date"), F.desc("event_id")], k=k)


def busiest_month(reviews: DataFrame) -> DataFrame:
    counts = (reviews.groupBy(F.month("review_date").alias("review_month"))
                     .agg(F.count(F.lit(1)).alias("number_of_reviews")))
    return top_n(counts, 1, [F.desc("number_of_reviews"), F.asc("review_month")])


def five_star_share(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("business_id").agg(
        percent(F.count_if(F.col("star") == 5), F.count(F.lit(1))).alias("fivestarpercent"))


def top_businesses_by_city(reviews: DataFrame, businesses: DataFrame, k: int) -> DataFrame:
    per = reviews_per_business(reviews)
    counts = (businesses.select("business_id", "city").join(per, "business_id")
              .groupBy("city", "business_id").agg(F.sum("_reviews").alias("review_cnt")))
    return top_k_per_group(counts, ["city"], [F.desc("review_cnt"), F.asc("business_id")],
                           k=k, keep_rank=False)


def avg_rating_min_reviews(reviews: DataFrame, min_reviews: int) -> DataFrame:
    return (reviews.groupBy("business_id")
                   .agg(F.count(F.lit(1)).alias("num_reviews"),
                        F.round(F.avg("star"), 4).alias("average_rating"))
                   .filter(F.col("num_reviews") >= min_reviews))


def top_users_businesses(reviews: DataFrame, n: int) -> DataFrame:
    """The n most active reviewers and every business each reviewed.

    The top-n side has exactly n rows -- a bounded broadcast -- so the join
    back streams the reviews without shuffling them."""
    top = top_n(reviews.groupBy("user_id").agg(F.count(F.lit(1)).alias("num_reviews")),
                n, [F.desc("num_reviews"), F.asc("user_id")]).select("user_id")
    return (reviews.select("user_id", "business_id").join(F.broadcast(top), "user_id")
            .distinct())


def sentiment_labels(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    return sentiment(docs, ["doc_id", "source"], "text", lexicon).select(
        "doc_id", "source", "sentiment")


def top_positive_businesses(docs: DataFrame, lexicon: Lexicon, n: int) -> DataFrame:
    labelled = sentiment(docs, ["doc_id", "source"], "text", lexicon)
    counts = (labelled.filter(F.col("sentiment") == "Positive")
              .groupBy(F.col("source").alias("business_id"))
              .agg(F.count(F.lit(1)).alias("positive_review_cnt")))
    return top_n(counts, n, [F.desc("positive_review_cnt"), F.asc("business_id")])
