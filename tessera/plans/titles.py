"""Title catalogue: bridge tables, dedupe, gap filling, analyses.

Case-insensitive literals ('movie', 'tv show', genre names) are compared on
``lower(col)``: the reference's host collation ignores case, Spark compares
bytes.

The analyses work within the raw title row: the landing row and the bridge
rows of a title come from the same raw row (``show_id`` is its key), so
exploding a list beside the other columns gives what joining landing table and
bridges on ``show_id`` would, without the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.collated import group_ignoring_case
from ..functions.dates import parse_date
from ..functions.strings import ci_equals, concat_null_as_empty, split_trimmed, strip_to_int
from ..operators.cleanse import dedupe_latest, fill_by_learned_pairs, fill_from
from ..operators.lists import bridge
from ..operators.topk import top_k_per_group, top_n
from . import adapters as A

MOVIE, TV_SHOW = "movie", "tv show"


class Catalogue:
    """The raw titles and everything derived from them, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, raw: DataFrame | None = None):
        self.raw = raw if raw is not None else A.titles(spark, sf_dir)

    # --- bridge tables (director, cast, genre, country); cast is not trimmed
    def directors(self) -> DataFrame:
        return bridge(self.raw, "show_id", "director")

    def cast(self) -> DataFrame:
        return bridge(self.raw, "show_id", "cast", trim=False)

    def genres(self) -> DataFrame:
        return bridge(self.raw, "show_id", "listed_in", "genre")

    def countries_split(self) -> DataFrame:
        return bridge(self.raw, "show_id", "country")

    def countries(self, each_director: bool = False) -> DataFrame:
        """Country bridge plus rows learned from (director, country) pairs
        for titles with no country (insert ... select). As the script is
        written, only titles with one director can learn;
        ``each_director=True`` learns from any of a title's directors."""
        learned = fill_by_learned_pairs(self.raw, "show_id", "director", "country", each_key=each_director)
        return self.countries_split().unionByName(learned)

    # --- landing table
    def deduped(self) -> DataFrame:
        """Latest show_id (string order) per (title, type)."""
        return dedupe_latest(self.raw, ["title", "type"], [F.desc("show_id")])

    def land(self, literal: bool = False) -> DataFrame:
        """Typed landing table; duration falls back to rating.

        ``literal=True`` keeps duplicates, as the written script does (its
        row number is computed but never filtered)."""
        src = self.raw if literal else self.deduped()
        return src.select("show_id", "type", "title",
                          parse_date("date_added").alias("date_added"),
                          "release_year", "rating",
                          fill_from("duration", "rating").alias("duration"),
                          "description")

    def analysed(self) -> DataFrame:
        """The landing rows with their lists. Duplicates stay, as in the table
        the script builds: its row number is never filtered."""
        return self.raw.withColumns({"date_added": parse_date("date_added"),
                                     "duration": fill_from("duration", "rating")})

    def movies(self) -> DataFrame:
        return self.analysed().filter(ci_equals("type", MOVIE))


def each(list_col: str, distinct: bool = False) -> Column:
    """A row per item of the list; ``distinct`` names each item once a title."""
    items = split_trimmed(list_col)
    return F.explode(F.array_distinct(items) if distinct else items)


def of_genre(genre: str) -> Column:
    return F.array_contains(split_trimmed(F.lower("listed_in")), genre.lower())


def parse_dates(raw: DataFrame) -> DataFrame:
    return raw.select("show_id", parse_date("date_added").alias("date_added"))


def director_type_counts(cat: Catalogue, distinct: bool = False) -> DataFrame:
    """Movies and TV shows per director, for directors with both.

    ``distinct=False`` sums one per bridge row (a title naming a director
    twice counts twice); ``distinct=True`` counts titles."""
    t = F.lower(F.col("type"))
    j = cat.analysed().select(t.alias("t"), each("director", distinct).alias("director"))
    out = j.groupBy("director").agg(
        F.sum(F.when(F.col("t") == MOVIE, 1).otherwise(0)).alias("num_movies"),
        F.sum(F.when(F.col("t") == TV_SHOW, 1).otherwise(0)).alias("num_tv_shows"),
        F.count_distinct("t").alias("_types"))
    return out.filter(F.col("_types") == 2).drop("_types")


def top_country_for_genre(cat: Catalogue, genre: str) -> DataFrame:
    """Country with the most distinct movies of ``genre`` (ties: country)."""
    wanted = cat.movies().filter(of_genre(genre)).select("show_id", "director", "country")
    own = wanted.select(each("country", distinct=True).alias("country"))
    learned = fill_by_learned_pairs(cat.raw, "show_id", "director", "country", wanted)
    # a title has its own or learned countries, each once
    counts = own.unionByName(learned.select("country")).groupBy("country").agg(
        F.count(F.lit(1)).alias("num_comedy"))
    return top_n(counts, 1, [F.desc("num_comedy"), F.asc("country")])


def top_director_per_year(cat: Catalogue) -> DataFrame:
    """Per year added, the director with most movies (ties: name)."""
    j = cat.movies().select(each("director", distinct=True).alias("director"),
                            F.year("date_added").alias("release_year"))
    counts = j.groupBy("director", "release_year").agg(F.count(F.lit(1)).alias("num_movies"))
    return top_k_per_group(counts, ["release_year"], [F.desc("num_movies"), F.asc("director")],
                           k=1, rank_col="rn")


def avg_duration_by_genre(cat: Catalogue) -> DataFrame:
    """Average movie minutes per genre: the double mean and the integer
    (truncating) mean an int ``avg`` gives in T-SQL."""
    mins = strip_to_int("duration", " min")
    j = cat.movies().select(mins.alias("mins"), each("listed_in").alias("genre"))
    return j.groupBy("genre").agg(
        F.round(F.avg("mins"), 4).alias("avg_duration"),
        F.expr("cast(sum(mins) div count(mins) as int)").alias("avg_duration_trunc"))


def both_genre_directors(cat: Catalogue, comedy: str, horror: str) -> DataFrame:
    """Directors with movies in both genres, with a count for each."""
    j = (cat.movies().select("director", of_genre(comedy).alias("com"), of_genre(horror).alias("hor"))
            .filter(F.col("com") | F.col("hor"))
            .select(each("director", distinct=True).alias("director"), "com", "hor"))
    out = j.groupBy("director").agg(F.count_if("com").alias("num_com_movies"),
                                    F.count_if("hor").alias("num_horror_movies"))
    return out.filter((F.col("num_com_movies") > 0) & (F.col("num_horror_movies") > 0))


def scalar_functions(raw: DataFrame) -> DataFrame:
    """One projection exercising the scalar functions the scripts use."""
    d = parse_date("date_added")
    return raw.select(
        "show_id",
        F.trim(F.concat(F.lit("  "), F.col("title"), F.lit(" "))).alias("trimmed"),
        concat_null_as_empty("title", "country").alias("title_country"),
        F.replace(F.col("rating"), F.lit(" min"), F.lit("")).alias("rating_stripped"),
        strip_to_int("duration", " min").alias("duration_min"),
        F.year(d).alias("yr"),
        F.month(d).alias("mn"),
        F.date_format(d, "yyyyMM").alias("yyyymm"),
        F.date_sub(d, 7).alias("week_before"),
        F.add_months(d, -1).alias("month_before"),
        (F.col("release_year") % 3).alias("year_mod3"),
        (F.col("release_year") * 2 - 1).alias("arith"),
        F.length("title").alias("title_len"),
        (F.col("release_year").cast("decimal(7,2)") / F.lit(4)).cast("decimal(9,2)").alias("quarter"),
    )


def spellings(raw: DataFrame) -> DataFrame:
    """Titles in the spellings that different sources might give them."""
    k = F.col("release_year") % 3
    return raw.select("show_id", "type", F.when(k == 0, F.upper("title")).when(k == 1, F.initcap("title"))
                      .otherwise(F.col("title")).alias("title"))


def titles_ignoring_case(raw: DataFrame) -> DataFrame:
    """Titles grouped without case: the first spelling by ``show_id``, the
    number of rows, and of types."""
    return group_ignoring_case(spellings(raw), ["title"], ["show_id"], F.count(F.lit(1)).alias("n_rows"),
                               F.count_distinct("type").alias("n_types"))
