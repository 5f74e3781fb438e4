"""Operator unit tests on tiny frames: nulls, empty tokens, ties, case, 100 %."""

import datetime as dt
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from tessera.functions.dates import DEFAULT_DATE_FORMATS, months_before, parse_date
from tessera.functions.numeric import percent
from tessera.functions.strings import (ci_equals, concat_null_as_empty, normalise_column_names,
                                       split_trimmed, strip_to_int)
from tessera.operators import profile
from tessera.operators.cleanse import (dedupe_latest, derive_profit, fill_by_learned_pairs,
                                       replace_null_tokens)
from tessera.operators.lists import bridge
from tessera.operators.sentiment import Lexicon, analyze_sentiment_udf, sentiment
from tessera.operators.topk import top_k_per_group
from tessera.operators.variant import project, to_variant
from tessera.plans import titles


def test_split_keeps_empty_tokens_and_trims(spark):
    df = spark.createDataFrame([("s1", "a, b,,c"), ("s2", None)], "id string, l string")
    trimmed = [r.l for r in bridge(df, "id", "l").collect()]
    raw = [r.l for r in bridge(df, "id", "l", trim=False).collect()]
    assert trimmed == ["a", "b", "", "c"]
    assert raw == ["a", " b", "", "c"]


def test_bridge_rows_equal_list_sizes(spark):
    df = spark.createDataFrame([("s1", "x,y,z"), ("s2", "x"), ("s3", None)], "id string, l string")
    assert bridge(df, "id", "l").count() == 4


def test_concat_null_as_empty(spark):
    r = spark.range(1).select(concat_null_as_empty(F.lit("a"), F.lit(None).cast("string"))
                              .alias("c")).first()
    assert r.c == "a"


def test_case_insensitive_equality(spark):
    df = spark.createDataFrame([("Movie",), ("movie",), ("TV Show",)], "t string")
    assert df.filter(ci_equals("t", "movie")).count() == 2


def test_strip_to_int(spark):
    df = spark.createDataFrame([("90 min",), ("PG",), (None,)], "d string")
    assert [r.m for r in df.select(strip_to_int("d", " min").alias("m")).collect()] == [90, None, None]


def test_normalise_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Ship Mode` int, `List Price` int")
    assert normalise_column_names(df).columns == ["ship_mode", "list_price"]


def test_parse_date_formats(spark):
    df = spark.createDataFrame([(" August 4, 2017",), ("2019-01-02",), ("garbage",)], "d string")
    got = [r.x for r in df.select(parse_date("d").alias("x")).collect()]
    assert got == [dt.date(2017, 8, 4), dt.date(2019, 1, 2), None]


def test_months_before_clamps():
    assert months_before("2025-03-31", 1) == dt.date(2025, 2, 28)
    assert months_before("2024-01-15", 1) == dt.date(2023, 12, 15)


def test_percent_holds_one_hundred(spark):
    r = spark.range(1).select(percent(F.lit(3), F.lit(3)).alias("p"),
                              percent(F.lit(2), F.lit(3)).alias("q")).first()
    assert r.p == Decimal("100.00") and r.q == Decimal("66.67")


def test_replace_null_tokens_on_all_string_columns(spark):
    df = spark.createDataFrame([("Not Available", "x", 1), ("unknown", "unknown", 2),
                                ("Standard", None, 3)], "a string, b string, n int")
    out = replace_null_tokens(df, ["Not Available", "unknown"]).collect()
    assert [(r.a, r.b, r.n) for r in out] == [(None, "x", 1), (None, None, 2), ("Standard", None, 3)]


def test_derive_profit_exact(spark):
    # whole currency units, as in the projects' CSV
    df = spark.createDataFrame([(260, 2, 240), (1999, 7, 1500)],
                               "list_price int, discount_percent int, cost_price int")
    rows = derive_profit(df).collect()
    assert [(r.discount, r.sale_price, r.profit) for r in rows] == [
        (Decimal("5.2"), Decimal("254.8"), Decimal("14.8")),
        (Decimal("139.93"), Decimal("1859.07"), Decimal("359.07"))]
    assert "list_price" not in derive_profit(df).columns
    assert dict(derive_profit(df).dtypes)["profit"] == "decimal(18,4)"
    # cents: 1234.56 at 5 % off, cost 1000.01
    cents = spark.createDataFrame([(123456, 5, 100001)],
                                  "list_price long, discount_percent int, cost_price long")
    r = derive_profit(cents, price_scale=2).first()
    assert (r.discount, r.sale_price, r.profit) == (
        Decimal("61.728"), Decimal("1172.832"), Decimal("172.822"))


def test_dedupe_keeps_latest_string_order(spark):
    df = spark.createDataFrame([("s99", "t", "Movie"), ("s100", "t", "Movie"), ("s5", "u", "Movie")],
                               "show_id string, title string, type string")
    got = {r.show_id for r in dedupe_latest(df, ["title", "type"], [F.desc("show_id")]).collect()}
    assert got == {"s99", "s5"}


@pytest.mark.parametrize("text", ["2020-01-31", " March 5, 2021 ", "mar 5, 2021", "May 1, 2020", "5 March 2021",
                                  "03/31/2020", "2020-13-01", "March 45, 2020", "2020-01-31x", "", "12/2020", None])
def test_parse_date_guards_change_nothing(spark, text):
    df = spark.createDataFrame([(text,)], "d string")
    plain = F.coalesce(*[F.try_to_date(F.trim("d"), f) for f in DEFAULT_DATE_FORMATS])
    guarded, unguarded = df.select(parse_date("d"), plain).first()
    assert guarded == unguarded


def test_split_trimmed_keeps_empty_items(spark):
    df = spark.createDataFrame([(" a , b c,  ,d ",), ("",), (" , ",), (None,)], "t string")
    assert [r.x for r in df.select(split_trimmed("t").alias("x")).collect()] == [
        ["a", "b c", "", "d"], [""], ["", ""], None]


TITLES = "show_id string, type string, title string, director string, country string, date_added string, " \
    "release_year int, rating string, duration string, listed_in string, description string"


def test_title_analyses_within_the_row(spark):
    """Repeated names in a list, blank items, null lists, other types."""
    row = lambda i, t, d, c, g: (i, t, "t" + i, d, c, "March 5, 2020", 2020, "PG", "90 min", g, "")
    raw = spark.createDataFrame([
        row("s1", "Movie", "Ann, Ann , Bob", "X, X, Y", "Comedies, Horror , Comedies"),
        row("s2", "TV Show", "Ann", "X", "comedies"),
        row("s3", "MOVIE", "Bob", None, "COMEDIES"),
        row("s4", "Movie", None, "Y", None),
        row("s5", "Short", "Bob", "Z", "Horror")], TITLES)
    cat = titles.Catalogue(spark, "", raw)
    rows = lambda df: sorted(map(tuple, df.collect()))
    # two types of any name pass: Bob has a movie and a short
    assert rows(titles.director_type_counts(cat)) == [("Ann", 2, 1), ("Bob", 2, 0)]
    assert rows(titles.director_type_counts(cat, distinct=True)) == [("Ann", 1, 1), ("Bob", 2, 0)]
    # s3 takes every country that a title of Bob's has: X, Y, Z
    assert rows(titles.top_country_for_genre(cat, "comedies")) == [("X", 2)]
    assert [r[0] for r in rows(titles.top_director_per_year(cat).select("director"))] == ["Bob"]
    assert rows(titles.both_genre_directors(cat, "Comedies", "horror")) == [("Ann", 1, 1), ("Bob", 2, 1)]
    assert rows(cat.countries().filter("show_id = 's3'")) == [("s3", "X"), ("s3", "Y"), ("s3", "Z")]


def test_fill_by_learned_pairs_only_single_key_rows(spark):
    raw = spark.createDataFrame([("s1", "A", "X"), ("s2", "A", None), ("s3", "A, B", None)],
                                "id string, director string, country string")
    got = [(r.id, r.country) for r in fill_by_learned_pairs(raw, "id", "director", "country").collect()]
    assert got == [("s2", "X")]


def test_duplicate_rows_null_safe(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", "x", 3), ("b", "x", 4)],
                               "title string, type string, id int")
    assert {r.id for r in profile.duplicate_rows(df, ["title", "type"]).collect()} == {1, 2}


def test_null_profile_and_max_len(spark):
    df = spark.createDataFrame([("abc", None), (None, None), ("a", "z")], "a string, b string")
    assert {(r.column_name, r.null_count) for r in profile.null_profile(df).collect()} == \
        {("a", 1), ("b", 2)}
    assert profile.max_length(df, "a").first().max_len == 3


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([("r", 1, 10), ("r", 2, 10), ("r", 3, 5)], "g string, p int, v int")
    out = top_k_per_group(df, ["g"], [F.desc("v")], k=1, ranker="rank", rank_col="rk")
    assert {r.p for r in out.collect()} == {1, 2}


def test_sentiment_thresholds(spark):
    lex = Lexicon(spark, {"love": 0.5, "hate": -0.8, "ok": 0})
    docs = spark.createDataFrame([(1, "i love snowflake"), (2, "I HATE it"), (3, "ok then"),
                                  (4, ""), (5, None), (6, "love hate")], "id int, text string")
    got = {r.id: r.sentiment for r in sentiment(docs, ["id"], "text", lex).collect()}
    assert got == {1: "Positive", 2: "Negative", 3: "Neutral", 4: "Neutral", 5: "Neutral",
                   6: "Negative"}


def test_sentiment_sql_function(spark):
    analyze_sentiment_udf(spark, {"love": 0.5})
    assert spark.sql("select analyze_sentiment('i love snowflake') as s").first().s == "Positive"


def test_variant_projection_rounds_stars(spark):
    df = spark.createDataFrame([('{"business_id": "b1", "stars": 4.5, "date": "2018-07-07 22:09:11"}',),
                                ("{bad",)], "j string")
    v = df.select(to_variant("j").alias("v"))
    out = project(v, "v", {"business_id": ("$.business_id", "string"),
                           "stars": ("$.stars", "decimal(38,0)"),
                           "review_date": ("$.date", "timestamp")}).collect()
    assert out[0].business_id == "b1" and out[0].stars == Decimal(5)
    assert out[0].review_date.date() == dt.date(2018, 7, 7)
    assert out[1].business_id is None


def test_sentiment_is_exact_per_row_and_equal_in_sql(spark):
    words = {"good": 0.1, "fine": 0.2, "bad": -0.3, "Faint": 0.004, "poor": -0.01, "nice": 0.01}
    texts = ["good fine bad", "faint", "nice " * 201 + "poor " * 200, None, "", "GOOD bad, bad", "nothing"]
    docs = spark.createDataFrame([(1, t) for t in texts], "id int, text string")
    job = sentiment(docs, ["id"], "text", Lexicon(spark, words))
    assert sorted(r.sentiment for r in job.collect()) == sorted(
        ["Neutral", "Positive", "Positive", "Neutral", "Neutral", "Negative", "Neutral"])
    analyze_sentiment_udf(spark, words)
    assert [r.s for r in docs.selectExpr("analyze_sentiment(text) as s").collect()] == [
        "Neutral", "Positive", "Positive", "Neutral", "Neutral", "Negative", "Neutral"]
    for wrong in ({"good": 1, "Good": 2}, {"don't": 1}):
        with pytest.raises(ValueError):
            Lexicon(spark, wrong)


def test_profit_keeps_cents_and_half_percents(spark):
    df = spark.createDataFrame([(Decimal("12.99"), Decimal("2.5"), Decimal("10.49"))],
                               "list_price decimal(10,2), discount_percent decimal(4,1), cost_price decimal(10,2)")
    r = derive_profit(df).first()
    assert (r.discount, r.sale_price, r.profit) == (Decimal("0.32475"), Decimal("12.66525"), Decimal("2.17525"))
    with pytest.raises(TypeError):
        derive_profit(df.withColumn("list_price", F.col("list_price").cast("double")))


def test_percent_of_nothing_is_null(spark):
    from tessera.functions.numeric import percent
    assert spark.range(0).agg(percent(F.count_if(F.col("id") > 1), F.count(F.lit(1))).alias("p")).first().p is None


def test_money_property_against_python_decimal(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from tessera.functions.numeric import sum_units

    row = st.tuples(st.integers(0, 10**9), st.integers(0, 100), st.integers(0, 10**9))

    @settings(max_examples=6, deadline=None,
              suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(rows=st.lists(row, min_size=1, max_size=200), scale=st.sampled_from([0, 2]))
    def check(rows, scale):
        df = spark.createDataFrame([(i % 3, *r) for i, r in enumerate(rows)],
                                   "g int, list_price long, discount_percent int, cost_price long")
        out = derive_profit(df, price_scale=scale, drop_inputs=False).collect()
        q = Decimal(1).scaleb(-scale)
        for r in out:
            lp, cp = Decimal(r.list_price) * q, Decimal(r.cost_price) * q
            disc = lp * r.discount_percent * Decimal("0.01")
            assert (r.discount, r.sale_price, r.profit) == (disc, lp - disc, lp - disc - cp)
        from tessera.operators.cleanse import profit_units
        tot = {r.g: r.t for r in profit_units(df).groupBy("g").agg(
            sum_units(F.col("profit_u"), scale + 2).alias("t")).collect()}
        want = {}
        for r in out:
            want[r.g] = want.get(r.g, Decimal(0)) + r.profit
        assert tot == want

    check()


def test_cluster_settings_scale_with_input():
    from tessera.session import cluster_settings

    small = cluster_settings(8, 10 << 20)
    assert small["spark.sql.shuffle.partitions"] == "24"
    big = cluster_settings(8000, 100 << 40)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2048
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
