"""Sketches, bitmaps, customer state, heavy-key joins, inferred records, collated text, byte chunks, phrases."""

import collections
import datetime as dt
import json
import os
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.collated import collated, group_ignoring_case, ignoring_case, join_ignoring_case, plain
from tessera.operators import bitmaps, sketches
from tessera.operators.customer_state import CustomerState, merged_state, partial_state
from tessera.operators.heavy_join import heavy_keys, join_heavy
from tessera.operators.sentiment import Lexicon, analyze_sentiment_udf, sentiment
from tessera.operators.variant import inferred_schema, project_inferred, to_variant, widened_schema
from tessera.sources.batches import BatchStore
from tessera.sources.lines import assign_chunks_by_bytes


@pytest.fixture()
def store(spark):
    return BatchStore(spark, tempfile.mkdtemp(prefix="tessera-store-"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -------------------------------------------------------------------- sketches

def numbers(spark, lo, hi):
    return spark.range(lo, hi).select(
        "id", (F.col("id") % 1000).cast("int").alias("k"), F.when(F.col("id") % 4 == 0, F.concat(F.lit("v"), F.col("id") % 37)).alias("t"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 365).cast("int")).alias("d"), F.lit(None).cast("double").alias("none"))


def test_sketches_are_within_their_bounds_and_merge(spark):
    df = numbers(spark, 0, 40_000)
    parts = sketches.column_sketches(df, F.pmod("id", F.lit(5)))
    assert parts.count() == 25
    at = (0.1, 0.5, 0.9)
    merged = {r.column_name: r for r in sketches.estimates(sketches.merged_sketches(parts), at).collect()}
    whole = {r.column_name: r for r in sketches.estimates(sketches.column_sketches(df, F.lit("all")), at).collect()}
    for c, distinct, span in (("id", 40_000, 40_000), ("k", 1000, 1000), ("t", 37, None), ("d", 365, 365), ("none", 0, None)):
        for got in (merged[c], whole[c]):
            assert got.n_rows == 40_000 and got.n_null == {"t": 30_000, "none": 40_000}.get(c, 0)
            assert abs(got.n_distinct - distinct) <= 4 * sketches.DISTINCT_ERROR * distinct
            base = 18_262 if c == "d" else 0
            assert (got.quantiles is None) == (span is None)
            for q, v in zip(at, got.quantiles or ()):
                assert abs((v - base) / span - q) <= sketches.RANK_ERROR + 1 / span


def test_frequent_values_merge(spark):
    rng = random.Random(4)
    words = [f"w{min(int(rng.paretovariate(0.8)), 5000)}" for _ in range(20_000)]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i long, w string")
    got = {r.value: r.n for r in sketches.frequent_values(sketches.frequent_sketches(df, F.col("i") % 4, "w"), 5).collect()}
    exact = collections.Counter(words)
    error = len(words) / sketches.MAX_TRACKED * 4 / 3
    assert set(got) == {w for w, _ in exact.most_common(5)} and all(abs(n - exact[w]) <= error for w, n in got.items())


def test_profile_store_reads_new_files_only(spark, store):
    folder = tempfile.mkdtemp(prefix="tessera-src-") + "/t"
    profile = sketches.ProfileStore(store)
    numbers(spark, 0, 5000).coalesce(1).write.parquet(folder)
    assert profile.refresh(folder) == 1 and profile.refresh(folder) == 0
    numbers(spark, 5000, 9000).coalesce(1).write.mode("append").parquet(folder)
    assert profile.refresh(folder) == 1
    got = {r.column_name: r for r in profile.profile().collect()}
    assert {r.n_rows for r in got.values()} == {9000} and abs(got["id"].n_distinct - 9000) <= 4 * sketches.DISTINCT_ERROR * 9000
    assert store.read(profile.TABLE, sketches.SKETCH).select("part").distinct().count() == 2


# --------------------------------------------------------------------- bitmaps

def test_bitmaps_are_exact_and_merge(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), "hot" if i % 2 else rng.choice("xyz"), f"u{rng.randrange(90_000)}" if i % 9 else None) for i in range(60_000)]
    df = spark.createDataFrame(rows, "g string, h string, u string")
    ids = bitmaps.dense_ids(df, "u")
    assert ids.agg(F.min("dense_id"), F.max("dense_id"), F.count_distinct("dense_id")).first() == (
        1, len({u for *_, u in rows} - {None}), len({u for *_, u in rows} - {None}))
    halves = [bitmaps.distinct_bitmaps(df.where(c).join(ids, "u", "left"), ["g", "h"]) for c in ("g = 'a' or h = 'x'", "not (g = 'a' or h = 'x')")]
    fine = halves[0].unionByName(halves[1])
    for groups in (["g", "h"], ["g"], ["h"], []):
        counts = bitmaps.distinct_counts(bitmaps.merge_bitmaps(fine, groups), groups)
        assert "Expand" not in counts._jdf.queryExecution().optimizedPlan().toString()
        exact = df.groupBy(*groups).agg(F.count_distinct("u").alias("n"))
        assert rows_of(counts) == rows_of(exact)


# -------------------------------------------------------------- customer state

def food(rng, n):
    day = dt.datetime(2024, 1, 1)
    return [(i, None if i % 50 == 0 else 1 if i % 3 == 0 else rng.randrange(2, 25), day + dt.timedelta(hours=rng.randrange(24 * 40)),
             rng.choice([None, "P1", "P2"])) for i in range(n)]


def test_state_after_batches_in_any_order_is_the_full_answer(spark, store):
    rng = random.Random(6)
    orders = spark.createDataFrame(food(rng, 900), "order_id long, customer_code long, placed_at timestamp, promo_code_name string")
    full = rows_of(partial_state(orders))
    state = CustomerState(store)
    assert state.current().count() == 0
    for step, k in enumerate((4, 1, 1, 3, 0, 2)):
        assert state.update(str(k), orders.where(F.col("order_id") % 5 == k)) == (step != 2)
        if step in (2, 4):
            assert state.compact() == state.compact()
    columns = partial_state(orders).columns
    assert rows_of(state.current().select(*columns)) == full
    assert rows_of(merged_state(partial_state(orders)).select(*columns)) == full


# ------------------------------------------------------------- heavy-key joins

@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_heavy_join_equals_the_plain_join(spark, how):
    rng = random.Random(8)
    left = spark.createDataFrame([(i, 7 if i % 3 == 0 else None if i % 10 == 1 else rng.randrange(500), "a") for i in range(4000)],
                                 "i long, k long, s string")
    right = spark.createDataFrame([(k, "a", f"r{k}.{j}") for k in range(0, 400, 2) for j in range(1 + k % 3)] + [(7, "a", "hot"), (None, "a", "null")],
                                  "k long, s string, v string")
    assert rows_of(join_heavy(left, right, ["k", "s"], how)) == rows_of(left.join(right, ["k", "s"], how))
    assert rows_of(join_heavy(left.limit(0), right, ["k", "s"], how)) == []


def test_heavy_rows_are_spread(spark):
    left = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert rows_of(heavy_keys(left, ["k"])) == [(7, 6668)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_heavy(left, right, ["k"], "left")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain_sizes = [r["count"] for r in left.join(right, "k", "left").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(plain_sizes) > 8000 and max(sizes) < 3500 and sum(sizes) == 20_000
    with pytest.raises(ValueError):
        join_heavy(left, right, ["k"], "right")


# ------------------------------------------------------------ inferred records

def test_fields_are_found_widened_and_kept(spark):
    first = [{"a": 1, "b": "x", "c": {"d": 1}, "e": [1, 2], "n": None}, {"a": 2, "odd name": True}]
    second = [{"a": 2.5, "b": 7, "c": {"d": "t", "f": 1}, "g": "new"}, {"e": ["x"], "c": 5}]
    frame = lambda rows: spark.createDataFrame([(json.dumps(r),) for r in rows], "j string").select(to_variant("j").alias("v"))
    one = inferred_schema(frame(first), "v")
    assert {f.name: f.dataType for f in one} == {
        "a": T.LongType(), "b": T.StringType(), "c": T.StructType([T.StructField("d", T.LongType())]),
        "e": T.ArrayType(T.LongType()), "n": T.StringType(), "odd name": T.BooleanType()}
    got = project_inferred(frame(second), "v", one).selectExpr("a", "b", "transform_values(rest, (k, x) -> cast(x as string)) r").collect()
    assert got[0].r == {"g": "new"} and got[1].r is None
    both = widened_schema(one, inferred_schema(frame(second), "v"))
    types = {f.name: f.dataType.simpleString() for f in both}
    assert types["a"].startswith("decimal") and types["b"] == "string" and types["g"] == "string" and types["c"] == "variant"
    assert widened_schema(both, one) == both
    out = project_inferred(frame(first + second), "v", both, rest=None).selectExpr("cast(a as double) a", "b", "g", "`odd name` o").collect()
    assert [r.a for r in out] == [1.0, 2.0, 2.5, None] and [r.b for r in out] == ["x", None, "7", None] and out[2].g == "new" and out[1].o
    assert inferred_schema(frame([]), "v") == T.StructType() == inferred_schema(frame([5]), "v")
    mixed = inferred_schema(frame([{"m": 1}, {"m": "one"}, {"m": True}]), "v")
    assert mixed["m"].dataType == T.StringType()


# --------------------------------------------------------------- collated text

def test_groups_and_joins_without_case(spark):
    df = spark.createDataFrame([(1, "Paris", 2), (2, "PARIS", 3), (3, "paris", 4), (4, "Ürgüp", 1), (5, "üRGÜP", 1), (6, None, 9)], "i int, city string, n int")
    got = group_ignoring_case(df, ["city"], ["i"], F.sum("n").alias("n"))
    assert rows_of(got) == rows_of(spark.createDataFrame([("Paris", 9), ("Ürgüp", 2), (None, 9)], "city string, n long"))
    other = spark.createDataFrame([("pARIS", "fr"), ("URGUP", "xx"), (None, "none")], "city string, land string")
    assert sorted((r.i, r.city, r.land) for r in join_ignoring_case(df, other, ["city"]).collect()) == [
        (1, "Paris", "fr"), (2, "PARIS", "fr"), (3, "paris", "fr")]
    assert {r.i for r in join_ignoring_case(df, other, ["city"], "left_anti").collect()} == {4, 5, 6}
    with pytest.raises(ValueError):
        join_ignoring_case(df, other, ["city"], "full")
    c = collated(df)
    assert c.where("city = 'PaRiS'").count() == 3 and c.where("city in ('ürgüp')").count() == 2
    assert c.where(F.col("city").like("PAR%")).count() == 3 and c.select("city").distinct().count() == 3
    assert plain(c).schema["city"].dataType == T.StringType() and df.where(ignoring_case("city") == "PARIS").count() == 3


# ----------------------------------------------------------------- byte chunks

@pytest.mark.parametrize("bound", [100_000, 2])
def test_chunks_of_equal_bytes(spark, monkeypatch, bound):
    from tessera.sources import lines
    monkeypatch.setattr(lines, "MAX_BROADCAST_SEGMENTS", bound)
    rng = random.Random(9)
    folder, texts = tempfile.mkdtemp(prefix="tessera-test-"), []
    for f in range(25):  # one hot file beside small ones
        own = ["é" * rng.randrange(40) for _ in range(3000 if f == 7 else rng.randrange(6))]
        texts += own
        with open(os.path.join(folder, f"f{f:02d}.txt"), "w") as out:
            out.writelines(t + "\n" for t in own)
    df = spark.read.text(folder).withColumn("f", F.col("_metadata.file_path"))
    got = sorted((r.first_byte, r.chunk, r.value) for r in assign_chunks_by_bytes(df, 7, file_col="f").collect())
    assert [v for *_, v in got] == texts or collections.Counter(v for *_, v in got) == collections.Counter(texts)
    at, total = 0, sum(len(t.encode()) + 1 for t in texts)
    for t, (first, chunk, value) in zip(texts, got, strict=True):
        assert (first, chunk, value) == (at, at * 7 // total, t)
        at += len(t.encode()) + 1
    sizes = collections.Counter()
    for _, chunk, value in got:
        sizes[chunk] += len(value.encode()) + 1
    assert len(sizes) == 7 and all(abs(s - total / 7) <= 81 for s in sizes.values())
    assert assign_chunks_by_bytes(df.where("false"), 7, file_col="f").count() == 0


# ------------------------------------------------------------------- sentiment

def plain_score(text, phrases, negators, window):
    tokens = [t for t in re.split("[^a-z]+", (text or "").lower()) if t]
    total, n, i = 0, 0, 0
    while i < len(tokens):
        here = [p for p in phrases if tokens[i:i + len(p)] == p]
        if here:
            taken = max(here, key=len)
            sign = -1 if window and set(tokens[max(0, i - window):i]) & set(negators) else 1
            total, n = total + sign * phrases_units[" ".join(taken)], n + 1
            i += len(taken)
        else:
            i += 1
    return total, n


phrases_units = {}


def test_phrases_and_negation_equal_a_plain_walk(spark):
    rng = random.Random(10)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    phrases = {" ".join(rng.choices(words, k=rng.choice([1, 1, 2, 3]))): rng.randrange(-9, 10) / 10 for _ in range(3000)}
    phrases_units.clear()
    phrases_units.update({p: round(v * 10) for p, v in phrases.items()})
    texts = [" ".join(rng.choices([*words, "not", "never", "zz", "Not,"], k=rng.randrange(60))) for _ in range(120)] + [None, "", "...", "not"]
    lexicon = Lexicon(spark, phrases, ["not", "never"], window=2)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    scored = docs.select("id", F.expr(lexicon.scored("text")).alias("s")).collect()
    split = [p.split() for p in phrases]
    assert {r.id: (r.s.units * 10 // 10 ** lexicon.scale if lexicon.scale != 1 else r.s.units, r.s.n) for r in scored} == {
        i: plain_score(t, split, ["not", "never"], 2) for i, t in enumerate(texts)}
    plan = sentiment(docs, ["id"], "text", lexicon)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_negation_in_sql(spark):
    analyze_sentiment_udf(spark, {"good": 1, "not good enough": -2, "bad": -1}, "judge", ["not"], 2)
    texts = ["good", "not good", "not very good", "not so very good", "not good enough", "not bad", None]
    got = [r.s for r in spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("judge(t) s").collect()]
    assert got == ["Positive", "Negative", "Negative", "Positive", "Negative", "Positive", "Neutral"]
    with pytest.raises(ValueError):
        Lexicon(spark, {"good": 1}, ["not at all"])
