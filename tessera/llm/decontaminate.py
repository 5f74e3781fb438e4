"""Benchmark decontamination by template canonicalisation.

Texts become sequences of canonical tokens: numbers, units behind numbers and
names (capitalised words inside a sentence) turn into typed placeholders, all
else is lower-cased words. Windows of ``WINDOW`` tokens are hashed and joined
with the windows of the benchmark items. Matches that lie on one diagonal
(document position less item position) form an alignment; there, each value of
an item's slot must stand for one value in the document throughout, or at least
each value in one role (the ``ROLE_TOKENS`` tokens on either side), as equal
values may mean different things. So an item is found verbatim, and also with
other numbers, names or units put in.

A document holds an item if an alignment covers ``MIN_COVERAGE`` of the item's
tokens or at least ``MIN_TOKENS`` of them, and its slots are consistent or its
windows without a changed slot cover as much alone.

Only DataFrame functions are used. Benchmark windows are broadcast when their
counted rows are within ``BROADCAST_WINDOWS``, and shuffled otherwise; only
alignments, never windows or texts of documents, are shuffled in the first
case.

Edge cases: null and empty texts hold nothing; an item shorter than a window
is one window of its own length, and one of under ``MIN_ITEM`` tokens is held
only by a document that is nothing else; a window with under ``MIN_WORDS`` (or half of
its) tokens that are no placeholders is compared with its values, so rows of
numbers are found verbatim only; rows that repeat an id are searched each, and
equal rows give one result; a document without an id is searched as well (its
pair has a null id); empty tables give no rows; other columns pass the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, fresh, stored, text_or_empty
from tessera.sources.tables import read_table

WINDOW = 8
MIN_WORDS = 4
MIN_COVERAGE = 0.5
MIN_TOKENS = 13
MIN_CONSISTENT = 0.75
ROLE_TOKENS = 2
#: An item of fewer tokens says too little to be found inside a longer text.
MIN_ITEM = 3
BROADCAST_WINDOWS = 1_000_000

# Unit words that follow a number.
UNITS = ("kg", "g", "mg", "lb", "lbs", "oz", "km", "m", "cm", "mm", "mi", "mile", "miles", "ft", "feet",
         "inch", "inches", "meter", "meters", "metre", "metres", "kilometers", "l", "ml", "liter", "liters",
         "litre", "litres", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro",
         "euros", "cent", "cents", "percent", "degrees", "mph", "kmh", "kb", "mb", "gb", "tb", "w", "kw", "v")
MARK = "\x01"


def canonical_tokens(text: Column) -> Column:
    """Tokens in order. A slot is ``\\x01``, its type letter (n, u or p) and its
    value; any other token is a lower-case word."""
    marked = F.replace(text_or_empty(text), F.lit(MARK), F.lit(" "))
    # the decimal point or thousands mark belongs to its number
    marked = F.regexp_replace(marked, r"(?<=[0-9])[.,](?=[0-9])", "_")
    marked = F.regexp_replace(marked, r"(?<=[\p{Ll}\p{N},;:] )\p{Lu}[\p{Ll}\p{M}]++(?![\p{L}\p{N}])", f"{MARK}p$0")
    marked = F.regexp_replace(marked, rf"([0-9]) ?({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"$1 {MARK}u$2")
    marked = F.regexp_replace(marked, r"(?<![\p{L}\p{N}_])[0-9][0-9_]*+", f" {MARK}n$0")
    return F.filter(F.split(F.lower(marked), rf"[^\p{{L}}\p{{M}}\p{{N}}_{MARK}]+"), lambda t: t != "")


def _is_slot(token: Column) -> Column:
    return F.startswith(token, F.lit(MARK))


def _template(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(_is_slot(t), F.substring(t, 1, 2)).otherwise(t))


def _poor(part: Column, length: Column) -> Column:
    """Whether a window of a template has too few words."""
    return F.size(F.filter(part, lambda t: ~_is_slot(t))) < F.least(F.lit(MIN_WORDS), F.ceil(length / 2))


def _values_hash(tokens: Column) -> Column:
    """Hash of a window's values, whatever their types; unlike any template's."""
    values = F.transform(tokens, lambda t: F.when(_is_slot(t), F.substr(t, F.lit(3))).otherwise(t))
    return F.xxhash64(F.concat(F.array(F.lit(MARK)), values))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(hash, length, poor, item_id, item_pos, item_tokens): the benchmark's
    windows, by template or, if they are poor in words, by values."""
    size = F.least(F.size("template"), F.lit(window))
    rows = items.where("size(template) > 0").select(
        "item_id", "template", "tokens", F.size("template").alias("item_tokens"), size.alias("length"),
        F.explode(F.sequence(F.lit(1), F.size("template") - size + 1)).alias("item_pos"))
    part = F.slice("template", F.col("item_pos"), F.col("length"))
    values = F.slice("tokens", F.col("item_pos"), F.col("length"))
    return rows.withColumn("poor", _poor(part, F.col("length"))).select(
        F.when(F.col("poor"), _values_hash(values)).otherwise(F.xxhash64(part)).alias("hash"),
        "length", "poor", "item_id", "item_pos", "item_tokens")


def _document_windows(docs: DataFrame, lengths: dict[int, bool]) -> DataFrame:
    """(rid, doc_id, doc_tokens, pos, hash, length): windows of every length that occurs
    in the benchmark (one, unless items are shorter than a window); by values
    as well where the benchmark has windows of that length poor in words."""
    n = F.size("template")
    out = None
    for k, values in lengths.items():
        def hashed(i: Column) -> Column:
            part = F.slice("template", i, F.lit(k))  # noqa: B023 -- called at once
            if not values:  # noqa: B023
                return F.xxhash64(part)
            return F.when(_poor(part, F.lit(k)), _values_hash(F.slice("tokens", i, F.lit(k)))).otherwise(F.xxhash64(part))  # noqa: B023

        windows = F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), hashed))
        part = docs.select("rid", "doc_id", n.alias("doc_tokens"), F.posexplode(windows).alias("pos", "hash"), F.lit(k).alias("length"))
        out = part if out is None else out.unionByName(part)
    return out


def _covered(at: Column) -> Column:
    """Tokens that the windows at these item positions cover."""
    return F.aggregate(F.transform(at, lambda x, k: F.least(F.col("length"), F.coalesce(
        x - F.get(at, k - 1), F.col("length")))), F.lit(0), lambda a, x: a + x)


def _enough(tokens: Column) -> Column:
    return (tokens >= MIN_COVERAGE * F.col("item_tokens")) | (tokens >= MIN_TOKENS)


def _role(i: Column) -> Column:
    """The tokens around place ``i`` (0 first) of a template."""
    before = F.slice("template", F.greatest(i - ROLE_TOKENS, F.lit(0)) + 1, F.least(i, F.lit(ROLE_TOKENS)))
    return F.struct(before, F.slice("template", i + 2, F.lit(ROLE_TOKENS)))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, doc_id, item_id, covered_tokens, item_tokens, n_slots,
    reparameterised): a row per document and item it holds. ``rid`` tells rows
    of documents apart."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")
    tokens = rows.select("rid", "doc_id", canonical_tokens(F.col("text")).alias("tokens"))
    items = (benchmark.where("item_id is not null").select("item_id", canonical_tokens(F.col("text")).alias("tokens"))
             .withColumn("template", _template(F.col("tokens"))))
    windows = item_windows(items, window)
    # at most ``window`` rows
    lengths = dict(sorted(tuple(r) for r in windows.groupBy("length").agg(F.max("poor")).collect())) or {window: False}
    hits = _document_windows(tokens.select("rid", "doc_id", "tokens", _template(F.col("tokens")).alias("template")), lengths) \
        .join(broadcast_if_small(windows.drop("poor"), BROADCAST_WINDOWS), ["hash", "length"]) \
        .where((F.col("item_tokens") >= MIN_ITEM) | (F.col("item_tokens") == F.col("doc_tokens")))
    # an alignment: the matched item positions on one diagonal, bounded by the item
    aligned = hits.groupBy("rid", "doc_id", "item_id", (F.col("pos") + 1 - F.col("item_pos")).alias("shift")).agg(
        F.first("item_tokens").alias("item_tokens"), F.first("length").alias("length"),
        F.sort_array(F.collect_set("item_pos")).alias("at"))
    # written once: the corpus is searched once, and alignments are few
    aligned = stored(aligned.withColumn("covered_tokens", _covered(F.col("at"))).where(_enough(F.col("covered_tokens"))), "alignments")
    slots = F.filter(F.transform("tokens", lambda t, i: F.struct(i.alias("i"), t.alias("value"), _role(i).alias("role"))),
                     lambda s: _is_slot(s["value"]))
    aligned = aligned.join(items.select("item_id", slots.alias("slots")), "item_id")
    # slots that no document token can change need no look at the document
    plain = aligned.where("size(slots) = 0").withColumn("n_slots", F.lit(0)).withColumn(
        "consistent", F.lit(True)).withColumn("reparameterised", F.lit(False))
    within = lambda i, a: (i + 1 >= a) & (i + 1 < a + F.col("length"))
    paired = F.transform(
        F.filter("slots", lambda s: F.exists("at", lambda a: within(s["i"], a))),
        lambda s: F.struct(s["i"].alias("i"), s["role"].alias("role"), s["value"].alias("item"),
                           F.get("tokens", s["i"] + F.col("shift")).alias("doc")))

    def one_to_one(*key: str) -> Column:
        """Whether values of the item stand for one value each, told apart by ``key``."""
        distinct = lambda *names: F.size(F.array_distinct(F.transform(
            "pairs", lambda x: F.struct(*[x[n].alias(n) for n in names]))))
        return distinct(*key) >= MIN_CONSISTENT * distinct(*key, "doc")

    changed = F.filter("pairs", lambda x: x["item"] != x["doc"])
    verbatim = F.filter("at", lambda a: ~F.exists("changed", lambda x: within(x["i"], a)))
    # only the documents of alignments with slots are looked at again
    wanted = aligned.where("size(slots) > 0").select("rid").distinct()
    again = (rows.join(broadcast_if_small(wanted, BROADCAST_WINDOWS), "rid", "left_semi").dropDuplicates(["rid"])
             .select("rid", canonical_tokens(F.col("text")).alias("tokens")))
    slotted = (aligned.where("size(slots) > 0").join(again, "rid")
               .withColumn("pairs", paired).withColumn("n_slots", F.size("pairs"))
               .withColumn("changed", changed).withColumn("verbatim", verbatim)
               .withColumn("consistent", one_to_one("item") | one_to_one("item", "role")
                           | _enough(_covered(F.col("verbatim"))))
               .withColumn("reparameterised", F.size("changed") > 0))
    columns = ["rid", "doc_id", "item_id", "covered_tokens", "item_tokens", "n_slots", "reparameterised"]
    held = plain.where("consistent").select(*columns).unionByName(slotted.where("consistent").select(*columns))
    best = F.max(F.struct("covered_tokens", "n_slots", "reparameterised", "item_tokens")).alias("best")
    return held.groupBy("rid", "doc_id", "item_id").agg(best).select(
        "rid", "doc_id", "item_id", *[f"best.{c}" for c in columns[3:]])


def op3_decontamination(spark, sf_dir) -> DataFrame:
    """Every (document, benchmark item) pair where the document holds the item."""
    return contaminated_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", F.col("covered_tokens").cast("long").alias("covered_tokens"),
        F.col("item_tokens").cast("long").alias("item_tokens"), F.col("n_slots").cast("long").alias("n_slots"),
        "reparameterised")


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rid = fresh(docs, "rid")
    held = contaminated_pairs(docs, read_table(spark, sf_dir, "benchmark")).select(F.col("rid").alias(rid)).distinct()
    return docs.withColumn(rid, F.xxhash64("doc_id", "text")).join(held, rid, "left_anti").select(
        *[f"`{c}`" for c in docs.columns])
