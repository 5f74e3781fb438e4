"""Quality rules by distribution divergence.

A document's histogram of character classes and its histogram of its
language's common words are compared with references by the Jensen-Shannon
distance (the square root of the divergence, base 2). A language's common words
are learned: of the words made of letters alone, the ``COMMON_WORDS`` that most
of its documents of ``MIN_WORDS`` words or more hold. References are the median
frequencies over the language's documents that pass the base rules, scaled to a
sum of one, so that a minority of odd documents does not move them; medians
come from counts in ``BINS`` bins of equal width, so they are the same however
the rows are dealt. A histogram is judged only from a minimum length on, and
the limit widens with the noise that a short text has (by the root of bins over
length).

Base rules count words, symbols, repeated lines and words in repeated 3-word
windows. Only DataFrame functions are used: one pass over the texts for the
common words, one for the counts, then small rows; words are combined before
they are shuffled, and references are sums of counts.

Edge cases: a null or empty text has no words and fails the base rules; a
language without common words (no document is long enough), or without
documents that pass the base rules, is judged by the reference over all
languages (character classes) and not by words; a null language is a language
of its own; words that equally many documents hold are taken in code-point
order; repeated rows and null ids are judged row by row; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, is_small, stored, text_or_empty
from tessera.sources.tables import read_table

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_CHARS = 200
CHAR_LIMIT = 0.16
WORD_LIMIT = 0.20
CHAR_NOISE, WORD_NOISE = 0.9, 0.25
BROADCAST_LANGUAGES, LITERAL_LANGUAGES = 10_000, 200
SPACE = r"[ \x09-\x0D]+"

COMMON_WORDS = 16
BINS = 1 << 14
#: Character classes counted by what their removal takes away; lower-case and
#: other letters are the rest.
CLASSES = (r"[A-Z]+", r"[0-9]+", r"[.,;:!?'\"()-]+", r"[#$%&*+/<=>@\[\]^_`{|}~\\]+", r"[^\x00-\x7F]+")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def common_words(docs: DataFrame) -> DataFrame:
    """(known_lang, common): the common words of every language, a row each."""
    def distinct(words: Column) -> Column:  # a text may begin and end with white space
        blank = (F.get(words, F.lit(0)) == "").cast("int") + (F.get(words, F.size(words) - 1) == "").cast("int")
        return F.when(F.size(words) - blank >= MIN_WORDS, F.array_distinct(words))

    # within a lambda the words are split once; a filter above would split them again
    lists = F.transform(F.array(F.split(F.lower(text_or_empty("text")), SPACE)), distinct)
    held = (docs.select("lang", F.explode(F.flatten(F.filter(lists, lambda x: x.isNotNull()))).alias("word"))
            .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).where(F.rlike("word", F.lit(r"^\p{L}+$"))))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    return (held.withColumn("place", place).where(F.col("place") <= COMMON_WORDS)
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("top"))
            .select(F.col("lang").alias("known_lang"), F.transform("top", lambda x: x["word"]).alias("common")))


def text_counts(docs: DataFrame) -> DataFrame:
    """Counts of every document; none of its text goes on."""
    learned = stored(common_words(docs), "common-words")
    known = broadcast_if_small(learned, BROADCAST_LANGUAGES)
    # at most COMMON_WORDS words of each of LITERAL_LANGUAGES: most words of a text are none of them
    few = is_small(learned, LITERAL_LANGUAGES)
    any_of = [r.word for r in learned.select(F.explode("common").alias("word")).distinct().collect()] if few else []
    longest = max(map(len, any_of), default=0)  # lower case never has fewer characters
    may_be = (lambda w: (F.length(w) <= longest) & F.lower(w).isin(any_of)) if any_of else (lambda w: F.lit(not few))
    words = (docs.select("doc_id", "lang", text_or_empty("text").alias("text"))
             .join(known, F.col("lang").eqNullSafe(F.col("known_lang")), "left").drop("known_lang")
             .withColumn("words", _words(F.col("text"))))
    n = F.size("words")
    # the last two windows are of fewer words: no other equals them
    triples = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit(r"[^ \x09-\x0D]")))
    counted = words.withColumn("triples", triples).withColumn("lines", lines)
    # only a text that repeats some window needs the windows in order (sort_array compares without a lambda)
    ordered = F.when(F.size(F.array_distinct("triples")) < F.size("triples"), F.sort_array(
        F.transform("triples", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    counted = counted.withColumn("ordered", ordered)
    same = lambda e, at: F.coalesce(F.get("ordered", at)["h"] == e["h"], F.lit(False))
    repeated = F.sort_array(F.transform(
        F.filter("ordered", lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e["i"]))
    counted = counted.withColumn("repeated", repeated)
    in_windows = _sum(F.transform("repeated", lambda x, k: F.least(
        F.lit(3), F.coalesce(x - F.get("repeated", k - 1), F.lit(3))).cast("long")))
    # most characters are of no class counted below: one pass takes them away
    counted = counted.withColumn("rest", F.regexp_replace("text", r"[a-z \x09-\x0D]+", ""))
    classes = [(F.length("rest") - F.length(F.regexp_replace("rest", c, ""))).cast("long") for c in CLASSES]
    counted = counted.withColumn("met", F.transform(
        F.filter("words", may_be), lambda w: F.array_position("common", F.lower(w))))
    return counted.select(
        "doc_id", "lang", n.cast("long").alias("n_words"), F.length("text").cast("long").alias("n_chars"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("rest", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(in_windows, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(*classes).alias("classes"),
        F.transform("common", lambda w, k: F.size(F.filter("met", lambda m: m == k + 1)).cast("long")).alias("common"))


def _histograms(counts: DataFrame) -> DataFrame:
    """The counts with both histograms as frequencies and the base verdict.
    Character classes leave white space out."""
    rest = F.greatest(F.col("word_chars") - _sum(F.col("classes")), F.lit(0))
    chars = F.concat("classes", F.array(rest))
    words = F.concat("common", F.array(F.greatest(F.col("n_words") - _sum(F.col("common")), F.lit(0))))
    share = lambda h, total: F.when(F.col(total) > 0, F.transform(h, lambda x: x / F.col(total)))
    return counts.withColumn("chars", share(chars, "word_chars")).withColumn("words", share(words, "n_words")) \
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
            100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def _scaled(histogram: Column) -> Column:
    total = F.aggregate(histogram, F.lit(0.0), lambda s, x: s + x)
    return F.when(total > 0, F.transform(histogram, lambda x: x / total))


def references(histograms: DataFrame, *keys: str) -> DataFrame:
    """Reference histograms by ``keys``, a row per group, from the documents
    that pass the base rules."""
    passed = histograms.where(~F.col("base_failed") & (F.col("n_chars") >= MIN_CHARS))
    n_chars = len(CLASSES) + 1
    shares = F.concat("chars", F.coalesce("words", F.array().cast("array<double>")))
    counts = (passed.select(*keys, F.posexplode(shares).alias("k", "share"))
              .groupBy(*keys, "k", F.floor(F.col("share") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    own = Window.partitionBy(*keys, "k")  # at most a row per bin
    medians = (counts.withColumn("total", F.sum("n").over(own))
               .withColumn("upto", F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
               .where(2 * F.col("upto") >= F.col("total")).groupBy(*keys, "k").agg((F.min("bin") / BINS).alias("median"))
               .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", "median"))).alias("all")))
    part = lambda wanted: _scaled(F.transform(F.filter("all", wanted), lambda x: x["median"]))
    return medians.select(*keys, part(lambda x: x["k"] < n_chars).alias("ref_chars"),
                          part(lambda x: x["k"] >= n_chars).alias("ref_words"))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms, 0 to 1; null if one is."""
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)
    total = F.aggregate(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a)), F.lit(0.0), lambda s, x: s + x)
    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(total / 2, F.lit(0.0))))


def judge_texts(docs: DataFrame) -> DataFrame:
    """Counts, distances and verdict of every row of ``docs``."""
    found = _histograms(stored(text_counts(docs), "rule-counts"))
    by_lang = references(found, "lang")
    overall = references(found.withColumn("words", F.lit(None).cast("array<double>"))).first()  # one row, if any
    known = overall is not None and overall["ref_chars"] is not None
    fallback = F.array(*map(F.lit, overall["ref_chars"])) if known else F.lit(None).cast("array<double>")
    refs = broadcast_if_small(by_lang.withColumnRenamed("lang", "ref_lang"), BROADCAST_LANGUAGES)
    joined = found.join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    char_distance = jensen_shannon(F.col("chars"), F.coalesce("ref_chars", fallback))
    word_distance = jensen_shannon(F.col("words"), F.col("ref_words"))
    fails = lambda d, base, noise, bins, n, least: F.coalesce(
        (F.col(n) >= least) & (F.col(d) > base + noise * F.sqrt(bins.cast("double") / F.col(n))), F.lit(False))
    judged = joined.withColumn("char_distance", char_distance).withColumn("word_distance", word_distance)
    return judged.withColumn("kept", ~(
        F.col("base_failed")
        | fails("char_distance", CHAR_LIMIT, CHAR_NOISE, F.lit(len(CLASSES) + 1), "n_chars", MIN_CHARS)
        | fails("word_distance", WORD_LIMIT, WORD_NOISE, F.size("words"), "n_words", MIN_WORDS)))


def op10_quality_rules(spark, sf_dir) -> DataFrame:
    """Counts and verdict of every document."""
    return judge_texts(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))
