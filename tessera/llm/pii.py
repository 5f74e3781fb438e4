"""Personal data by pattern, and information-theoretic sanitisation of the
terms that give it away.

Base spans: e-mail addresses, IPv4 addresses, payment cards (Luhn) and phone
numbers, leftmost and non-overlapping per kind.

Disclosure: a protected entity is a distinct base value. For a term ``t`` in
the texts of an entity ``c``, the corpus gives the pointwise mutual information
``PMI = ln(N * n_tc / (n_t * n_c))`` and the entity's information content
``IC = ln(N / n_c)``; ``PMI / IC`` is the share of the entity's information
that the term alone reveals (1: the term occurs only with it). N, n_t, n_c and
n_tc count distinct texts, so exact copies weigh once; a text has a term if the
word stands anywhere in it outside the base spans. Terms whose share reaches
``GENERALISE`` (in ``MIN_SUPPORT`` texts with the entity at least) become spans
of kind ``term`` in the texts with that entity: generalised to their kind, or
removed from ``REMOVE`` on.

Only DataFrame functions are used. Patterns are written so that matching is
linear in a text's length (possessive, each start tried once), which changes no
match. Co-occurrence is counted over the whole texts of entities with enough
texts, combined before every shuffle; all documents are looked at only for the
terms that can still reach the threshold.

Edge cases: null and empty texts have no spans; a null id and repeated rows are
handled row by row (equal rows share their counts); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, stored, text_or_empty
from tessera.sources.tables import read_table

GENERALISE = 0.9
REMOVE = 0.98
MIN_SUPPORT = 3
BROADCAST_TERMS = 1_000_000

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_IN_WORD = r"\p{L}\p{N}"
WORD = rf"[{_IN_WORD}]+"


#: Matches and spans that are walked as one list; longer lists are walked in
#: such chunks, since a list that grows is copied at every step.
CHUNK = 256


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chunks(values: Column) -> Column:
    last = F.floor((F.size(values) - 1) / CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(values, c * CHUNK + 1, F.lit(CHUNK)))


def placed(text: Column, pattern: Column | str) -> Column:
    """array<struct<start, end, value>> of the matches, in code points."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    # the gap before a match follows the end of the match before it
    pieces = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(done: Column, piece: Column) -> Column:
        at = done["at"] + piece["gap"]
        end = at + F.length(piece["value"])
        return F.struct(end.alias("at"), F.concat(done["found"], F.array(F.struct(
            at.alias("start"), end.alias("end"), piece["value"].alias("value")))).alias("found"))

    def walked(some: Column) -> Column:
        return F.aggregate(some, F.struct(F.lit(0).alias("at"), none.alias("found")), add)

    def later(done: Column, chunk: Column) -> Column:
        return F.struct((done["at"] + chunk["at"]).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts"))

    def joined(chunks: Column) -> Column:
        starts = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")), later)["starts"]
        return F.flatten(F.zip_with(chunks, starts, lambda chunk, start: F.transform(chunk["found"], lambda m: F.struct(
            (m["start"] + start).alias("start"), (m["end"] + start).alias("end"), m["value"].alias("value")))))

    many = _let(pieces, lambda p: _let(F.transform(_chunks(p), walked), joined))
    return F.when(F.size(found) > CHUNK, many).when(F.size(found) > 0, walked(pieces)["found"]).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    n = F.length(digits)

    def weight(k: Column) -> Column:  # k: place from the right, 0 first
        digit = F.substr(digits, n - k, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(k % 2 == 0, digit).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, k: s + weight(k)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (
            F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.regexp_replace(p, "^0+(?=.)", "").cast("int") <= 255))
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


#: What a text must hold for a kind to be looked for at all.
_HINT = {"email": lambda t: F.contains(t, F.lit("@")), "phone": lambda t: F.contains(t, F.lit("+"))}


def base_spans(text: Column) -> Column:
    """array<struct<start, place, kind, end, value>> of one text, by start, then
    kind in the order listed."""
    parts = []
    for place, kind in enumerate(KINDS):
        hits = F.filter(placed(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))  # noqa: B023
        spans = F.transform(hits, lambda m: F.struct(
            m["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"),  # noqa: B023
            m["end"].alias("end"), m["value"].alias("value")))
        none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int,value:string>>")
        parts.append(F.when(_HINT[kind](text), spans).otherwise(none) if kind in _HINT else spans)
    return F.array_sort(F.concat(*parts))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _entity(kind: Column, value: Column) -> Column:
    return F.concat(kind, F.lit(":"), F.when(kind == "email", F.lower(value)).otherwise(_digits(value)))


def _replaced(text: Column, spans: Column) -> Column:
    """The text with spans (struct<start, end, by>, by start) replaced; of
    spans that overlap the first one's ``by`` stands for all."""
    def step(done: Column, chunk: Column) -> Column:
        stop = F.greatest(done["at"], F.array_max(F.transform(chunk, lambda x: x["end"])))

        def one(sub: Column) -> Column:
            def put(d: Column, x: Column) -> Column:
                between = F.substr(sub, d["at"] - done["at"] + 1, F.greatest(x["start"] - d["at"], F.lit(0)))
                return F.struct(F.when(x["start"] < d["at"], d["text"]).otherwise(F.concat(d["text"], between, x["by"])).alias("text"),
                                F.greatest(d["at"], x["end"]).alias("at"))

            return F.aggregate(chunk, F.struct(F.lit("").alias("text"), done["at"].alias("at")), put)["text"]

        return F.struct(F.concat(done["parts"], F.array(_let(F.substr(text, done["at"] + 1, stop - done["at"]), one))).alias("parts"),
                        stop.alias("at"))

    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at"))
    done = _let(spans, lambda s: F.aggregate(_chunks(s), start, step))
    whole = _let(done, lambda d: F.concat(F.array_join(d["parts"], ""), F.substr(
        text, d["at"] + 1, F.greatest(F.length(text) - d["at"], F.lit(0)))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def _by(spans: Column, by) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), by(s).alias("by")))


def _kind(span: Column) -> Column:
    """What stands for a base span in a sanitised text."""
    return F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))


def _masked(text: Column, spans: Column) -> Column:
    """The text with its base spans blanked out."""
    return _replaced(text, _by(spans, lambda s: F.lit(" ")))


def _terms(text: Column) -> Column:
    """The distinct words of a text that may be terms."""
    return F.array_distinct(F.filter(F.split(F.lower(text), rf"[^{_IN_WORD}]+"),
                                     lambda w: (F.length(w) >= 3) & ~F.rlike(w, F.lit("^[0-9]+$"))))


def find_base(docs: DataFrame) -> DataFrame:
    """(rid, tid, doc_id, spans, entities, words, clean_sha256): base spans of
    every row, and for rows that have some the distinct entities and the
    distinct words outside the spans; the digest of the text without its base
    spans. ``rid`` tells rows apart, ``tid`` texts."""
    text = text_or_empty("text")
    rows = docs.select(F.xxhash64("doc_id", "text").alias("rid"), F.xxhash64(text).alias("tid"), "doc_id",
                       text.alias("text"), base_spans(text).alias("spans"))
    entities = F.array_distinct(F.transform("spans", lambda s: _entity(s["kind"], s["value"])))
    words = F.when(F.size("spans") > 0, _terms(_masked(F.col("text"), F.col("spans"))))
    return rows.select("rid", "tid", "doc_id", F.transform("spans", lambda s: s.dropFields("value")).alias("spans"),
                       entities.alias("entities"), words.alias("words"),
                       F.sha2(_replaced(F.col("text"), _by(F.col("spans"), _kind)), 256).alias("clean_sha256"))


def _texts_by(rows: DataFrame, *keys: str, name: str) -> DataFrame:
    """Distinct texts per key. Each of a text's ``copies`` equal rows gives a
    row, so rows of texts with m copies are counted by m and divided by m."""
    return rows.groupBy(*keys, "copies").agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(
        F.sum(F.expr("n div copies")).alias(name))


def revealing_terms(found: DataFrame, docs: DataFrame, generalise: float = GENERALISE,
                    min_support: int = MIN_SUPPORT) -> DataFrame:
    """(entity, term, disclosure) of terms that reveal an entity."""
    texts = stored(found.groupBy("tid").agg(F.count(F.lit(1)).alias("copies"),
                                            F.max(F.size("spans") > 0).alias("holds")), "pii-texts")
    n_texts = float(texts.count())
    odd = broadcast_if_small(texts.where("holds or copies > 1"), BROADCAST_TERMS)
    holders = stored(found.where(F.size("spans") > 0).join(odd.drop("holds"), "tid").select(
        "copies", "entities", "words"), "pii-holders")
    # a pair cannot have more texts than its entity
    entities = _texts_by(holders.select("copies", F.explode("entities").alias("entity")), "entity", name="n_c").where(
        F.col("n_c") >= min_support)
    pairs = _texts_by(holders.select("copies", "words", F.explode("entities").alias("entity"))
                      .join(broadcast_if_small(entities.select("entity"), BROADCAST_TERMS), "entity")
                      .select("copies", "entity", F.explode("words").alias("term")), "entity", "term", name="n_tc").where(
        F.col("n_tc") >= min_support)

    def share(n_t: Column) -> Column:
        pmi = F.log(F.lit(n_texts) * F.col("n_tc") / (n_t * F.col("n_c")))
        content = F.log(F.lit(n_texts) / F.col("n_c"))
        return F.when(content > 0, F.least(pmi / content, F.lit(1.0))).otherwise(0.0)

    # the texts that hold any entity bound a term's count from below, and so its share from above
    held = _texts_by(holders.select("copies", F.explode("words").alias("term")), "term", name="n_held")
    pairs = stored(pairs.join(entities, "entity").join(held, "term").where(share(F.col("n_held")) >= generalise), "pii-pairs")
    if pairs.isEmpty():
        return pairs.select("entity", "term", F.lit(0.0).alias("disclosure"))
    wanted = pairs.select("term").distinct()
    words = docs.select(F.xxhash64(text_or_empty("text")).alias("tid"), F.explode(_terms(F.col("text"))).alias("term"))
    others = (words.join(broadcast_if_small(wanted, BROADCAST_TERMS), "term").join(odd, "tid", "left")
              .where("not coalesce(holds, false)").select("term", F.coalesce("copies", F.lit(1)).alias("copies")))
    counts = _texts_by(others, "term", name="n_others")
    return (pairs.join(counts, "term", "left")
            .withColumn("disclosure", share(F.col("n_held") + F.coalesce("n_others", F.lit(0))))
            .where(F.col("disclosure") >= generalise).select("entity", "term", "disclosure"))


def _term_spans(text: Column, terms: Column) -> Column:
    """Places of the terms in a text, with what is to happen to them, in one
    walk over its words."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    gaps = F.split(text, WORD, -1)
    known, shares = F.transform(terms, lambda t: t["term"]), F.transform(terms, lambda t: t["disclosure"])
    pieces = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, word: F.struct(
        F.length(gap).alias("gap"), F.length(word).alias("size"), F.array_position(known, F.lower(word)).alias("which")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,place:int,kind:string,end:int,remove:boolean>>").alias("spans"))

    def step(done: Column, piece: Column) -> Column:
        at = done["at"] + piece["gap"]
        span = F.struct(at.alias("start"), F.lit(len(KINDS)).alias("place"), F.lit(TERM).alias("kind"),
                        (at + piece["size"]).alias("end"),
                        (F.get(shares, (piece["which"] - 1).cast("int")) >= REMOVE).alias("remove"))
        return F.struct((at + piece["size"]).alias("at"), F.when(
            piece["which"] > 0, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    return F.when(F.size(found) > 0, F.aggregate(pieces, start, step)["spans"]).otherwise(start["spans"])


def find_personal_data(docs: DataFrame, generalise: float = GENERALISE, min_support: int = MIN_SUPPORT) -> DataFrame:
    """(rid, doc_id, spans, terms, sanitised_sha256): base spans and spans of
    revealing terms (outside the base spans) of every row of ``docs`` (doc_id,
    text), and the digest of the text that ``sanitise`` gives."""
    found = stored(find_base(docs), "pii-base")
    reveal = stored(revealing_terms(found, docs, generalise, min_support), "pii-terms")
    none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int,remove:boolean>>")
    if reveal.isEmpty():
        return found.select("rid", "doc_id", "spans", none.alias("terms"), F.col("clean_sha256").alias("sanitised_sha256"))
    at_risk = (found.select("rid", F.explode("entities").alias("entity"))
               .join(reveal, "entity").groupBy("rid", "term").agg(F.max("disclosure").alias("disclosure"))
               .groupBy("rid").agg(F.collect_list(F.struct("term", "disclosure")).alias("known")))
    texts = docs.where(F.rlike("text", F.lit("[@+]|[0-9]"))).select(
        F.xxhash64("doc_id", "text").alias("rid"), "text").join(at_risk, "rid").dropDuplicates(["rid"])
    terms = texts.select("rid", "text", F.array_sort(_term_spans(F.col("text"), F.col("known"))).alias("terms"))
    outside = F.filter(F.coalesce("terms", none), lambda t: ~F.exists(
        "spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    both = found.join(terms, "rid", "left").select("rid", "doc_id", "text", "spans", outside.alias("terms"), "clean_sha256")
    return both.select("rid", "doc_id", "spans", "terms", F.when(
        F.size("terms") > 0, F.sha2(_sanitised(F.col("text"), F.col("spans"), F.col("terms")), 256))
        .otherwise(F.col("clean_sha256")).alias("sanitised_sha256"))


def _sanitised(text: Column, spans: Column, terms: Column) -> Column:
    return _replaced(text, F.array_sort(F.concat(
        _by(spans, _kind), _by(terms, lambda t: F.when(t["remove"], F.lit("")).otherwise(F.lit("[TERM]"))))))


def sanitise(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, sanitised): texts with base spans replaced by their kind, and
    terms generalised to their kind or removed. Overlapping spans are replaced
    as one, under the first one's kind."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("rid"), text_or_empty("text").alias("text")).dropDuplicates(["rid"])
    return found.join(rows, "rid").select("doc_id", _sanitised(F.col("text"), F.col("spans"), F.col("terms")).alias("sanitised"))


def op7_personal_data(spark, sf_dir) -> DataFrame:
    """Spans of personal data and of revealing terms in every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(docs)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.array_sort(F.concat("spans", F.transform("terms", lambda t: t.dropFields("remove"))))
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"),
                        _joined(every).alias("spans"), F.size("terms").cast("long").alias("n_term"), "sanitised_sha256")
