"""URL filter lists over time: dated list entries become validity intervals,
and every capture is judged by the entries active when it was fetched.

An entry is (list, rule, pattern, action, at): ``rule`` is ``block`` or
``allow``, ``action`` is ``add`` or ``remove``. A pattern is a domain
(``example.org``, which covers its subdomains) or a host with a path prefix
(``www.example.org/fr``) of any depth. The most specific (longest) active pattern decides;
of equally long ones ``allow`` wins, then the first list by name.

Only DataFrame functions are used. Intervals are cut at month boundaries and
the join key is (pattern, month), so that a host holding a third of all
captures, or a pattern with a very long history, is spread over months and
adaptive execution can split what remains; no list is broadcast by hint.

Edge cases: entries with a null list, pattern, action or time are ignored; a
``remove`` at the time of an ``add`` wins; hosts are compared in lower case and
without a last dot, and an IPv6 address in its brackets is a host of one label; an entry never removed stays active;
repeated entries count once. A capture whose URL is null or has no host, or
whose fetch time is null, matches nothing and is not blocked. Repeated
captures (same id, URL and time) give one row. Empty tables give no rows.
Other columns of either input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

DAY = "INTERVAL 1 DAY"


def host_of(url: Column) -> Column:
    """Lower-case host without credentials, port and last dot, an IPv6 address
    in its brackets; null where there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#@]*\]|[^/?#:@\[]+)", 1)
    return F.nullif(F.regexp_replace(F.lower(found), r"\.+$", ""), F.lit(""))


def listed_pattern(pattern: Column) -> Column:
    """A list's pattern as captures are matched: its host in lower case and
    without a last dot, its path as it is."""
    host = F.regexp_replace(F.lower(F.regexp_extract(pattern, r"^([^/]*)", 1)), r"\.+$", "")
    return F.concat(host, F.regexp_extract(pattern, r"^[^/]*(.*)$", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def candidate_patterns(url: Column, max_segments: int) -> Column:
    """Every pattern that would cover the URL: the host's suffixes of two
    labels or more (a host of one label: itself) and the host with its first
    path segments, up to ``max_segments`` of them."""
    host = host_of(url)
    labels = F.when(F.startswith(host, F.lit("[")), F.array(host)).otherwise(F.split(host, r"\."))
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    depth = F.least(F.size(segments), F.lit(max_segments))
    prefixes = F.when(depth > 0, F.transform(
        F.sequence(F.lit(1), depth),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")),
    )).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(suffixes, prefixes)))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, rule, pattern, valid_from, valid_to): an ``add`` holds until the
    next event of its (list, pattern); ``valid_to`` is null if there is none.

    The next event is found within a month first; only the last event of each
    month looks at the months' first events, so a pattern with a huge history
    is never sorted in one task.
    """
    key = ["list", "pattern"]
    events = (entries.where("list is not null and pattern is not null and at is not null "
                            "and action in ('add', 'remove')")
              .groupBy(*key, "at")
              # a remove at the same time wins: 'remove' > 'add'
              .agg(F.max("action").alias("action"), F.min("rule").alias("rule"))
              .withColumn("month", F.trunc("at", "month")))
    within = Window.partitionBy(*key, "month").orderBy("at")
    months = (events.groupBy(*key, "month").agg(F.min("at").alias("first"))
              .withColumn("after", F.lead("first").over(
                  Window.partitionBy(*key).orderBy("month")))
              .select(*key, "month", "after"))
    return (events.withColumn("next", F.lead("at").over(within))
            .join(months, [*key, "month"])
            .where("action = 'add'")
            .select("list", "rule", "pattern", F.col("at").alias("valid_from"),
                    F.coalesce("next", "after").alias("valid_to")))


def judge_captures(captures: DataFrame, entries: DataFrame, id_col: str = "page_id",
                   url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """One row per capture with its verdict at the time it was fetched."""
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                           F.col(time_col).alias("fetched_at"))
    # two dates: the months that any capture falls in
    lo, hi = rows.agg(F.trunc(F.min("fetched_at"), "month"),
                      F.trunc(F.max("fetched_at"), "month")).first()
    lo, hi = F.lit(lo).cast("date"), F.lit(hi).cast("date")
    entries = entries.withColumn("pattern", listed_pattern(F.col("pattern")))
    # one number: the path segments of the longest pattern, beyond which no prefix can match
    deepest = entries.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    month = lambda c: F.trunc(c, "month")
    intervals = (
        validity_intervals(entries)
        .withColumn("a", F.greatest(month("valid_from"), lo))
        .withColumn("b", F.least(F.coalesce(month("valid_to"), hi), hi))
        .where("a <= b")
        .withColumn("month", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))))
        .select("list", "rule", "pattern", "valid_from", "valid_to", "month"))
    probes = rows.withColumn("month", month("fetched_at")) \
        .withColumn("pattern", F.explode(candidate_patterns(F.col("url"), max(deepest, 0))))
    active = probes.join(intervals, ["pattern", "month"]).where(
        "valid_from <= fetched_at and (valid_to is null or fetched_at < valid_to)")
    hit = F.struct((-F.length("pattern")).alias("order"),
                   (F.col("rule") != "allow").alias("blocked"), "list", "pattern",
                   "valid_from", "valid_to")
    none = F.lit(None).cast("struct<order:int,blocked:boolean,list:string,pattern:string,"
                            "valid_from:timestamp,valid_to:timestamp>")
    key = ["page_id", "url", "fetched_at"]
    verdicts = (active.select(*key, hit.alias("hit"))
                .unionByName(rows.select(*key, none.alias("hit")))
                .groupBy(*key).agg(F.min("hit").alias("hit"), F.count("hit").alias("n_active")))
    return verdicts.select(
        "page_id", host_of(F.col("url")).alias("host"), "fetched_at",
        F.coalesce("hit.blocked", F.lit(False)).alias("blocked"), "n_active",
        F.col("hit.list").alias("list"), F.col("hit.pattern").alias("pattern"),
        F.col("hit.valid_from").alias("valid_from"), F.col("hit.valid_to").alias("valid_to"))


# Inputs of the registered query, derived from ``pages``: the tables hold
# neither fetch times nor lists. A page's fetch time spreads the ids over one
# year; lists name domains, hosts and first path segments (up to
# ``MAX_PATH_SEGMENTS``, as in the SQL) that occur.
MAX_PATH_SEGMENTS = 3
START = "2024-01-01 00:00:00"
YEAR_SECONDS = 366 * 86_400
LISTS = (("adult", "block"), ("malware", "block"), ("partner", "allow"), ("spam", "block"))


def page_captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.timestamp_seconds(
        F.unix_seconds(F.lit(START).cast("timestamp"))
        + F.pmod(F.col("page_id") * 7919, F.lit(YEAR_SECONDS))).alias("fetched_at"))


def page_list_entries(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Dated entries over every pattern that covers some page, placed by the
    md5 of list and pattern: about a quarter of them per list is added at some
    day, two thirds of those are removed again and a fifth comes back."""
    patterns = pages.select(F.explode(
        candidate_patterns(F.col("url"), MAX_PATH_SEGMENTS)).alias("pattern")).distinct()
    lists = F.array(*[F.struct(F.lit(n).alias("list"), F.lit(r).alias("rule")) for n, r in LISTS])
    hashed = patterns.select("pattern", F.inline(lists)).withColumn("h", F.conv(F.substring(
        F.md5(F.concat("list", F.lit(":"), "pattern")), 1, 6), 16, 10).cast("long")).where("h % 4 = 0")
    at = lambda days: F.lit(START).cast("timestamp") + days * F.expr(DAY)
    added, removed = F.pmod(F.col("h"), F.lit(300)), F.pmod(F.col("h"), F.lit(90)) + 30
    return hashed.select("list", "rule", "pattern", F.explode(F.filter(F.array(
        F.struct(F.lit("add").alias("action"), at(added).alias("at")),
        F.when(F.col("h") % 3 != 0, F.struct(F.lit("remove").alias("action"),
                                             at(added + removed).alias("at"))),
        F.when(F.col("h") % 5 == 0, F.struct(F.lit("add").alias("action"),
                                             at(added + removed + 20).alias("at"))),
    ), lambda e: e.isNotNull())).alias("e")).select("list", "rule", "pattern", "e.action", "e.at")


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the lists as they stood when it was fetched."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    verdicts = judge_captures(page_captures(pages), page_list_entries(spark, pages))
    for c in ("fetched_at", "valid_from", "valid_to"):
        verdicts = verdicts.withColumn(c, F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
    return verdicts


_LISTS_SQL = ", ".join(f"('{n}', '{r}')" for n, r in LISTS)
ORACLE_SQL = rf"""
WITH captured AS (
  SELECT DISTINCT page_id, url,
    TIMESTAMP '{START}' + to_seconds(((page_id * 7919) % {YEAR_SECONDS} + {YEAR_SECONDS}) % {YEAR_SECONDS}) AS fetched_at,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '') AS segments
  FROM pages),
covered AS (
  SELECT DISTINCT page_id, url, fetched_at, unnest(list_concat(
      [array_to_string(labels[i:], '.') for i in range(1, greatest(len(labels) - 1, 1) + 1)],
      [host || '/' || array_to_string(segments[1:i], '/') for i in range(1, least(len(segments), {MAX_PATH_SEGMENTS}) + 1)])) AS pattern
  FROM (SELECT *, string_split(host, '.') AS labels FROM captured WHERE host IS NOT NULL)),
drawn AS (
  SELECT l.list, l.rule, p.pattern, ('0x' || substr(md5(l.list || ':' || p.pattern), 1, 6))::BIGINT AS h
  FROM (SELECT DISTINCT pattern FROM covered) p, (VALUES {_LISTS_SQL}) l(list, rule)),
event AS (
  SELECT list, rule, pattern, 'add' AS action, h % 300 AS day FROM drawn WHERE h % 4 = 0
  UNION SELECT list, rule, pattern, 'remove', h % 300 + h % 90 + 30 FROM drawn WHERE h % 4 = 0 AND h % 3 <> 0
  UNION SELECT list, rule, pattern, 'add', h % 300 + h % 90 + 50 FROM drawn WHERE h % 4 = 0 AND h % 5 = 0),
valid AS (
  SELECT *, TIMESTAMP '{START}' + to_days(day::INT) AS valid_from,
    TIMESTAMP '{START}' + to_days((lead(day) OVER (PARTITION BY list, pattern ORDER BY day))::INT) AS valid_to
  FROM event),
hit AS (
  SELECT c.page_id, c.url, c.fetched_at, v.list, v.rule, v.pattern, v.valid_from, v.valid_to,
    row_number() OVER (PARTITION BY c.page_id, c.url, c.fetched_at
      ORDER BY length(v.pattern) DESC, v.rule, v.list) AS place,
    count(*) OVER (PARTITION BY c.page_id, c.url, c.fetched_at) AS n_active
  FROM covered c JOIN valid v ON v.pattern = c.pattern AND v.action = 'add'
    AND c.fetched_at >= v.valid_from AND (v.valid_to IS NULL OR c.fetched_at < v.valid_to))
SELECT c.page_id, c.host, strftime(c.fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, coalesce(h.rule <> 'allow', false) AS blocked,
  coalesce(h.n_active, 0) AS n_active, h.list, h.pattern,
  strftime(h.valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(h.valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to
FROM captured c LEFT JOIN hit h ON h.place = 1 AND h.page_id IS NOT DISTINCT FROM c.page_id
  AND h.url = c.url AND h.fetched_at = c.fetched_at
"""
