"""Lexicon sentiment inside the row: no join, no exchange, no Python per row.

A lexicon maps words and phrases to polarities. A text is lower-cased and cut
into tokens of a-z; from left to right, the longest phrase of the lexicon that
begins at a token is taken, and matching goes on behind it. A taken phrase
whose last ``window`` tokens before it hold a negator counts with the opposite
sign. Polarities are summed in whole units of the lexicon's finest polarity,
so the label is that of the exact sum: > 0 Positive, = 0 Neutral, < 0
Negative. A null text or one without a phrase of the lexicon is Neutral.

Everything is one expression per text over a constant: the lexicon is an array
of maps (first word -> phrases, longest first), found by the word's hash, so a
lookup costs the same for ten words and for ``MAX_PHRASES``. Only tokens that
begin a phrase are looked at. The same expression is the body of the SQL
function, so both agree on every text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKEN_SPLIT = "[^a-z]+"
MAX_PHRASES = 50_000
WORDS_PER_MAP = 8


class Lexicon:
    """Phrases fold to lower case; one phrase with two polarities, a phrase no
    tokens can equal, or too many phrases raise a ValueError.

    ``negators`` are single words; ``window`` is how many tokens before a
    phrase are searched for one (0: no negation)."""

    def __init__(self, spark: SparkSession, phrases: Mapping[str, float | Decimal],
                 negators: Iterable[str] = (), window: int = 3):
        exact: dict[str, Decimal] = {}
        for phrase, polarity in phrases.items():
            folded, value = phrase.lower(), Decimal(str(polarity))
            if not re.fullmatch("[a-z]+( [a-z]+)*", folded):
                raise ValueError(f"no tokens can equal the lexicon phrase {phrase!r}")
            if exact.setdefault(folded, value) != value:
                raise ValueError(f"two polarities for the lexicon phrase {folded!r}")
        if len(exact) > MAX_PHRASES:
            raise ValueError(f"a lexicon holds at most {MAX_PHRASES} phrases")
        self.negators = sorted({n.lower() for n in negators})
        if any(not re.fullmatch("[a-z]+", n) for n in self.negators):
            raise ValueError("a negator is one word of a-z")
        self.window = window if self.negators else 0
        self.scale = max([0, *(-v.normalize().as_tuple().exponent for v in exact.values())])
        self.units = {w: int(v.scaleb(self.scale)) for w, v in sorted(exact.items())}
        self.buckets = self._buckets(spark)

    def _buckets(self, spark: SparkSession) -> str:
        """The array of maps as JSON. Spark hashes the first words, so the
        texts' words, hashed by Spark too, find their map."""
        by_first: dict[str, list] = {}
        for phrase, units in self.units.items():
            by_first.setdefault(phrase.split()[0], []).append({"w": phrase.split(), "u": units})
        for own in by_first.values():
            own.sort(key=lambda p: (-len(p["w"]), p["w"]))
        self.n_maps = max(1, len(by_first) // WORDS_PER_MAP)
        maps: list[dict] = [{} for _ in range(self.n_maps)]
        firsts = sorted(by_first)
        self.firsts = firsts
        places = spark.createDataFrame([(w,) for w in firsts], "w string").selectExpr(
            "w", f"cast(pmod(xxhash64(w), {self.n_maps}) as int) p").collect() if firsts else []
        for w, p in places:
            maps[p][w] = by_first[w]
        return json.dumps(maps)

    def scored(self, text: str) -> str:
        """SQL over ``text`` (an expression): struct(total units, phrases)."""
        listed = lambda words: ", ".join(f"'{w}'" for w in words) or "null"
        table = f"from_json('{self.buckets}', 'array<map<string, array<struct<w: array<string>, u: bigint>>>>')"
        negated = (f"exists(slice(x.t, greatest(1, i - {self.window}), least({self.window}, i - 1)), n -> n in ({listed(self.negators)}))"
                   if self.window else "false")
        # per token that begins a phrase: the longest phrase there, if any
        found = f"""transform(
            filter(sequence(1, size(x.t)), i -> element_at(x.t, i) in ({listed(self.firsts)})),
            i -> struct(i as at, {negated} as no, get(filter(
                element_at(get({table}, cast(pmod(xxhash64(element_at(x.t, i)), {self.n_maps}) as int)), element_at(x.t, i)),
                p -> slice(x.t, i, size(p.w)) = p.w), 0) as p))"""
        tokens = f"filter(split(lower(coalesce({text}, '')), '{TOKEN_SPLIT}'), t -> t <> '')"
        per_text = f"""aggregate({found}, struct(1 as next, 0L as units, 0L as n),
            (s, f) -> if(f.p is null or f.at < s.next, s,
                         struct(f.at + size(f.p.w) as next, s.units + if(f.no, -f.p.u, f.p.u) as units, s.n + 1L as n)))"""
        return f"element_at(transform(array(struct({tokens} as t)), x -> if(size(x.t) = 0, struct(1 as next, 0L as units, 0L as n), {per_text})), 1)"


def label(total) -> Column:
    return (F.when(total > 0, "Positive")
             .when(total < 0, "Negative")
             .otherwise("Neutral"))


def sentiment(df: DataFrame, id_cols: Sequence[str], text_col: str, lexicon: Lexicon) -> DataFrame:
    """(id_cols..., polarity, sentiment), a row per input row: ``polarity`` is
    the mean over the taken phrases to six places, the label comes from the
    exact sum."""
    scored = df.select(*id_cols, F.expr(lexicon.scored(f"`{text_col}`")).alias("__s"))
    mean = F.col("__s.units").cast("decimal(38,0)") / F.nullif("__s.n", F.lit(0)) / F.lit(10 ** lexicon.scale)
    return scored.select(*id_cols, F.coalesce(mean.cast("decimal(10,6)"), F.lit(Decimal(0)).cast("decimal(10,6)"))
                         .alias("polarity"), label(F.col("__s.units")).alias("sentiment"))


def analyze_sentiment_udf(spark: SparkSession, words: Mapping[str, float], name: str = "analyze_sentiment",
                          negators: Iterable[str] = (), window: int = 3) -> None:
    """SQL-callable scalar (``select analyze_sentiment('i love it')``), made of
    built-in functions; agrees with ``sentiment`` on every text."""
    lexicon = Lexicon(spark, words, negators, window)
    spark.sql(f"""create or replace temporary function {name}(t string) returns string return
        case sign({lexicon.scored('t')}.units) when 1 then 'Positive' when -1 then 'Negative' else 'Neutral' end""")
