"""Date parsing and as-of arithmetic."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried, in order, when a free-text date is cast to a date.
DEFAULT_DATE_FORMATS = ("yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy",
                        "MM/dd/yyyy")


def date_shape(fmt: str) -> str | None:
    """A regular expression that every text in this format matches, None for a
    format of other than years, months and days."""
    if set(re.findall("[A-Za-z']", fmt)) - set("yMd"):
        return None

    def part(run: re.Match) -> str:
        return r"[+-]?\d+" if run[1] == "y" else r"\p{L}{3,}" if len(run[0]) > 2 else r"\d+"

    return "^" + "".join(part(m) if m[1] else re.escape(m[0])
                         for m in re.finditer(r"([yMd])\1*|.", fmt)) + "$"


def parse_date(col: Column | str, formats=DEFAULT_DATE_FORMATS) -> Column:
    """First format that parses wins; unparsable text gives null, never an
    error (Spark 4 is ANSI by default). A format is tried only on text of its
    shape: a failed parse costs far more than the test."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)

    def tried(fmt: str) -> Column:
        shape = date_shape(fmt)
        parsed = F.try_to_date(c, fmt)
        return parsed if shape is None else F.when(c.rlike(shape), parsed)

    return F.coalesce(*[tried(f) for f in formats])


def as_date(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def on_day(ts_col: Column | str, day) -> Column:
    """``cast(ts as date) = day`` written as a half-open range on the raw
    timestamp so the predicate reaches the Parquet scan as a pushed filter."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    d = as_date(day)
    start = dt.datetime.combine(d, dt.time())
    return (c >= F.lit(start)) & (c < F.lit(start + dt.timedelta(days=1)))


def before_day(ts_col: Column | str, day) -> Column:
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return c < F.lit(dt.datetime.combine(as_date(day), dt.time()))


def days_before(day, n: int) -> dt.date:
    return as_date(day) - dt.timedelta(days=n)


def months_before(day, n: int) -> dt.date:
    """Calendar months back, clamped to month end (2025-03-31 -> 2025-02-28)."""
    d = as_date(day)
    m = d.month - 1 - n
    y = d.year + m // 12
    m = m % 12 + 1
    for last in (31, 30, 29, 28):
        try:
            return dt.date(y, m, min(d.day, last))
        except ValueError:
            continue
    raise ValueError(day)
