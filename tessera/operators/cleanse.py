"""Cleansing: null tokens, derived money columns, dedupe, gap filling."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, LongType, ShortType, StringType

from ..functions.numeric import units_to_money
from ..functions.strings import split_trimmed
from .topk import top_k_per_group


def replace_null_tokens(df: DataFrame, tokens: Sequence[str],
                        cols: Sequence[str] | None = None) -> DataFrame:
    """Turn any of several placeholder strings into SQL NULL, on every string
    column (or ``cols``). One projection, no extra pass."""
    tokens = list(tokens)
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[
        F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c)
        if c in targets else F.col(f"`{c}`")
        for c in df.columns])


def _scale(df: DataFrame, name: str, integer_scale: int) -> int:
    """Decimal places of an exact column; binary fractions are refused."""
    kind = df.schema[name].dataType
    if isinstance(kind, DecimalType):
        return kind.scale
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return integer_scale
    raise TypeError(f"{name} is {kind.simpleString()}: cast it to an exact decimal first")


def _units(df: DataFrame, name: str, scale: int, integer_scale: int) -> Column:
    """The column as long units of 10**-scale; nothing is cut off."""
    col, own = F.col(name), _scale(df, name, integer_scale)
    if isinstance(df.schema[name].dataType, DecimalType):
        col = col * F.lit(Decimal(10) ** own)
    return col.cast("long") * F.lit(10 ** (scale - own))


def profit_scales(df: DataFrame, list_price: str = "list_price", discount_percent: str = "discount_percent",
                  cost_price: str = "cost_price", price_scale: int = 0) -> tuple[int, int]:
    """(decimal places of the prices, of the percent)."""
    prices = [c for c in (list_price, cost_price) if c in df.columns]
    return max(_scale(df, c, price_scale) for c in prices), _scale(df, discount_percent, 0)


def profit_units(df: DataFrame, list_price: str = "list_price",
                 discount_percent: str = "discount_percent",
                 cost_price: str = "cost_price", price_scale: int = 0) -> DataFrame:
    """Adds ``discount_u``, ``sale_u`` (and ``profit_u`` when there is a cost
    column): exact long amounts in units of 10**-(p+d+2), p and d being the
    decimal places of prices and percent.

    discount = list x pct x 0.01, sale = list - discount, profit = sale -
    cost, all in long arithmetic -- no per-row decimal multiply, which Spark
    evaluates through BigDecimal. Integer prices count 10**-price_scale;
    decimals have their own scale; floats raise a TypeError.
    """
    p, d = profit_scales(df, list_price, discount_percent, cost_price, price_scale)
    price, whole = _units(df, list_price, p, price_scale), F.lit(10 ** (d + 2))
    out = (df.withColumn("discount_u", price * _units(df, discount_percent, d, 0))
             .withColumn("sale_u", price * whole - F.col("discount_u")))
    if cost_price in df.columns:
        out = out.withColumn("profit_u", F.col("sale_u") - _units(df, cost_price, p, price_scale) * whole)
    return out


def derive_profit(df: DataFrame, list_price: str = "list_price",
                  discount_percent: str = "discount_percent",
                  cost_price: str = "cost_price", drop_inputs: bool = True,
                  price_scale: int = 0) -> DataFrame:
    """discount = list x pct x 0.01; sale = list - discount; profit = sale - cost,
    exact: ``MONEY``, or ``decimal(38, s)`` where that has too few places.

    Prices and percent are decimals or integers (integer prices in units of
    10**-price_scale: whole currency units when 0, cents when 2).
    """
    scale = sum(profit_scales(df, list_price, discount_percent, cost_price, price_scale)) + 2
    units = profit_units(df, list_price, discount_percent, cost_price, price_scale)
    out = (units.withColumn("discount", units_to_money(F.col("discount_u"), scale))
                .withColumn("sale_price", units_to_money(F.col("sale_u"), scale)))
    if cost_price in df.columns:
        out = out.withColumn("profit", units_to_money(F.col("profit_u"), scale))
    out = out.drop("discount_u", "sale_u", "profit_u")
    if drop_inputs:
        out = out.drop(*[c for c in (list_price, cost_price, discount_percent) if c in df.columns])
    return out


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (row_number = 1)."""
    return top_k_per_group(df, keys, order, k=1, keep_rank=False)


def fill_from(col: str, fallback: str) -> Column:
    """``case when col is null then fallback else col end``."""
    return F.coalesce(F.col(col), F.col(fallback))


def fill_by_learned_pairs(raw: DataFrame, id_col: str, key_col: str, value_col: str,
                          wanted: DataFrame | None = None, each_key: bool = False) -> DataFrame:
    """Rows (id, value) for the rows of ``wanted`` (default: all of ``raw``)
    lacking ``value_col``, learned from the (key, value) items that stand
    together in a row of ``raw``.

    Keys and values are lists; their items are paired within the row. The
    pairs are made distinct before the join, so a key seen on many rows
    contributes each value once. The raw key is matched unsplit against split
    keys, so only single-key rows can be filled; with ``each_key`` a row's
    keys are split too, and it gets each value learned for any of them once.
    """
    items = lambda c: F.explode(F.array_distinct(split_trimmed(c)))
    pairs = (raw.select(items(key_col).alias("_k"), value_col)
                .select("_k", items(value_col).alias("_v")).distinct())
    source = raw if wanted is None else wanted
    missing = source.filter(F.col(value_col).isNull()).select(id_col, key_col)
    if each_key:
        own = missing.select(id_col, items(key_col).alias("_k"))
        return own.join(pairs, "_k").select(id_col, F.col("_v").alias(value_col)).distinct()
    return (missing.join(pairs, missing[key_col] == pairs["_k"])
                   .select(F.col(id_col), F.col("_v").alias(value_col)))
