"""Semi-structured records: JSON text -> VARIANT -> typed columns.

The fields may be named by hand (``project``) or found in the records
(``inferred_schema``, ``project_inferred``): Spark's ``schema_of_variant_agg``
merges the records' schemas in one aggregate, later loads widen what is known
so far, and fields that a schema does not name are kept beside the columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_variant(col: Column | str, strict: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.parse_json(c) if strict else F.try_parse_json(c)


def project(df: DataFrame, variant_col: str, fields: Mapping[str, tuple[str, str]],
            keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """``v:field::type`` for every (name -> (json path, type)) in ``fields``.

    ``try_variant_get`` gives null for a missing or mistyped field instead of
    failing the job on one dirty record.
    """
    get = F.variant_get if strict else F.try_variant_get
    return df.select(*keep, *[get(F.col(variant_col), path, typ).alias(name)
                             for name, (path, typ) in fields.items()])


def is_valid_json(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(c).isNotNull() | c.isNull()


def inferred_schema(df: DataFrame, variant_col: str) -> T.StructType:
    """The fields of the records in ``variant_col`` with a type that holds all
    their values: integers with decimals become decimals or doubles, text with
    numbers becomes text, anything else that differs stays VARIANT. Fields
    that are null everywhere are text. Records that are no objects add none.
    """
    said = df.where(F.schema_of_variant(variant_col).startswith("OBJECT")).agg(
        F.schema_of_variant_agg(variant_col)).first()[0]
    if not said or not said.startswith("OBJECT"):
        return T.StructType()
    found = T.StructType.fromDDL(f"c {said.replace('OBJECT<', 'STRUCT<')}").fields[0].dataType
    if any(isinstance(f.dataType, T.VariantType) for f in found):  # of these, plain values of several types are text
        mixed = [f.name for f in found if isinstance(f.dataType, T.VariantType)]
        plain = df.agg(*[F.coalesce(F.bool_and(~F.schema_of_variant(_field(variant_col, m, "variant")).rlike("^(OBJECT|ARRAY)")),
                                    F.lit(True)).alias(f"m{i}") for i, m in enumerate(mixed)]).first()
        text = {m for i, m in enumerate(mixed) if plain[i]}
        found = T.StructType([T.StructField(f.name, T.StringType()) if f.name in text else f for f in found])
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType)
                         for f in found])


def _widened_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widened_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_widened_type(a.elementType, b.elementType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        whole = lambda t: t.precision - t.scale if isinstance(t, T.DecimalType) else 19
        scale = max(getattr(a, "scale", 0), getattr(b, "scale", 0))
        if isinstance(a, T.FractionalType) and not isinstance(a, T.DecimalType) \
                or isinstance(b, T.FractionalType) and not isinstance(b, T.DecimalType) or max(whole(a), whole(b)) + scale > 38:
            return T.DoubleType()
        if scale or isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
            return T.DecimalType(max(whole(a), whole(b)) + scale, scale)
        return T.LongType()
    nested = (T.StructType, T.ArrayType, T.VariantType)
    return T.VariantType() if isinstance(a, nested) or isinstance(b, nested) else T.StringType()


def widened_schema(known: T.StructType, new: T.StructType) -> T.StructType:
    """``known`` with the types and fields of ``new`` taken in: a load never
    narrows a column or drops one."""
    other = {f.name: f.dataType for f in new}
    out = [T.StructField(f.name, _widened_type(f.dataType, other.pop(f.name, f.dataType))) for f in known]
    return T.StructType(out + [T.StructField(n, t) for n, t in other.items()])


def _field(variant_col: str, name: str, kind: str) -> Column:
    quoted = name.replace("\\", "\\\\").replace('"', '\\"')
    return F.try_variant_get(F.col(variant_col), f'$["{quoted}"]', kind)


def project_inferred(df: DataFrame, variant_col: str, schema: T.StructType, keep: tuple[str, ...] = (),
                     rest: str | None = "rest") -> DataFrame:
    """The record's fields as columns of ``schema``, and in ``rest`` a map of
    the fields it does not name (null if there are none)."""
    columns = [_field(variant_col, f.name, f.dataType.simpleString()).alias(f.name) for f in schema]
    if rest:
        unknown = F.map_filter(F.try_variant_get(F.col(variant_col), "$", "map<string,variant>"),
                               lambda k, _: ~k.isin([f.name for f in schema] or [None]) if len(schema) else F.lit(True))
        columns.append(F.when(F.size(unknown) > 0, unknown).alias(rest))
    return df.select(*keep, *columns)
