"""Readings of JSON values held as VARIANT: inference, unwrapping, typed writes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsluice.functions.cells import integer_in_text, number_in_text, variant_kind
from rowsluice.functions.text import base_type_of, strip_space


def inferred_type(value: Column, exact: bool = False) -> Column:
    """Declared type inferred from a JSON value.

    ``exact`` tells integers from other numbers, which loading needs; without
    it every number is ``numeric``.
    """
    kind = variant_kind(value)
    inferred = F.when(kind == "BOOLEAN", "boolean")
    if exact:
        inferred = inferred.when(kind == "BIGINT", "bigint")
    return (
        inferred.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "numeric")
        .when(kind.isin("OBJECT", "ARRAY"), "json")
        .otherwise("text")
    )


def unwrapped_date(value: Column) -> Column:
    """The string of ``{"date": "..."}``, alone or beside ``timezone_type``; else NULL."""
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    date = F.try_variant_get(value, "$.date", "variant")
    wrapped = (variant_kind(date) == "STRING") & (
        (F.size(fields) == 1) | F.map_contains_key(fields, "timezone_type")
    )
    return F.when(wrapped, F.try_variant_get(value, "$.date", "string"))


def writable_text(value: Column) -> Column:
    """A value as it is written to a text column.

    Date objects unwrap to their string, other objects and arrays become JSON
    text with sorted keys, scalars keep their value, null stays null.
    """
    kind = variant_kind(value)
    return (
        F.when(kind == "OBJECT", F.coalesce(unwrapped_date(value), F.to_json(value)))
        .when(kind == "ARRAY", F.to_json(value))
        .otherwise(F.try_variant_get(value, "$", "string"))
    )


def spark_type(
    declared: str, unsigned: bool = False, precision: int = 0, scale: int = 0
) -> T.DataType:
    """The Spark type a declared column type is held in."""
    base = base_type_of(declared)
    if base in ("bool", "boolean"):
        return T.BooleanType()
    if base in ("bigint", "int8", "bigserial"):
        return T.DecimalType(20, 0) if unsigned else T.LongType()
    if base in ("int", "integer", "int4", "serial"):
        return T.LongType() if unsigned else T.IntegerType()
    if base in ("tinyint", "int2", "smallint", "mediumint"):
        return T.IntegerType()
    if base in ("float4", "real"):
        return T.FloatType()
    if base in ("float", "float8", "double"):
        return T.DoubleType()
    if base in ("decimal", "numeric"):
        return T.DecimalType(precision, scale) if 0 < precision <= 38 else T.DecimalType(38, 18)
    if base == "date":
        return T.DateType()
    if base in ("timestamp", "datetime"):
        return T.TimestampNTZType()
    if base == "timestamptz":
        return T.TimestampType()
    return T.StringType()


def converted(value: Column, kind: Column, text: Column, target: T.DataType) -> Column:
    """A JSON value, given its kind and written text, in its target's type."""
    number_kind = kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    if isinstance(target, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        real = F.try_variant_get(value, "$", "double")
        return (
            F.when(kind == "BIGINT", F.try_variant_get(value, "$", target.simpleString()))
            .when(number_kind, F.when(real % 1 == 0, F.try_variant_get(value, "$", target.simpleString())))
            .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "int").cast(target))
            .otherwise(integer_in_text(text).try_cast(target))
        )
    if isinstance(target, (T.FloatType, T.DoubleType, T.DecimalType)):
        spelled = F.when(number_in_text(text).isNotNull(), strip_space(text))
        return F.when(number_kind, F.try_variant_get(value, "$", target.simpleString())).otherwise(
            spelled.try_cast(target)
        )
    return text.try_cast(target)


def writable_as(value: Column, target: T.DataType) -> Column:
    """A JSON value converted to the Spark type of its target column."""
    return converted(value, variant_kind(value), writable_text(value), target)
