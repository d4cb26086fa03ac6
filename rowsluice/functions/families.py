"""Declared types: integer bounds and which types may stand for one another."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bit width of every declared integer type.
INTEGER_BITS = {
    "tinyint": 8,
    "int2": 16,
    "smallint": 16,
    "mediumint": 24,
    "int": 32,
    "integer": 32,
    "int4": 32,
    "serial": 32,
    "bigint": 64,
    "int8": 64,
    "bigserial": 64,
}

# Types that are interchangeable inside a family.
FAMILIES = {
    "integer": (
        "int", "integer", "int4", "int8", "bigint", "smallint", "serial", "bigserial",
        "tinyint", "mediumint",
    ),
    "number": ("float", "float4", "float8", "double", "real", "decimal", "numeric"),
    "text": (
        "varchar", "char", "text", "mediumtext", "longtext", "tinytext", "citext", "enum", "set",
    ),
    "time": ("timestamp", "timestamptz", "datetime", "date", "time"),
    "boolean": ("bool", "boolean", "tinyint"),
}

# A source type and the target types that accept it, one direction only.
ACCEPTED_BY = {
    "json": ("json", "jsonb", "text"),
    "jsonb": ("json", "jsonb", "text"),
    "uuid": ("uuid", "varchar", "text", "char"),
}

# Integers up to here survive a trip through a JSON number held as a double.
EXACT_DOUBLE_BITS = 53


def integer_bounds(base: str, unsigned: bool, strict: bool = False) -> tuple[int, int] | None:
    """Inclusive bounds of a declared integer type, or None when not to be checked.

    64-bit types are only checked in ``strict`` mode: rows that went through
    JSON doubles may legitimately have been rounded past their bound.
    """
    bits = INTEGER_BITS.get(base)
    if bits is None or (bits > EXACT_DOUBLE_BITS and not strict):
        return None
    return (0, 2**bits - 1) if unsigned else (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)


def types_fit(source: Column, target: Column) -> Column:
    """Does a value of declared type ``source`` fit ``target`` (both normalized)?

    The matrix is fixed and small, so it is a literal expression inside the
    calling stage rather than a table to join with.
    """
    fits = source == target
    for members in FAMILIES.values():
        fits = fits | (source.isin(*members) & target.isin(*members))
    for accepted, targets in ACCEPTED_BY.items():
        fits = fits | ((source == F.lit(accepted)) & target.isin(*targets))
    return fits
