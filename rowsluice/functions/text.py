"""Text helpers over columns: white space, case folding, identifiers, declared types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters of the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Long spellings of a base type and the short name used for it.
TYPE_ALIASES = {
    "character varying": "varchar",
    "character": "char",
    "double precision": "float8",
    "timestamp without time zone": "timestamp",
    "timestamp with time zone": "timestamp",
}

# Base types that carry a declared length, and those with (p[,s]).
SIZED_TYPES = ("varchar", "char", "binary", "varbinary")
SCALED_TYPES = ("decimal", "numeric", "float", "double")
LISTED_TYPES = ("enum", "set")


def strip_space(text: Column) -> Column:
    """Trim every Unicode white-space character; plain trim() drops blanks only."""
    return F.trim(text, F.lit(WHITE_SPACE))


def case_key(text: Column) -> Column:
    """Equal for texts that differ by case only.

    The length is part of the key because simple case folding maps one
    character to one character, while upper() may expand one (``ß`` -> ``SS``).
    """
    return F.concat(F.char_length(text).cast("string"), F.lit(":"), F.lower(F.upper(text)))


def base_type(raw: Column) -> Column:
    """``VARCHAR(255)`` -> ``varchar``: lower case, no parameters, no aliases."""
    stem = F.substring_index(F.lower(strip_space(raw)), "(", 1)
    aliased = F.lit(None).cast("string")
    for long_name, short_name in TYPE_ALIASES.items():
        aliased = F.when(stem == long_name, short_name).otherwise(aliased)
    return F.coalesce(aliased, strip_space(stem))


def base_type_of(raw: str) -> str:
    """The same normalization for one declared type known on the driver."""
    stem = raw.strip(WHITE_SPACE).lower().partition("(")[0]
    return TYPE_ALIASES.get(stem, stem.strip(WHITE_SPACE))


def known_int(number: Column) -> Column:
    """Catalog integers: missing or negative means "unknown" and reads as 0."""
    return F.greatest(F.coalesce(number, F.lit(0)), F.lit(0)).cast("int")


def quote_identifier(name: Column, dialect: str = "postgres") -> Column:
    bare = F.replace(name, F.lit('"'), F.lit(""))
    if dialect == "mysql":
        return F.concat(F.lit("`"), F.replace(bare, F.lit("`"), F.lit("")), F.lit("`"))
    return F.concat(F.lit('"'), bare, F.lit('"'))


def quoted(name: str, dialect: str = "postgres") -> str:
    """Quote one identifier on the driver, e.g. for a TRUNCATE statement."""
    mark = "`" if dialect == "mysql" else '"'
    return mark + name.replace('"', "").replace(mark, "") + mark


def ddl_base(raw: Column) -> Column:
    """Base type name for DDL text; an unknown type becomes TEXT."""
    lowered = F.lower(strip_space(raw))
    return F.when(lowered == "", "TEXT").otherwise(
        strip_space(F.substring_index(lowered, "(", 1))
    )


def sized_length(raw: Column, length: Column) -> Column:
    """Length counts as a constraint for sized types only, not as a storage cap."""
    return F.when(ddl_base(raw).isin(*SIZED_TYPES), length).otherwise(0)


def ddl_type(
    raw: Column,
    length: Column,
    unsigned: Column,
    precision: Column,
    scale: Column,
    values: Column,
) -> Column:
    """Render a declared column type with its parameters."""
    base = ddl_base(raw)
    members = F.array_join(
        F.transform(
            values,
            lambda v: F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'")),
        ),
        ",",
    )
    return (
        F.when(
            base.isin(*LISTED_TYPES) & (F.coalesce(F.size(values), F.lit(0)) > 0),
            F.concat(F.upper(base), F.lit("("), members, F.lit(")")),
        )
        .when(
            base.isin(*SIZED_TYPES) & (length > 0),
            F.concat(base, F.lit("("), length.cast("string"), F.lit(")")),
        )
        .when(
            base.isin(*SCALED_TYPES) & (precision > 0) & (scale > 0),
            F.concat(
                base, F.lit("("), precision.cast("string"), F.lit(","), scale.cast("string"), F.lit(")")
            ),
        )
        .when(
            base.isin(*SCALED_TYPES) & (precision > 0),
            F.concat(base, F.lit("("), precision.cast("string"), F.lit(")")),
        )
        .when(unsigned, F.concat(base, F.lit(" unsigned")))
        .otherwise(base)
    )


def display_type(rendered: Column) -> Column:
    """DDL type text with the ENUM / SET word in lower case, for people."""
    return F.when(
        rendered.startswith("ENUM(") | rendered.startswith("SET("),
        F.concat(
            F.lower(F.substring_index(rendered, "(", 1)),
            F.substring(rendered, F.instr(rendered, "("), F.length(rendered)),
        ),
    ).otherwise(rendered)


def enum_domain(column_type: Column) -> Column:
    """Members of ``enum('a','it''s')`` or ``set(...)``; NULL for any other type."""
    members = F.transform(
        F.regexp_extract_all(column_type, F.lit("'((?:[^']|'')*)'"), F.lit(1)),
        lambda v: F.replace(v, F.lit("''"), F.lit("'")),
    )
    return F.when(
        F.lower(strip_space(column_type)).rlike(r"^(enum|set)\("), members
    )


def split_reference(ref: Column) -> tuple[Column, Column]:
    """``table.column`` -> (table, column), both NULL unless both sides are there."""
    dot = F.instr(ref, ".")
    table = F.substring(ref, F.lit(1), dot - 1)
    column = F.substring(ref, dot + 1, F.length(ref))
    whole = (dot > 1) & (column != "")
    return F.when(whole, table), F.when(whole, column)


def reference_table(ref: Column) -> Column:
    """Left side of ``table.column``; only the table part has to be there."""
    dot = F.instr(ref, ".")
    return F.when(dot > 1, F.substring(ref, F.lit(1), dot - 1))
