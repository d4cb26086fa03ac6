"""Declared types, identifiers, domains and references."""

import pytest
from pyspark.sql import functions as F

from rowsluice.functions.families import integer_bounds, types_fit
from rowsluice.functions.text import (
    base_type,
    base_type_of,
    case_key,
    ddl_type,
    display_type,
    enum_domain,
    known_int,
    quote_identifier,
    quoted,
    reference_table,
    sized_length,
    split_reference,
    strip_space,
)


def one(spark, *cols):
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return row[0] if len(cols) == 1 else tuple(row)


@pytest.mark.parametrize(
    "raw, base",
    [
        ("VARCHAR(255)", "varchar"), ("character varying", "varchar"), ("character", "char"),
        ("double precision", "float8"), ("timestamp without time zone", "timestamp"),
        ("timestamp with time zone", "timestamp"), (" Numeric (10,2) ", "numeric"),
        ("integer", "integer"), ("bool", "bool"), ("", ""),
    ],
)
def test_base_type(spark, raw, base):
    assert one(spark, base_type(F.lit(raw))) == base
    assert base_type_of(raw) == base


def test_strip_space_takes_all_unicode_white_space(spark):
    assert one(spark, strip_space(F.lit("　\t x y \r\n"))) == "x y"


def test_known_int(spark):
    values = [F.lit(None).cast("bigint"), F.lit(-1), F.lit(7)]
    assert one(spark, *[known_int(v) for v in values]) == (0, 0, 7)


def test_enum_domain(spark):
    texts = ["enum('a','it''s')", "SET('x','y')", "varchar(3)", "enum('a,b','c')"]
    got = one(spark, *[enum_domain(F.lit(x)) for x in texts])
    assert got == (["a", "it's"], ["x", "y"], None, ["a,b", "c"])


@pytest.mark.parametrize(
    "args, want",
    [
        (("int", 0, True, 0, 0, []), "int unsigned"),
        (("varchar", 255, False, 0, 0, []), "varchar(255)"),
        (("decimal", 0, True, 8, 2, []), "decimal(8,2)"),
        (("float", 0, False, 7, 0, []), "float(7)"),
        (("enum", 0, False, 0, 0, ["a", "it's"]), "ENUM('a','it''s')"),
        (("enum", 0, False, 0, 0, []), "enum"),
        (("mediumtext", 16777215, False, 0, 0, []), "mediumtext"),
        (("varchar", 0, True, 0, 0, []), "varchar unsigned"),
        (("", 0, False, 0, 0, []), "TEXT"),
    ],
)
def test_ddl_type(spark, args, want):
    cols = [F.lit(a) for a in args[:5]] + [F.array(*[F.lit(v) for v in args[5]]).cast("array<string>")]
    assert one(spark, ddl_type(*cols)) == want


def test_display_type(spark):
    assert one(spark, display_type(F.lit("ENUM('A')")), display_type(F.lit("SET('b')"))) == ("enum('A')", "set('b')")
    assert one(spark, display_type(F.lit("varchar(3)"))) == "varchar(3)"


def test_sized_length(spark):
    assert one(spark, *[sized_length(F.lit(x), F.lit(9)) for x in ("varchar", "CHAR(3)", "longtext")]) == (9, 9, 0)


def test_references(spark):
    refs = ["orgs.id", "a.b.c", "not-a-ref", ".id", "orgs.", ""]
    got = [one(spark, *split_reference(F.lit(r))) for r in refs]
    assert got == [("orgs", "id"), ("a", "b.c"), (None, None), (None, None), (None, None), (None, None)]
    assert [one(spark, reference_table(F.lit(r))) for r in refs] == ["orgs", "a", None, None, "orgs", None]


def test_quoting(spark):
    assert one(spark, quote_identifier(F.lit('we"ird')), quote_identifier(F.lit("a`b"), "mysql")) == ('"weird"', "`ab`")
    assert (quoted('we"ird'), quoted('a`"b', "mysql")) == ('"weird"', "`ab`")


def test_integer_bounds():
    assert integer_bounds("tinyint", True) == (0, 255)
    assert integer_bounds("int", False) == (-(2**31), 2**31 - 1)
    assert integer_bounds("mediumint", True) == (0, 16777215)
    assert integer_bounds("bigint", True) is None
    assert integer_bounds("bigint", True, strict=True) == (0, 2**64 - 1)
    assert integer_bounds("text", False) is None


@pytest.mark.parametrize(
    "source, target, fits",
    [
        ("varchar", "text", True), ("int", "bigint", True), ("bool", "boolean", True),
        ("tinyint", "boolean", True), ("tinyint", "int", True), ("datetime", "timestamp", True),
        ("uuid", "text", True), ("text", "uuid", False), ("json", "text", True), ("text", "json", False),
        ("jsonb", "json", True), ("varchar", "integer", False), ("numeric", "int", False),
        ("int2", "int2", True), ("int2", "int", False), ("enum", "varchar", True),
    ],
)
def test_types_fit(spark, source, target, fits):
    assert one(spark, types_fit(F.lit(source), F.lit(target))) is fits


def test_case_key(spark):
    def same(a, b):
        return one(spark, case_key(F.lit(a)) == case_key(F.lit(b)))

    assert same("Draft", "dRAFT") and same("ſ", "S") and same("Σ", "ς")
    assert not same("ß", "SS") and not same("a", "b")
