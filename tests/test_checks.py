"""CHECK constraints: dialect renderings, three-valued logic, skipping."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsluice.functions.cells import frame_cells
from rowsluice.operators.checks import (
    UnsupportedCheck,
    check_names,
    compile_check,
    compile_checks,
    normalize_check,
    normalized_check,
    parse_check,
    referenced_columns,
    skipped_checks,
)
from rowsluice.operators.spec import CheckSpec
from rowsluice.sources.jsonl import rows_from_lines

MYSQL, PG = "mysql", "postgres"
CASES = [
    (MYSQL, "(`weight` >= 3)", {"weight": 3}, {"weight": 2}),
    (MYSQL, "(`colour` in (_utf8mb4'teal',_utf8mb4'plum'))", {"colour": "plum"}, {"colour": "grey"}),
    (MYSQL, "(`floor` between -2 and 40)", {"floor": -2}, {"floor": 41}),
    (MYSQL, "(`closes` >= `opens`)", {"opens": "08:30", "closes": "08:30"}, {"opens": "18:00", "closes": "08:30"}),
    (PG, "CHECK ((weight <> (7)::numeric))", {"weight": "7.5"}, {"weight": "7.0"}),
    (
        PG,
        "CHECK (((colour)::text = ANY ((ARRAY['teal'::character varying, 'plum'::character varying])::text[])))",
        {"colour": "teal"}, {"colour": "Teal?"},
    ),
    (PG, "CHECK (((floor > 0) AND (weight < 9)))", {"floor": 1, "weight": 8}, {"floor": 1, "weight": 9}),
    (MYSQL, "(`floor` > -3)", {"floor": -2}, {"floor": -3}),
    (PG, "((opens IS NOT NULL) OR (floor = 0))", {"opens": None, "floor": 0}, {"opens": None, "floor": 6}),
    (MYSQL, "(`colour` not in ('teal','plum'))", {"colour": "rust"}, {"colour": "teal"}),
    # UNKNOWN passes
    (MYSQL, "(`price` > 0)", {"price": None}, None),
    (MYSQL, "(`price` > 0)", {"other": 1}, None),
    (MYSQL, "(`status` in ('Draft'))", {"status": "draft"}, None),
    (MYSQL, "(`code` < '9')", {"code": "10"}, {"code": "91"}),
    (PG, "(flag = true)", {"flag": True}, {"flag": False}),
    (PG, "(flag = 1)", {"flag": True}, {"flag": False}),
    (PG, "(flag)", {"flag": True}, {"flag": False}),
    (PG, "(qty)", {"qty": 0}, None),
    (PG, "(qty OR (price > 1))", {"qty": 1, "price": 0}, {"qty": 0, "price": 0}),
    (PG, "(price > 1)", {"price": "many"}, None),
    (PG, "(price > 1)", {"price": "1e400"}, None),
    (PG, "(price > 1)", {"price": "1d"}, None),
    (PG, "(price > 1)", {"price": {"date": "x"}}, None),
    (PG, "(price NOT BETWEEN 2 AND 3)", {"price": 1}, {"price": 2.5}),
    (PG, "((NOT (price > 1)) AND (status <> 'a'))", {"price": 1, "status": "b"}, {"price": 2, "status": "b"}),
    (PG, "(price IN (1, 2, NULL))", {"price": 3}, None),
    (PG, "(price NOT IN (1, NULL))", {"price": 3}, {"price": 1}),
    (PG, "(name <> 'it''s')", {"name": "its"}, {"name": "it's"}),
    (MYSQL, r"(`name` <> 'it\'s')", {"name": "its"}, {"name": "it's"}),
    (PG, '("price" IS NOT NULL)', {"price": 0}, {"price": None}),
    (PG, "((price = NULL) OR false)", {"price": 0}, None),
    (PG, "(price >= .5e1)", {"price": 5}, {"price": 4.9}),
    (PG, "(starts_at >= '2024-01-01'::timestamp without time zone)", {"starts_at": "2024-02-01"}, {"starts_at": "2023-02-01"}),
]
COLUMNS = [
    "price", "status", "qty", "ends_at", "starts_at", "rating", "balance", "discount", "kind",
    "code", "flag", "name", "other", "weight", "colour", "floor", "closes", "opens",
]


def raw_verdicts(spark, dialect, expr, rows):
    lines = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, value string")
    df = rows_from_lines(lines)
    check = compile_check("c", normalize_check(expr), frame_cells(df, "row", COLUMNS), dialect)
    out = df.select("i", F.coalesce(check.fails, F.lit(False)).alias("fails")).collect()
    return [r["fails"] for r in sorted(out)]


@pytest.mark.parametrize("dialect, expr, good, bad", CASES)
def test_raw_rows(spark, dialect, expr, good, bad):
    rows = [good] + ([bad] if bad is not None else [])
    assert raw_verdicts(spark, dialect, expr, rows) == [False, True][: len(rows)]


def spark_type(value):
    return {bool: T.BooleanType(), int: T.LongType(), float: T.DoubleType(), str: T.StringType()}[type(value)]


@pytest.mark.parametrize("dialect, expr, good, bad", CASES)
def test_typed_rows(spark, dialect, expr, good, bad):
    if isinstance(good.get("price"), dict):
        pytest.skip("typed columns hold no objects")
    names = sorted({*good, *(bad or {})} | {"price"})
    sample = {n: next((r[n] for r in (bad or {}, good) if r.get(n) is not None), 1) for n in names}
    if any(isinstance(r.get(n), float) for r in (good, bad or {}) for n in names):
        sample["price"] = 1.0
    schema = T.StructType([T.StructField(n, spark_type(sample[n])) for n in names])
    rows = [good] + ([bad] if bad is not None else [])
    data = [
        tuple(float(r[n]) if isinstance(sample[n], float) and r.get(n) is not None else r.get(n) for n in names)
        for r in rows
    ]
    df = spark.createDataFrame(data, schema).coalesce(1)
    check = compile_check("c", normalize_check(expr), frame_cells(df), dialect)
    got = [r[0] for r in df.select(F.coalesce(check.fails, F.lit(False))).collect()]
    assert got == [False, True][: len(rows)]


@pytest.mark.parametrize(
    "expr",
    [
        "(char_length(`name`) > 0)", "(`total` = (`price` * `qty`))", "(`email` like '%@%')",
        "(email ~ 'x')", "(a = b = c)", "(x > -y)", "(x IS TRUE)", "(x = ANY ('{a,b}'::text[]))",
        "(x > ANY (ARRAY[1]))", "(x > 1", "('open)", "(x > 1.2.3)", "(x > 1e999)", "(NOT)", "(x BETWEEN 1 OR 2)",
        "(price > 0) price",
    ],
)
def test_unsupported(expr):
    with pytest.raises(UnsupportedCheck):
        parse_check(expr)


def test_unknown_names_and_skips(spark):
    df = spark.createDataFrame([(1.0, "a")], "price double, name string")
    compiled, skipped = compile_checks(
        [
            CheckSpec("ok", "CHECK ((price > 0)) NOT VALID"),
            CheckSpec("name_len", "(char_length(name) > 0)"),
            CheckSpec("today", "(price <= CURRENT_DATE)"),
            CheckSpec("empty", "CHECK"),
        ],
        frame_cells(df),
    )
    assert [c.name for c in compiled] == ["ok"] and compiled[0].columns == ("price",)
    assert [s[0] for s in skipped] == ["name_len", "today"]


def test_typed_times(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 00:00:00' as a, date'2024-01-01' as b, 5 as n")
    cells = frame_cells(df)
    verdicts = [
        compile_check("c", e, cells).holds
        for e in ("(a > b)", "(a < '2024-01-01')", "(b = '2024-01-01')", "(a > 'soon')", "(a > n)")
    ]
    assert list(df.select(*verdicts).first()) == [True, False, True, None, None]


def test_numeric_check_reaches_the_scan(spark, folder):
    spark.range(10).selectExpr("id", "cast(id as double) as price").write.mode("overwrite").parquet(folder)
    df = spark.read.parquet(folder)
    plan = df.filter(compile_check("c", "(price > 3)", frame_cells(df)).fails)._jdf.queryExecution().toString()
    assert "LessThanOrEqual(price,3.0)" in plan


def test_normalize_and_columns(spark):
    assert normalize_check("CHECK ((qty > 0)) NOT VALID") == "((qty > 0))"
    row = spark.range(1).select(
        normalized_check(F.lit(" check ((qty > 0)) not valid ")),
        F.sort_array(check_names(F.lit("(`Ends_At` > \"b\"\"c\" AND x = _utf8'it''s y' AND z > 1e5)"))),
        check_names(F.lit("(a ~ 'x')")),
    ).first()
    assert row[0] == "((qty > 0))"
    assert row[1] == ["and", 'b"c', "ends_at", "x", "z"] and row[2] == []
    assert referenced_columns("(`ends_at` > `starts_at`)", ["id", "starts_at", "ends_at"]) == ["starts_at", "ends_at"]
    assert referenced_columns("(a ~ 'x')", ["a"]) == []


def test_skipped_catalog(spark):
    rows = [("db", f"t{i}", "k", e, []) for i, e in enumerate(["(a > 1)", "(f(a) > 1)", "(f(a) > 1)"])]
    checks = spark.createDataFrame(rows, "database string, table_name string, name string, expr string, cols array<string>")
    got = sorted((r["table_name"], r["reason"]) for r in skipped_checks(checks).collect())
    assert [g[0] for g in got] == ["t1", "t2"] and "Call" in got[0][1]
