"""Row rules over typed and raw rows, uniqueness, summaries and splits."""

import json

import pytest
from pyspark.sql import functions as F

from rowsluice.operators import keys
from rowsluice.operators.spec import CheckSpec, ColumnSpec, TableSpec
from rowsluice.operators.validate import ValidationFailed, Validator
from rowsluice.sources.jsonl import rows_from_lines

SPEC = TableSpec(
    "things",
    (
        ColumnSpec("id", "bigint", is_pk=True),
        ColumnSpec("attempts", "tinyint", unsigned=True),
        ColumnSpec("count", "int", unsigned=True),
        ColumnSpec("balance", "int"),
        ColumnSpec("huge", "bigint", unsigned=True),
        ColumnSpec("email", "varchar", length=255, unique=True),
        ColumnSpec("code", "varchar", length=5),
        ColumnSpec("status", "enum", values=("draft", "published")),
        ColumnSpec("tags", "set", values=("a", "b", "c")),
        ColumnSpec("name", "varchar", nullable=False),
    ),
    (CheckSpec("price_positive", "(`balance` > -1000)"),),
)


def raw(spark, rows):
    lines = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(rows)]
    return rows_from_lines(spark.createDataFrame(lines, "i int, value string"))


def found(spark, rows, spec=SPEC, **options):
    out = Validator(spec, ("i",), "row", **options).violations(raw(spark, rows)).collect()
    return sorted((r["i"], r["column_name"], r["rule"]) for r in out)


def test_valid_rows(spark):
    rows = [
        {"id": 1, "attempts": 0, "email": "a@x", "status": "draft", "tags": "a,c", "balance": -500},
        {"ID": 2, "attempts": 255, "email": "b@x", "status": "published", "name": "n"},
    ]
    assert found(spark, rows) == []


@pytest.mark.parametrize(
    "row, column, rule",
    [
        ({"attempts": 256}, "attempts", "range"),
        ({"attempts": "256"}, "attempts", "range"),
        ({"attempts": " +9999999999999999999999999999999999999999 "}, "attempts", "range"),
        ({"count": -1}, "count", "range"),
        ({"count": 4294967296}, "count", "range"),
        ({"count": 4294967296.0}, "count", "range"),
        ({"count": 1e30}, "count", "range"),
        ({"code": "abcdef"}, "code", "length"),
        ({"status": "archived"}, "status", "enum"),
        ({"status": "Draft"}, "status", "enum"),
        ({"status": 5}, "status", "enum"),
        ({"tags": "a,z"}, "tags", "set"),
        ({"tags": ""}, "tags", "set"),
        ({"name": None}, "name", "not_null"),
        ({"nope": 1}, "", "unknown_column"),
        ({"balance": -1000}, "price_positive", "check"),
    ],
)
def test_one_violation(spark, row, column, rule):
    assert found(spark, [row]) == [(0, column, rule)]


@pytest.mark.parametrize(
    "row",
    [
        {"attempts": 255.5}, {"attempts": "5.5"}, {"attempts": True}, {"attempts": {"x": 1}},
        {"huge": "18446744073709551616"}, {"code": "é漢😀xy"}, {"code": 1234567}, {"tags": " a , b "},
        {}, {"status": None},
    ],
)
def test_no_violation(spark, row):
    assert found(spark, [row]) == []


def test_strict_checks_bigint_and_conversion(spark):
    rows = [{"huge": "18446744073709551616"}, {"huge": 5}, {"balance": "5.5"}, {"balance": 2.0}]
    got = found(spark, rows, strict=True)
    assert (0, "huge", "range") in got and (2, "balance", "type") in got
    assert not [g for g in got if g[0] in (1, 3)]


def test_uniqueness(spark):
    spec = TableSpec("t", (ColumnSpec("slug", "varchar", unique=True), ColumnSpec("n", "int")))
    rows = [{"slug": "x"}, {"slug": None}, {"slug": None}, {"slug": "y"}, {"slug": "x"}, {"slug": "x"}]
    violations = Validator(spec, ("i",), "row").violations(raw(spark, rows)).orderBy("i").collect()
    assert [(r["i"], r["rule"], r["value"]) for r in violations] == [(4, "unique", "x"), (5, "unique", "x")]
    assert "(row 0)" in violations[0]["message"]


def test_number_and_text_keys_differ_but_equal_numbers_do_not(spark):
    spec = TableSpec("t", (ColumnSpec("k", "varchar", unique=True),))
    assert found(spark, [{"k": 1}, {"k": "1"}], spec) == []
    assert found(spark, [{"k": 1}, '{"k":1.0}'], spec) == [(1, "k", "unique")]


def test_composite_primary_key_is_one_key(spark):
    spec = TableSpec("t", (ColumnSpec("a", "int", is_pk=True), ColumnSpec("b", "int", is_pk=True)))
    df = spark.createDataFrame([(0, 1, 1), (1, 1, 2), (2, 1, 2), (3, None, 2)], "i int, a int, b int")
    got = Validator(spec, ("i",)).violations(df).collect()
    assert [(r["i"], r["column_name"]) for r in got] == [(2, "a,b")]


def test_first_violation_and_abort(spark):
    rows = [{"id": 1}, {"code": "abcdef", "attempts": 300}, {"name": None}]
    validator = Validator(SPEC, ("i",), "row")
    first = validator.first_violation(raw(spark, rows)).collect()
    assert [(r["i"], r["column_name"]) for r in first] == [(1, "attempts")]
    with pytest.raises(ValidationFailed, match="256|300"):
        validator.check(raw(spark, rows))
    validator.check(raw(spark, rows[:1]))


def test_messages_name_rule_and_value(spark):
    spec = TableSpec(
        "t", (ColumnSpec("price", "decimal"), ColumnSpec("name", "varchar")),
        (CheckSpec("price_positive", "(`price` > 0)"), CheckSpec("name_len", "(char_length(`name`) > 0)")),
    )
    validator = Validator(spec, ("i",), "row")
    df = raw(spark, [{"price": 1, "name": ""}, {"price": -5, "name": "a"}])
    assert [s[0] for s in validator.checks(df)[1]] == ["name_len"]
    message = validator.violations(df).first()["message"]
    assert "price_positive" in message and "price=-5" in message


def test_summary_and_split(spark):
    df = raw(spark, [{"id": 1}, {"id": 1}, {"attempts": 300}, {"nope": 1}, {"id": 2}])
    validator = Validator(SPEC, ("i",), "row")
    counts = {(r["column_name"], r["rule"]): r["violations"] for r in validator.summary(df).collect()}
    assert counts[("id", "unique")] == 1 and counts[("attempts", "range")] == 1
    assert counts[("", "unknown_column")] == 1 and counts[("tags", "set")] == 0
    good, bad = validator.split(df)
    assert sorted(r["i"] for r in good.collect()) == [0, 4]
    assert sorted(r["i"] for r in bad.collect()) == [1, 2, 3]


def test_typed_unknown_column_and_custom_rule(spark):
    spec = TableSpec("t", (ColumnSpec("a", "int"),))
    df = spark.createDataFrame([(0, 1, "x"), (1, 7, "y")], "i int, a int, extra string")
    validator = Validator(spec, ("i",), extra_rules={"small": lambda: F.col("a") < 5})
    got = sorted((r["i"], r["column_name"], r["rule"]) for r in validator.violations(df).collect())
    assert got == [(0, "extra", "unknown_column"), (1, "extra", "unknown_column"), (1, "small", "custom")]


def test_rules_run_in_one_scan(spark, folder):
    spark.range(100).selectExpr("id as i", "cast(id as int) as attempts", "'x' as code").write.mode("overwrite").parquet(folder)
    df = spark.read.parquet(folder).select("i", "attempts", "code")
    plan = Validator(SPEC, ("i",)).summary(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("rows_per_split", [3, 10_000])
def test_join_by_key_keeps_every_row_under_skew(spark, rows_per_split):
    """A third of all rows share a key, another part has none; brute force agrees."""
    data = [(i, "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"k{i % 50}")) for i in range(900)]
    df = spark.createDataFrame(data, "i int, k string").repartition(5)
    firsts = keys.duplicate_keys(df, ["k"], ["i"])
    inner = keys.join_by_key(df, firsts, ["k"], "n", ["i"], rows_per_split=rows_per_split)
    left = keys.join_by_key(df, firsts, ["k"], "n", ["i"], "left", rows_per_split)
    groups = {}
    for i, k in data:
        groups.setdefault(k, []).append(i)
    want = {i: min(groups[k]) for i, k in data if k is not None and len(groups[k]) > 1}
    assert {r["i"]: r["first_row"] for r in inner.collect()} == want
    got = left.collect()
    assert len(got) == 900 and all(r["first_row"] == want.get(r["i"]) for r in got)


def test_two_column_keys_and_orphans(spark):
    child = spark.createDataFrame([(0, 1, 1), (1, 1, 9), (2, None, 1), (3, 1, 9), (4, 2, 2)], "i int, a int, b int")
    parent = spark.createDataFrame([(1, 1), (2, 2)], "x int, y int")
    orphans = keys.orphan_rows(child, ["a", "b"], parent, ["x", "y"], ["i"])
    assert sorted(r["i"] for r in orphans.collect()) == [1, 3]
    repeats = keys.repeated_rows(child, ["a", "b"], ["i"])
    assert [(r["i"], r["first_row"]) for r in repeats.collect()] == [(3, 1)]
