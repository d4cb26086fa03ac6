"""Catalog sources, matching, ordering and descriptions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from rowsluice.operators import describe, match
from rowsluice.operators.order import CircularReferences, load_order, load_passes, ordered_names, stuck_tables
from rowsluice.operators.progress import load_tally, progress_percent, progress_totals
from rowsluice.operators.spec import CheckSpec, ColumnSpec, TableSpec, checks_frame, columns_frame
from rowsluice.sources import catalog, jdbc, manifest

USERS = TableSpec(
    "users",
    (
        ColumnSpec("id", "integer", nullable=False, is_pk=True),
        ColumnSpec("email", "varchar", nullable=False, unique=True),
        ColumnSpec("nickname", "varchar"),
        ColumnSpec("org_id", "integer", fk_ref="orgs.id"),
    ),
    (CheckSpec("mail", "(email <> '')"), CheckSpec("none", "(1 > 0)")),
)
ORGS = TableSpec("orgs", (ColumnSpec("id", "integer", nullable=False, is_pk=True),))
GOODS = TableSpec(
    "goods",
    (
        ColumnSpec("id", "int", nullable=False, is_pk=True, unsigned=True),
        ColumnSpec("email", "varchar", nullable=False, unique=True, length=255),
        ColumnSpec("price", "decimal", precision=8, scale=2),
        ColumnSpec("status", "enum", values=("a", "b")),
        ColumnSpec("body", "mediumtext", length=16777215),
        ColumnSpec("payload", "longtext", length=2147483647),
        ColumnSpec("broken", "int", fk_ref="not-a-ref"),
    ),
)


def selection(spark, *names):
    return spark.createDataFrame([("", n) for n in names], "database string, table_name string")


def parsed(spark, specs, *names):
    out = describe.parsed_tables(columns_frame(spark, specs), checks_frame(spark, specs), selection(spark, *names))
    return {r["table_name"]: r for r in out.collect()}


def test_parsed_users(spark):
    users = parsed(spark, [USERS, ORGS], "users", "orgs")["users"]
    assert [(i["type"], i["cols"]) for i in users["indexes"]] == [
        ("PRIMARY", ["id"]), ("UNIQUE", ["email"]), ("FOREIGN", ["org_id"]), ("CHECK", ["email"]),
    ]
    assert users["indexes"][2]["ref_table"] == "orgs" and users["indexes"][2]["ref_cols"] == ["id"]
    assert users["sql"] == (
        'CREATE TABLE "users" (\n  "id" integer NOT NULL,\n  "email" varchar NOT NULL,\n'
        '  "nickname" varchar NULL,\n  "org_id" integer NULL,\n  PRIMARY KEY ("id"),\n  UNIQUE ("email"),\n'
        '  FOREIGN KEY ("org_id") REFERENCES "orgs" ("id"),\n  CHECK ((email <> \'\'))\n);\n'
    )


def test_parsed_prunes_references_outside_the_selection(spark):
    tables = parsed(spark, [USERS, ORGS], "users")
    assert list(tables) == ["users"]
    assert [i["type"] for i in tables["users"]["indexes"]] == ["PRIMARY", "UNIQUE", "CHECK"]


def test_parsed_constraints_and_lengths(spark):
    goods = parsed(spark, [GOODS], "goods")["goods"]
    assert [f["length"] for f in goods["fields"]] == [0, 255, 0, 0, 0, 0, 0]
    assert [i["type"] for i in goods["indexes"]] == ["PRIMARY", "UNIQUE"]
    for text in ('"id" int unsigned NOT NULL', '"email" varchar(255)', '"price" decimal(8,2)', "ENUM('a','b')", '"body" mediumtext NULL'):
        assert text in goods["sql"]


def test_composite_key_is_one_index(spark):
    spec = TableSpec("m", (ColumnSpec("a", "int", is_pk=True), ColumnSpec("b", "int", is_pk=True, unique=True)))
    assert [(i["type"], i["cols"]) for i in parsed(spark, [spec], "m")["m"]["indexes"]] == [("PRIMARY", ["a", "b"])]


def test_long_checks_are_left_out_on_request_only(spark):
    long = f"(a <> {'9' * 3000})"
    spec = TableSpec("m", (ColumnSpec("a", "int"),), (CheckSpec("big", long),))
    assert [i["expr"] for i in parsed(spark, [spec], "m")["m"]["indexes"]] == [long]
    frames = columns_frame(spark, [spec]), checks_frame(spark, [spec])
    assert describe.parsed_tables(*frames, max_check_bytes=2000).first()["indexes"] == []


def test_fingerprint(spark):
    def prints(driver, host, *names):
        return describe.fingerprints(
            selection(spark, *names).withColumn("database", F.lit("myapp")), F.lit(driver), F.lit(host), F.lit(5432)
        ).first()["fingerprint"]

    want = hashlib.sha256(b"postgres|localhost|5432|myapp|orders,users").hexdigest()
    assert prints("postgres", "localhost", "users", "orders") == want == prints("postgres", "localhost", "orders", "users")
    assert want not in (prints("mysql", "localhost", "users", "orders"), prints("postgres", "x", "users", "orders"))


def test_pull_actions(spark):
    requests = spark.createDataFrame(
        [("f1", False, False), ("f1", False, True), ("f1", True, False), ("f2", True, False)],
        "fingerprint string, force boolean, regenerate boolean",
    )
    known = spark.createDataFrame([("f1", "s1")], "fingerprint string, schema_id string")
    got = sorted((r["fingerprint"], r["action"]) for r in describe.pull_actions(requests, known).collect())
    assert got == [("f1", "recreate"), ("f1", "regenerate"), ("f1", "reuse"), ("f2", "create")]


# ---- matching -------------------------------------------------------------


def columns(spark, *rows):
    return spark.createDataFrame(
        [("", "t", i, n, d) for i, (n, d) in enumerate(rows)],
        "database string, table_name string, ordinal int, name string, type string",
    )


def test_schema_subset(spark):
    target = columns(spark, ("id", "integer"), ("email", "varchar"), ("age", "bigint"))
    ok = match.schema_subset(columns(spark, ("Email", "character varying"), ("age", "integer")), target).first()
    assert ok["ok"] and ok["problems"] == ""
    bad = match.schema_subset(columns(spark, ("nope", "text"), ("id", "varchar")), target).first()
    assert not bad["ok"] and bad["problems"] == (
        'no target column "nope"\n"id": varchar does not go into integer'
    )
    spec = TableSpec("t", (ColumnSpec("id", "integer"), ColumnSpec("email", "varchar")))
    assert match.spec_problems([("nope", "text"), ("id", "varchar"), ("EMAIL", "uuid")], spec) == bad["problems"].split("\n")


def test_fk_edges(spark):
    spec = TableSpec(
        "users",
        (
            ColumnSpec("id", "int"), ColumnSpec("org_id", "int", fk_ref="orgs.id"),
            ColumnSpec("org2", "int", fk_ref="orgs.id2"), ColumnSpec("broken", "int", fk_ref="not-a-ref"),
        ),
    )
    edges = match.fk_edges(columns_frame(spark, [spec])).collect()
    assert [(e["child"], e["parent"], e["ordinal"]) for e in edges] == [("users", "orgs", 2)]
    assert match.fk_edges(columns_frame(spark, [spec]), selection(spark, "users")).count() == 0
    assert spec.parents == ["orgs"]


# ---- load order -----------------------------------------------------------


def graph(spark, tables, parents):
    frame = spark.createDataFrame(
        [("d", t, i) for i, t in enumerate(tables)], "database string, table_name string, position int"
    )
    edges = spark.createDataFrame(
        [("d", c, p) for c, ps in parents.items() for p in ps] or [("d", "-", "-")],
        "database string, child string, parent string",
    ).filter("child <> '-'")
    return frame, edges


@pytest.mark.parametrize(
    "tables, parents, want",
    [
        (["users", "orgs", "audit"], {"users": ["orgs"], "audit": ["users"]}, ["orgs", "users", "audit"]),
        (["a", "b", "c", "d"], {"b": ["a"], "c": ["a"], "d": ["b", "c"]}, ["a", "b", "c", "d"]),
        (["d", "c", "b", "a"], {"b": ["a"], "c": ["a"], "d": ["b", "c"]}, ["a", "c", "b", "d"]),
        (["employees"], {"employees": ["employees"]}, ["employees"]),
        (["z", "a", "m"], {}, ["z", "a", "m"]),
        ([f"t{i}" for i in range(12)], {f"t{i}": [f"t{i + 1}"] for i in range(11)}, [f"t{i}" for i in reversed(range(12))]),
    ],
)
def test_load_order(spark, tables, parents, want):
    assert ordered_names(*graph(spark, tables, parents)) == want


def test_cycles_name_their_tables_and_what_depends_on_them(spark):
    frame, edges = graph(spark, ["a", "b", "c", "free"], {"a": ["b"], "b": ["a"], "c": ["a"]})
    with pytest.raises(CircularReferences, match="a, b, c"):
        ordered_names(frame, edges)
    passes = load_passes(frame, edges)
    assert sorted(r["table_name"] for r in stuck_tables(passes).collect()) == ["a", "b", "c"]
    assert load_order(passes).count() == 0


# ---- selection, manifests, progress ---------------------------------------


def test_selected_tables():
    have = ["orders", "users"]
    assert catalog.selected_tables(have) == have
    assert catalog.selected_tables(have, single="users") == ["users"]
    assert catalog.selected_tables(have, several="users, orders,users, ") == ["users", "orders"]
    for options in ({"single": "nope"}, {"several": "users,nope"}, {"several": " , "}):
        with pytest.raises(LookupError):
            catalog.selected_tables(have, **options)
    with pytest.raises(ValueError):
        catalog.selected_tables(have, "users", "orders")


def test_introspection_handles_equal_constraint_names(spark):
    cols = spark.createDataFrame(
        [("d", t, c, i, "integer", "integer", "NO", None, 32, 0) for t in ("a", "b") for i, c in enumerate(("x", "y"), 1)],
        "database string, table_name string, column_name string, ordinal_position int, data_type string, "
        "column_type string, is_nullable string, character_maximum_length bigint, numeric_precision bigint, numeric_scale bigint",
    )
    cons = spark.createDataFrame(
        [("d", "a", "k", "PRIMARY KEY"), ("d", "b", "k", "UNIQUE"), ("d", "b", "f", "FOREIGN KEY")],
        "database string, table_name string, constraint_name string, constraint_type string",
    )
    use = spark.createDataFrame(
        [("d", "a", "k", "x", 1), ("d", "b", "k", "y", 1), ("d", "b", "f", "x", 1), ("d", "b", "f", "y", 2)],
        "database string, table_name string, constraint_name string, column_name string, ordinal_position int",
    )
    refs = spark.createDataFrame(
        [("d", "b", "f", 1, "a", "x"), ("d", "b", "f", 2, "a", "y")],
        "database string, table_name string, constraint_name string, ordinal_position int, ref_table string, ref_column string",
    )
    got = catalog.introspect(cols, catalog.key_facts(cons, use, refs)).orderBy("table_name", "ordinal").collect()
    assert [(r["is_pk"], r["is_unique"], r["fk_ref"]) for r in got] == [
        (True, False, ""), (False, False, ""), (False, False, "a.x"), (False, True, "a.y"),
    ]
    spec = TableSpec.from_catalog("b", catalog.introspect(cols, catalog.key_facts(cons, use, refs)))
    assert spec.unique_keys == [("y",)] and spec.parents == ["a"]
    with pytest.raises(LookupError):
        TableSpec.from_catalog("zzz", catalog.introspect(cols, catalog.key_facts(cons, use, refs)))


def test_manifest(spark):
    rows = [("d1", "shop", "users", 2, "ready", "2024"), ("d1", "shop", "orders", 0, "pending", "2024"), ("d2", "x", "users", 1, "", "2025")]
    m = spark.createDataFrame(rows, "schema_id string, name string, table_name string, rows int, status string, created_at string")
    assert sorted((r["schema_id"], r["tables"]) for r in manifest.list_schemas(m).collect()) == [("d1", 2), ("d2", 1)]
    assert [r["schema_id"] for r in manifest.list_schemas(m, "orders").collect()] == ["d1"]
    assert manifest.show_schema(m, "d1").count() == 2
    assert manifest.ready_tables(m).count() == 2
    assert [r["table_name"] for r in manifest.unready_tables(m).collect()] == ["orders"]
    sample = manifest.sample_rows(m.select("schema_id", "rows"), ["schema_id", "rows"], limit=1).collect()
    assert sample[0]["sample"] == '{"schema_id":"d1","rows":0}'


@pytest.mark.parametrize(
    "generated, requested, reported, overall, want",
    [
        (50, 200, 0, "generating", 25), (84, 200, 42, "generating", 42), (5, 0, 0, "generating", 0),
        (300, 200, 0, "generating", 100), (1, 2, 0, "ready", 0), (1, 2, 500, "generating", 100),
        (1, 2, -5, "ready", 0), (2, 3, -5, "generating", 66),
    ],
)
def test_progress_percent(spark, generated, requested, reported, overall, want):
    cols = [F.lit(generated), F.lit(requested), F.lit(reported), F.lit(overall)]
    assert spark.range(1).select(progress_percent(*cols)).first()[0] == want


def test_totals_and_tally(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "table_name string, generated int, requested int")
    assert tuple(progress_totals(df).first()) == (3, 30)
    assert {r["table_name"]: r["rows"] for r in load_tally(df).collect()} == {"a": 1, "b": 1, None: 2}


def test_catalog_queries_per_dialect():
    for driver, schema in (("postgres", "'public'"), ("mysql", "DATABASE()")):
        queries = jdbc.catalog_queries(jdbc.Connection(driver, database="shop"))
        assert set(queries) == {"tables", "columns", "constraints", "usage", "references", "checks"}
        assert all(schema in q and "{" not in q for q in queries.values())
    assert jdbc.Connection("postgres", database="d").jdbc_url == "jdbc:postgresql://localhost:5432/d"
    assert jdbc.Connection("mysql", "h", 1, "d").jdbc_url == "jdbc:mysql://h:1/d"
    with pytest.raises(ValueError):
        jdbc.Connection("oracle")


def test_lake_columns(spark):
    df = spark.sql("select 1L as a, 'x' as b, cast(1 as decimal(8,2)) as c")
    got = catalog.lake_columns(df, "d", "t").orderBy("ordinal_position").collect()
    assert [(r["column_name"], r["data_type"], r["numeric_precision"]) for r in got] == [("a", "bigint", None), ("b", "text", None), ("c", "numeric", 8)]
