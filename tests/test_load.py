"""JSONL, projections, sinks, loads, streaming and generated rows."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from rowsluice.functions.variants import inferred_type, writable_text
from rowsluice.operators.generate import generate_rows, generate_tables
from rowsluice.operators.keys import orphan_keys
from rowsluice.operators.match import keys_outside
from rowsluice.operators.project import all_columns, first_row_columns, write_projection
from rowsluice.operators.spec import CheckSpec, ColumnSpec, TableSpec
from rowsluice.operators.validate import ValidationFailed, Validator
from rowsluice.plans.push import LoadRefused, Source, dry_run, push_table, push_tables
from rowsluice.sources.jdbc import Connection, read_table
from rowsluice.sources.jsonl import classify_lines, line_counts, read_jsonl, rows_from_lines, stream_jsonl
from rowsluice.sources.sinks import JdbcSink, ParquetSink, TableSink, checked_batch_size, truncate_statements
from rowsluice.streaming.ingest import Ingest
from rowsluice.streaming.progress import finished

ORGS = TableSpec("orgs", (ColumnSpec("id", "bigint", nullable=False, is_pk=True), ColumnSpec("name", "varchar", length=10)))
USERS = TableSpec(
    "users",
    (
        ColumnSpec("id", "bigint", nullable=False, is_pk=True),
        ColumnSpec("email", "varchar", length=40, unique=True),
        ColumnSpec("org_id", "bigint", fk_ref="orgs.id"),
        ColumnSpec("joined", "datetime"),
        ColumnSpec("extra", "json"),
    ),
    (CheckSpec("mail", "(email <> 'none')"), CheckSpec("len", "(char_length(email) > 3)")),
)

LINES = [
    ('{"a":1}', "row"), ("  ", "blank"), ('{"a":', "malformed"), ('{"a":1}x', "malformed"),
    ('{"a":1}{"b":2}', "malformed"), ("[1]", "malformed"), ("null", "malformed"), ("{'a':1}", "malformed"),
    ('{"a":NaN}', "malformed"), ('{"a":1},"r":{"b":2}', "malformed"), ('{"a":1,"a":2}', "row"), ("\t{}\r", "row"),
    ('{"a":1}}', "malformed"), ('"x"', "malformed"), ('{"a":01}', "malformed"), ("　{\"a\":{\"b\":[1,null]}}", "row"),
]


def raw(spark, rows):
    lines = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(rows)]
    return rows_from_lines(spark.createDataFrame(lines, "i int, value string"))


def test_lines(spark):
    df = spark.createDataFrame([(i, x, s) for i, (x, s) in enumerate(LINES)], "i int, value string, want string")
    assert [tuple(r) for r in classify_lines(df).select("value", "line_state").collect()] == LINES
    assert tuple(line_counts(df).first()) == (len(LINES), 4, 1, len(LINES) - 5)


def test_keys_fold_and_last_one_wins(spark):
    got = raw(spark, ['{"a":1,"a":2}', '{"A":1,"b":{"C":1}}', '{"X":1,"x":3}']).select(F.to_json("row")).collect()
    assert [json.loads(r[0]) for r in got] == [{"a": 2}, {"a": 1, "b": {"C": 1}}, {"x": 3}]


def test_read_files(spark, folder):
    with open(f"{folder}/a.jsonl", "w") as f:
        f.write('{"email":"a@x.com"}\n\nbroken\n{"email":"b@x.com"}\n')
    df = read_jsonl(spark, folder)
    assert df.count() == 2 and df.select("file").distinct().count() == 1


@pytest.mark.parametrize(
    "value, text",
    [
        (None, None), ("lake side", "lake side"), (-7, "-7"), (False, "false"),
        ({"date": "1999-12-31 23:59:59"}, "1999-12-31 23:59:59"),
        ({"date": "2031-02-03 04:05:06.700000", "timezone_type": 3, "timezone": "UTC"}, "2031-02-03 04:05:06.700000"),
        ({"z": [], "k": None}, '{"k":null,"z":[]}'), ({"in": {"er": 0}}, '{"in":{"er":0}}'), ([2, "q"], '[2,"q"]'), ({}, "{}"),
        ({"date": "d", "zone": "w"}, '{"date":"d","zone":"w"}'), ({"date": 31}, '{"date":31}'),
    ],
)
def test_writable_text(spark, value, text):
    assert raw(spark, [{"v": value}]).select(writable_text(F.col("row")["v"])).first()[0] == text


def test_inferred_types(spark):
    row = {"a": True, "b": 1, "c": 1.5, "d": {}, "e": [1], "f": "x", "g": None, "h": 1e300}
    cells = raw(spark, [row]).select(F.explode("row").alias("k", "v"))
    got = {r[0]: r[1] for r in cells.select("k", inferred_type(F.col("v"))).collect()}
    assert got == {"a": "boolean", "b": "numeric", "c": "numeric", "d": "json", "e": "json", "f": "text", "g": "text", "h": "numeric"}
    exact = {r[0]: r[1] for r in cells.select("k", inferred_type(F.col("v"), exact=True)).collect()}
    assert exact["b"] == "bigint" and exact["c"] == "numeric"


def test_columns_of_rows(spark):
    df = raw(spark, [{"b": 1, "a": 2}, {"c": 1}])
    assert first_row_columns(df, "row", ["i"]).first()["columns"] == ["a", "b"]
    assert all_columns(df, "row").first()["columns"] == ["a", "b", "c"]
    outside = df.orderBy("i").select(keys_outside(F.map_keys("row"), ["A", "c"])).collect()
    assert [r[0] for r in outside] == [["b"], []]


def test_projection_types(spark):
    spec = TableSpec(
        "t",
        (
            ColumnSpec("n", "int"), ColumnSpec("big", "bigint", unsigned=True), ColumnSpec("d", "decimal", precision=6, scale=2),
            ColumnSpec("f", "double"), ColumnSpec("b", "boolean"), ColumnSpec("t", "datetime"), ColumnSpec("s", "text"), ColumnSpec("gone", "int"),
        ),
    )
    rows = [
        {"N": "7", "big": "18446744073709551615", "d": "12.50", "f": 2, "b": True, "t": {"date": "2024-01-02 03:04:05"}, "s": 1.5, "late": 1},
        {"n": 7.0, "big": 3, "d": 1, "f": "1e3", "b": "false", "t": "2024-01-02", "s": [1]},
        {"n": 7.5, "big": "x", "d": "many", "f": "1d"},
    ]
    got = [tuple(map(str, r)) for r in write_projection(raw(spark, rows), spec, "row").collect()]
    assert got[0] == ("7", "18446744073709551615", "12.50", "2.0", "True", "2024-01-02 03:04:05", "1.5", "None")
    assert got[1] == ("7", "3", "1.00", "1000.0", "False", "2024-01-02 00:00:00", "[1]", "None")
    assert set(got[2]) == {"None"}


def test_dry_run(spark):
    df = raw(spark, [{"id": 1, "zip": 2, "Name": "x"}] + [{"id": i, "other": 1} for i in range(2, 9)])
    out = dry_run(df, ORGS, ["i"], "row").first()
    assert (out["rows"], out["unknown_keys"]) == (8, "zip")
    assert len(out["sample"].split("\n")) == 5 and out["sample"].startswith('{"id":1,"name":"x","zip":2}')


# ---- sinks and loads ------------------------------------------------------


def sources(spark, users):
    orgs = spark.createDataFrame([(0, 1, "one"), (1, 2, "two")], "i int, id bigint, name string")
    return [Source(USERS, raw(spark, users), ("i",), "row"), Source(ORGS, orgs, ("i",))]


GOOD = [
    {"id": 1, "email": "a@x", "org_id": 1, "joined": {"date": "2024-01-01"}, "extra": {"b": 1, "a": 2}},
    {"id": 2, "email": "b@x", "org_id": None},
]


def ready_sink(spark, folder):
    sink = ParquetSink(spark, folder)
    for spec in (ORGS, USERS):
        sink.create(spec)
    return sink


def test_push_tables_parents_first(spark, folder):
    sink = ready_sink(spark, folder)
    result = push_tables(sources(spark, GOOD), sink)
    assert list(result.written) == ["orgs", "users"] and result.total == 4
    assert any("len" in n and "not validated" in n for n in result.notes)
    got = sink.read("users").orderBy("id").collect()
    assert [r["email"] for r in got] == ["a@x", "b@x"] and got[0]["extra"] == '{"a":2,"b":1}'
    assert push_tables(sources(spark, GOOD), sink).total == 4 and sink.read("users").count() == 2
    push_tables(sources(spark, GOOD), sink, append=True)
    assert sink.read("users").count() == 4


def test_abort_writes_nothing(spark, folder):
    sink = ready_sink(spark, folder)
    source = sources(spark, [*GOOD, {"id": 2, "email": "none"}])[0]
    with pytest.raises(ValidationFailed):
        push_table(source, sink)
    assert sink.read("users").count() == 0


def test_report(spark, folder):
    sink = ready_sink(spark, folder)
    source = sources(spark, [*GOOD, {"id": 2, "email": "none"}])[0]
    result = push_table(source, sink, "report")
    assert result.written == {"users": 3}
    assert result.reported == {"users": {("id", "unique"): 1, ("mail", "check"): 1}}


def test_quarantine(spark, folder):
    sink, aside = ready_sink(spark, folder), ParquetSink(spark, f"{folder}/aside")
    source = sources(spark, [*GOOD, {"id": 2, "email": "none"}, {"id": 3, "email": "c@x"}])[0]
    result = push_table(source, sink, "quarantine", quarantine=aside)
    assert (result.written["users"], result.rejected["users"]) == (3, 1)
    assert aside.read("users").count() == 1


def test_refusals(spark, folder):
    sink = ready_sink(spark, folder)
    users, orgs = sources(spark, GOOD)
    with pytest.raises(LoadRefused, match="not ready"):
        push_table(Source(ORGS, orgs.rows, ("i",), status="pending"), sink)
    with pytest.raises(LoadRefused, match="no target table"):
        push_table(Source(TableSpec("ghost", ORGS.columns), orgs.rows, ("i",)), sink)
    with pytest.raises(LoadRefused, match="does not fit its target"):
        push_table(Source(ORGS, orgs.rows, ("i",), declared=(("id", "text"),)), sink)
    with pytest.raises(LoadRefused, match="no ready"):
        push_tables([Source(ORGS, orgs.rows, ("i",), status="failed")], sink)
    result = push_tables([users, Source(ORGS, orgs.rows, ("i",), status="pending")], sink, dry_run=True)
    assert result.written == {} and any("skipping 'orgs'" in n for n in result.notes)


def test_table_without_rules(spark, folder):
    spec = TableSpec("notes", (ColumnSpec("note", "text"),))
    sink = ParquetSink(spark, folder)
    sink.create(spec)
    rows = spark.createDataFrame([(0, "a"), (1, None)], "i int, note string")
    assert push_table(Source(spec, rows, ("i",)), sink).total == 2
    assert push_table(Source(spec, rows, ("i",)), sink, "quarantine").rejected == {"notes": 0}
    assert push_table(Source(spec, rows, ("i",)), sink, "report").reported == {"notes": {}}
    assert Validator(spec, ("i",)).summary(rows).count() == 0


def test_orphans_and_unfit_values_are_refused(spark, folder):
    sink = ready_sink(spark, folder)
    users, orgs = sources(spark, [{"id": 1, "email": "a@x", "org_id": 9}])
    push_table(orgs, sink)
    with pytest.raises(LoadRefused, match="org_id: 9 has no row in orgs"):
        push_table(users, sink, references=True)
    with pytest.raises(ValidationFailed, match="cannot become"):
        push_table(sources(spark, [{"id": 1, "joined": "soon"}])[0], sink)
    assert push_table(sources(spark, GOOD)[0], sink, references=True).total == 2


def test_session_tables(spark):
    spec = TableSpec(f"orgs_{uuid.uuid4().hex}", ORGS.columns)
    sink = TableSink(spark)
    sink.create(spec)
    rows = spark.createDataFrame([(0, 1, "one")], "i int, id bigint, name string")
    push_table(Source(spec, rows, ("i",)), sink)
    assert sink.exists(spec.name) and sink.read(spec.name).count() == 1
    sink.truncate([spec])
    assert sink.read(spec.name).count() == 0
    spark.sql(f"DROP TABLE {sink.name(spec.name)}")


def test_jdbc(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    connection = Connection("derby", url=url, options=driver)
    sink = JdbcSink(spark, connection, batch_size=2, writers=2)
    assert not sink.exists("orgs")
    rows = spark.createDataFrame([(i, i, f"n{i}") for i in range(7)], "i int, id bigint, name string")
    rows.select("id", "name").limit(0).write.jdbc(url, '"orgs"', properties=driver)
    push_table(Source(ORGS, rows, ("i",)), sink)
    assert sink.exists("orgs") and sink.read("orgs").count() == 7
    parts = read_table(spark, connection, '"orgs"', '"id"', 3)
    assert parts.count() == 7 and parts.rdd.getNumPartitions() == 3
    sink.truncate([ORGS])
    assert sink.exists("orgs") and sink.read("orgs").count() == 0


def test_truncate_text_and_batch_size():
    assert truncate_statements("postgres", ["orgs", "users"]) == ['TRUNCATE TABLE "orgs", "users"']
    assert truncate_statements("mysql", ["orgs", "users"]) == ["TRUNCATE TABLE `users`", "TRUNCATE TABLE `orgs`"]
    assert truncate_statements("postgres", ['we"ird']) == ['TRUNCATE TABLE "weird"']
    assert truncate_statements("mysql", []) == []
    assert checked_batch_size(5000) == 5000
    for size in (0, 5001):
        with pytest.raises(ValueError):
            checked_batch_size(size)


# ---- streaming ------------------------------------------------------------


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.jsonl", "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def by_id(df):
    return df.withColumn("i", F.try_variant_get(F.col("row")["id"], "$", "bigint"))


STREAMED = TableSpec(
    "users", (ColumnSpec("id", "bigint", nullable=False), ColumnSpec("email", "varchar", length=5, unique=True))
)


def test_stream_over_several_batches(spark, folder):
    source, load = f"{folder}/in", Ingest(STREAMED, f"{folder}/out", ("i",))

    def run():
        query = load.start(by_id(stream_jsonl(spark, source, maxFilesPerTrigger=1)))
        query.awaitTermination()
        return query

    put(source, "a", [{"id": 1, "email": "a"}, "broken", {"id": 2, "email": "b"}, {"id": 3, "email": "a"}])
    run()
    put(source, "b", [{"id": 4, "email": "b"}, {"id": 5, "email": "c"}, {"id": 6, "email": "toolong"}])
    query = run()
    put(source, "c", [{"id": 7, "email": "c"}, {"id": 8, "email": None}, {"id": 9, "email": "toolong"}])
    run()
    assert sorted(r["id"] for r in load.loaded(spark).collect()) == [1, 2, 5, 8]
    rejected = sorted((r["i"], r["rule"]) for r in load.rejected(spark).collect())
    assert rejected == [(3, "unique"), (4, "unique"), (6, "length"), (7, "unique"), (9, "length")]
    assert finished(query, 60).batches >= 1


def test_redelivered_and_corrected_rows(spark, folder):
    load = Ingest(STREAMED, folder, ("i",))
    load.load_batch(raw(spark, [{"id": 1, "email": "toolong"}, {"id": 2, "email": "b"}]), 0)
    again = raw(spark, [{"id": 1, "email": "a"}, {"id": 3, "email": "c"}])
    load.load_batch(again.unionByName(again), 1)
    assert sorted(r["id"] for r in load.loaded(spark).collect()) == [1, 2, 3]
    assert [r["rule"] for r in load.rejected(spark).collect()].count("unique") == 2


def test_all_sources_are_checked_before_any_target_is_touched(spark, folder):
    sink = ready_sink(spark, folder)
    push_tables(sources(spark, GOOD), sink)
    users, orgs = sources(spark, GOOD)
    late = max((users, orgs), key=lambda s: s.spec.name == "users")
    bad = Source(late.spec, late.rows.unionByName(late.rows), late.order, late.row)
    with pytest.raises(ValidationFailed):
        push_tables([s for s in (users, orgs) if s is not late] + [bad], sink)
    assert sink.read("users").count() == 2 and sink.read("orgs").count() > 0


def test_replayed_batch_changes_nothing(spark, folder):
    load = Ingest(STREAMED, folder, ("i",))
    first = raw(spark, [{"id": 1, "email": "a"}, {"id": 2, "email": "b"}])
    second = raw(spark, [{"id": 3, "email": "a"}, {"id": 4, "email": "d"}])
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        load.load_batch(batch, number)
    assert sorted(r["id"] for r in load.loaded(spark).collect()) == [1, 2, 4]
    assert load.rejected(spark).count() == 1


def test_stream_abort_keeps_earlier_batches(spark, folder):
    source, load = f"{folder}/in", Ingest(STREAMED, f"{folder}/out", ("i",), policy="abort")
    put(source, "a", [{"id": 1, "email": "a"}])
    load.start(by_id(stream_jsonl(spark, source))).awaitTermination()
    put(source, "b", [{"id": 2, "email": "toolong"}])
    query = load.start(by_id(stream_jsonl(spark, source)))
    with pytest.raises(Exception, match="is above"):
        query.awaitTermination()
    assert [r["id"] for r in load.loaded(spark).collect()] == [1]


def test_waiting_ends_in_time(spark, folder):
    source, load = f"{folder}/in", Ingest(STREAMED, f"{folder}/out", ("i",))
    put(source, "a", [{"id": 1, "email": "a"}])
    query = load.start(by_id(stream_jsonl(spark, source)), available_now=False, processingTime="1 hour")
    try:
        with pytest.raises(TimeoutError):
            finished(query, 1)
    finally:
        query.stop()

def test_generated_rows_satisfy_their_constraints(spark):
    line = TableSpec(
        "line",
        (
            ColumnSpec("user_id", "bigint", nullable=False, is_pk=True, fk_ref="users.id"),
            ColumnSpec("n", "smallint", nullable=False, is_pk=True),
            ColumnSpec("qty", "int"), ColumnSpec("kind", "set", values=("a", "b")), ColumnSpec("price", "decimal", precision=5, scale=2),
            ColumnSpec("ok", "boolean"), ColumnSpec("at", "timestamp"), ColumnSpec("ref", "uuid"), ColumnSpec("parent", "bigint", fk_ref="line.n"),
        ),
        (CheckSpec("q", "(qty BETWEEN 3 AND 9)"), CheckSpec("p", "((price > 10) AND (price <= 20))")),
    )
    counts = {"orgs": 7, "users": 50, "line": 300}
    tables = generate_tables(spark, [ORGS, USERS, line], counts)
    for spec in (ORGS, USERS, line):
        df = tables[spec.name]
        assert df.count() == counts[spec.name]
        total = Validator(spec, spec.primary_key, strict=True).summary(df).agg(F.sum("violations")).first()[0]
        assert total == 0, spec.name
        key = list(spec.primary_key)
        assert df.select(*key).distinct().count() == counts[spec.name]
    assert orphan_keys(tables["users"], ["org_id"], tables["orgs"], ["id"]).count() == 0
    assert orphan_keys(tables["line"], ["user_id"], tables["users"], ["id"]).count() == 0
    assert generate_rows(spark, ORGS, 5).collect() == generate_rows(spark, ORGS, 5, partitions=3).collect()


def test_generation_limits(spark):
    with pytest.raises(ValueError):
        generate_rows(spark, ORGS, 0)
    tiny = TableSpec("t", (ColumnSpec("id", "tinyint", is_pk=True),))
    with pytest.raises(ValueError, match="do not fit"):
        generate_rows(spark, tiny, 1000)
