"""Streaming loads: keys in operator state, and rows that wait for their parents."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from rowsluice.operators.spec import ColumnSpec, TableSpec
from rowsluice.sources.jsonl import stream_jsonl
from rowsluice.operators.progress import progress_totals
from rowsluice.streaming.ingest import Ingest
from rowsluice.streaming.keyed import KeyedIngest
from rowsluice.streaming.progress import LoadListener
from rowsluice.streaming.related import RelatedIngest

USERS = TableSpec(
    "users",
    (
        ColumnSpec("id", "bigint", nullable=False, is_pk=True),
        ColumnSpec("email", "varchar", length=5, unique=True),
        ColumnSpec("paid", "decimal", precision=8, scale=2),
    ),
)


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.jsonl", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n")


def stream(spark, folder):
    rows = stream_jsonl(spark, folder)
    return rows.withColumn("i", F.try_variant_get(F.col("row")["id"], "$", "bigint"))


def test_keys_in_state(spark, folder):
    source, load = f"{folder}/in", KeyedIngest(USERS, f"{folder}/out", ("i",))
    run = lambda: load.start(stream(spark, source)).awaitTermination()
    put(source, "a", [{"id": 2, "email": "b"}, {"id": 1, "email": "a"}, {"id": 3, "email": "a"}, {"id": 4, "email": "toolong"}, {"id": 5, "email": None, "paid": "1.50"}])
    run()
    put(source, "b", [{"id": 2, "email": "x"}, {"id": 4, "email": "d"}, {"id": 6, "email": "b"}, {"id": 7, "email": None}, {"id": 7, "email": None}, {"id": 8}, {"id": None, "email": "z"}])
    run()  # a new query goes on with the same keys
    loaded = {r["id"]: (r["email"], r["paid"] and float(r["paid"])) for r in load.loaded(spark).collect()}
    assert loaded == {1: ("a", None), 2: ("b", None), 4: ("d", None), 5: (None, 1.5), 7: (None, None), 8: (None, None)}
    rejected = sorted((str(r["i"]), r["column_name"], r["rule"]) for r in load.rejected(spark).collect())
    assert rejected == [
        ("2", "id", "unique"), ("3", "email", "unique"), ("4", "email", "length"), ("6", "email", "unique"),
        ("7", "id", "unique"), ("None", "id", "not_null"),
    ]


def test_state_load_aborts(spark, folder):
    source, load = f"{folder}/in", KeyedIngest(USERS, f"{folder}/out", ("i",), policy="abort")
    put(source, "a", [{"id": 1, "email": "a"}])
    load.start(stream(spark, source)).awaitTermination()
    put(source, "b", [{"id": 2, "email": "a"}])
    with pytest.raises(Exception, match="an earlier row has the same"):
        load.start(stream(spark, source)).awaitTermination()
    assert [r["id"] for r in load.loaded(spark).collect()] == [1]


def test_listener_counts_rows(spark, folder):
    source, load, listener = f"{folder}/in", Ingest(USERS, f"{folder}/out", ("i",)), LoadListener({"users": 10})
    spark.streams.addListener(listener)
    try:
        for name, rows in (("a", [{"id": 1}, {"id": 2, "email": "toolong"}]), ("b", [{"id": 1}, {"id": 3}, {"id": 4}])):
            put(source, name, rows)
            load.start(stream(spark, source)).awaitTermination()
        for _ in range(100):
            found = [tuple(r) for r in listener.rows(spark).collect()]
            if found and found[0][2] == 5 and found[0][4] == "ready":
                break
            time.sleep(0.1)
        assert found == [("users", 10, 5, 4, "ready")]
        totals = progress_totals(listener.rows(spark), ["table_name"]).collect()
        assert [(r["generated"], r["requested"]) for r in totals] == [(5, 10)]
    finally:
        spark.streams.removeListener(listener)


ORGS = TableSpec("orgs", (ColumnSpec("id", "bigint", nullable=False, is_pk=True), ColumnSpec("parent", "int", fk_ref="orgs.id")))
STAFF = TableSpec("staff", (ColumnSpec("id", "bigint", is_pk=True), ColumnSpec("org", "int", fk_ref="orgs.id"), ColumnSpec("kind", "enum", values=("a", "b"))))


def batch(spark, orgs=(), staff=()):
    rows = [("orgs", i, p, None, None) for i, p in orgs] + [("staff", i, None, o, k) for i, o, k in staff]
    df = spark.createDataFrame(rows, "table_name string, i long, parent int, org int, kind string")
    value = F.when(F.col("table_name") == "orgs", F.to_json(F.struct(F.col("i").alias("id"), "parent"))).otherwise(
        F.to_json(F.struct(F.col("i").alias("id"), "org", "kind"))
    )
    return df.select("table_name", "i", F.from_json(value, "map<string,variant>").alias("row"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def outcomes(df):
    return sorted((r["i"], r["rule"], r["value"]) for r in df.select("i", "rule", "value").collect())


def test_children_wait_for_their_parents(spark, folder):
    load = RelatedIngest((STAFF, ORGS), folder, ("i",))
    names = load.names(spark)
    assert names == ["orgs", "staff"]
    # 2 and 3 form a chain, 4 refers to itself, 5 and 6 lack a parent; of the staff 13 breaks a rule, 14 has no org
    first = batch(spark, [(1, None), (3, 2), (2, 1), (4, 4), (5, 50), (6, 5)], [(10, 1, "a"), (11, 5, "a"), (12, 9, "b"), (13, 9, "x"), (14, None, "a")])
    load.load_batch(first, 0, names)
    assert ids(load.loaded(spark, "orgs")) == [1, 2, 3, 4] and ids(load.loaded(spark, "staff")) == [10, 14]
    assert outcomes(load.rejected(spark, "staff")) == [(13, "enum", "x")]
    second = batch(spark, [(50, None), (1, None)], [(15, 50, "a"), (10, 1, "a")])
    for _ in range(2):  # a replay changes nothing
        load.load_batch(second, 1, names)
        assert ids(load.loaded(spark, "orgs")) == [1, 2, 3, 4, 5, 6, 50]
        assert ids(load.loaded(spark, "staff")) == [10, 11, 14, 15]
    waiting = load.waiting(spark, "staff").filter("batch_id = 1").collect()
    assert [(r["id"], r["_since"]) for r in waiting] == [(12, 0)]
    for _ in range(2):
        load.finish(spark)
        assert [o for o in outcomes(load.rejected(spark, "staff")) if o[1] == "reference"] == [(12, "reference", "9")]
    assert [o for o in outcomes(load.rejected(spark, "orgs")) if o[1] == "reference"] == []
    load.load_batch(batch(spark, [(9, None)]), 2, names)  # the stream goes on after all
    load.finish(spark)
    assert 12 in ids(load.loaded(spark, "staff")) and [o for o in outcomes(load.rejected(spark, "staff")) if o[1] == "reference"] == []


def test_patience_ends(spark, folder):
    load = RelatedIngest((ORGS, STAFF), folder, ("i",), patience=1)
    names = load.names(spark)
    load.load_batch(batch(spark, [], [(1, 7, "a")]), 0, names)
    load.load_batch(batch(spark, [], [(2, 8, "a")]), 1, names)
    assert outcomes(load.rejected(spark, "staff")) == [(1, "reference", "7")]
    load.load_batch(batch(spark, [(7, None), (8, None)], []), 2, names)
    assert ids(load.loaded(spark, "staff")) == [2]


def test_circles_are_refused(spark, folder):
    a = TableSpec("a", (ColumnSpec("id", "int", is_pk=True), ColumnSpec("b", "int", fk_ref="b.id")))
    b = TableSpec("b", (ColumnSpec("id", "int", is_pk=True), ColumnSpec("a", "int", fk_ref="a.id")))
    with pytest.raises(Exception, match="a, b"):
        RelatedIngest((a, b), folder, ("i",)).names(spark)
