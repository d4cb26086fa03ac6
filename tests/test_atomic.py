"""Loads that show all at once or not at all, in folders and in a database."""

import uuid

import pytest
from pyspark.sql import functions as F

from rowsluice.operators.spec import ColumnSpec, TableSpec
from rowsluice.plans.push import LoadAborted, Source, push_tables
from rowsluice.sources.jdbc import Connection, run_statements
from rowsluice.sources.sinks import ATTEMPT, LOADS, PART, JdbcSink
from rowsluice.sources.versions import PublishConflict, VersionedSink

ORGS = TableSpec("orgs", (ColumnSpec("id", "bigint", is_pk=True), ColumnSpec("name", "varchar")))
USERS = TableSpec("users", (ColumnSpec("id", "bigint", is_pk=True), ColumnSpec("org", "bigint", fk_ref="orgs.id")))


def sources(spark, n, broken=False):
    orgs = spark.range(n).select("id", F.concat(F.lit("n"), "id").alias("name"))
    users = spark.range(2 * n).select("id", F.pmod("id", F.lit(n)).alias("org"))
    if broken:
        users = users.withColumn("org", F.when(F.col("id") == n, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("org")))
    return [Source(USERS, users, ("id",)), Source(ORGS, orgs, ("id",))]


def counts(sink):
    return sink.read("orgs").count(), sink.read("users").count()


def test_versions(spark, folder):
    sink = VersionedSink(spark, folder)
    assert not sink.exists("orgs") and sink.history().collect() == []
    with pytest.raises(LookupError):
        sink.read("orgs")
    for spec in (ORGS, USERS):
        sink.create(spec)
        sink.create(spec)  # nothing to do
    assert counts(sink) == (0, 0) and sink.read("users").columns == ["id", "org"]
    result = push_tables(sources(spark, 5), sink, policy="report")
    assert counts(sink) == (5, 10) and "published version 3" in result.notes[-1]
    old = sink.read("users")
    with pytest.raises(LoadAborted) as problem:
        push_tables(sources(spark, 7, broken=True), sink, policy="report")
    assert problem.value.undone and counts(sink) == (5, 10)
    push_tables(sources(spark, 3), sink, policy="report")
    assert counts(sink) == (3, 6) and old.count() == 10  # a frame keeps to its version
    push_tables(sources(spark, 3), sink, policy="report", append=True)
    assert counts(sink) == (6, 12)
    assert sink.read("orgs", 3).count() == 5
    assert [(r["sequence"], r["tables"]) for r in sink.history().orderBy("sequence").collect()] == [(1, 1), (2, 2), (3, 2), (4, 2), (5, 2)]


def test_versions_that_compete(spark, folder):
    sink = VersionedSink(spark, folder)
    sink.create(ORGS)
    one, other = sink.begin(), sink.begin()
    rows = spark.range(3).select("id", F.lit("x").alias("name"))
    one.append(rows, "orgs")
    other.append(rows, "orgs")
    assert other.read("orgs").count() == 3 and sink.read("orgs").count() == 0
    one.publish()
    with pytest.raises(PublishConflict):
        other.publish()
    assert sink.read("orgs").count() == 3
    # both at once: the smaller name is the version, whatever was written later
    base = sink.begin()
    pointers = [(3, name, "orgs", list(base.tables["orgs"])) for name in ("a", "b")]
    spark.createDataFrame(pointers, "sequence long, version string, table_name string, folders array<string>").write.mode("append").parquet(sink.path("published"))
    assert sink.snapshot().version == "a"


@pytest.fixture
def database(spark):
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    sink = JdbcSink(spark, Connection("derby", url=url, options=options), writers=2)
    run_statements(spark, sink.connection, [
        'CREATE TABLE "orgs" ("id" BIGINT PRIMARY KEY, "name" VARCHAR(20))',
        'CREATE TABLE "users" ("id" BIGINT PRIMARY KEY, "org" BIGINT REFERENCES "orgs" ("id"))',
    ])
    return sink


def tables(sink):
    return sink._reader().option("query", "SELECT TABLENAME AS N FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'").load().collect()


def test_database_load_is_one_step(spark, database):
    push_tables(sources(spark, 5), database, policy="report")
    assert counts(database) == (5, 10)
    with pytest.raises(LoadAborted):
        push_tables(sources(spark, 7, broken=True), database, policy="report")
    assert counts(database) == (5, 10)
    push_tables(sources(spark, 3), database, policy="report")  # children are emptied first, parents filled first
    assert counts(database) == (3, 6)
    with pytest.raises(Exception, match="(?i)duplicate"):  # the keys exist: the whole load is undone
        push_tables(sources(spark, 4), database, policy="report", append=True)
    assert counts(database) == (3, 6)


def test_repeated_tasks_and_loads_leave_no_duplicates(spark, database):
    rows = spark.range(10).select("id", F.lit("x").alias("name"))
    load = database.begin("load-1")
    load.append(rows, "orgs")
    staging = load.staged["orgs"][0]
    again = database.read(staging).filter(F.col(PART) == 0).withColumn(ATTEMPT, F.col(ATTEMPT) + 1000)
    again = spark.createDataFrame(again.collect(), again.schema)
    database.append(again, staging)  # what a task leaves that runs again after its commit
    assert database.read(staging).count() > 10 and load.read("orgs").count() == 10
    load.publish()
    assert database.read("orgs").count() == 10
    load = database.begin("load-1")  # the whole load once more
    load.append(rows, "orgs")
    assert "before" in load.publish() and database.read("orgs").count() == 10
    assert sorted(r[0] for r in tables(database)) == ["orgs", LOADS, "users"]


def test_statements_are_one_transaction(spark, database):
    assert run_statements(spark, database.connection, ["INSERT INTO \"orgs\" VALUES (1, 'a'), (2, 'b')"]) == [2]
    with pytest.raises(Exception, match="(?i)duplicate"):
        run_statements(spark, database.connection, ["INSERT INTO \"orgs\" VALUES (3, 'c')", "INSERT INTO \"orgs\" VALUES (1, 'a')"])
    assert database.read("orgs").count() == 2
