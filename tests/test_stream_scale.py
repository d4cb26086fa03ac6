"""Streaming loads at scale: claims in state, digests as bytes, feeds cut into as many files as they need."""

import glob

from pyspark.sql import functions as F

from rowsluice.operators.spec import ColumnSpec, TableSpec
from rowsluice.plans.load_queries import FEED_BATCHES, feed
from rowsluice.plans.registry import Tables
from rowsluice.streaming.ingest import Ingest
from rowsluice.streaming.keyed import Claims

ITEMS = TableSpec("items", (ColumnSpec("id", "bigint", is_pk=True), ColumnSpec("code", "varchar", unique=True)))


def digests(spark, *values):
    return spark.createDataFrame([(bytes([v]),) for v in values], "digest binary")


def taken(claims, spark, batch, *values):
    return sorted(r["digest"][0] for r in claims.taken(digests(spark, *values), batch).collect())


def test_claims_outlive_restarts_and_replays(spark, folder):
    claims = Claims(spark, f"{folder}/keys")
    claims.start()
    try:
        assert taken(claims, spark, 0, 1, 2) == []
        assert taken(claims, spark, 1, 2, 3) == [2]
        assert taken(claims, spark, 1, 2, 3) == [2]  # a replay owns what it owned
    finally:
        claims.stop()
    claims = Claims(spark, f"{folder}/keys")
    claims.start()
    try:
        assert taken(claims, spark, 2, 1, 3, 4) == [1, 3]
    finally:
        claims.stop()


def test_digests_are_bytes_and_shown_as_hex(spark, folder):
    load = Ingest(ITEMS, folder, ("i",))
    rows = spark.sql("""SELECT id AS i, from_json('{"id":' || id || ',"code":"x"}', 'map<string,variant>') AS row FROM range(2)""")
    staged, _ = load.staged(rows)
    assert dict(staged.dtypes)["_digest1"] == "binary"
    assert {r[0] for r in staged.select(F.length("_digest1")).collect()} == {32}
    load.load_batch(rows, 0)
    (value,) = [r["value"] for r in load.rejected(spark).collect()]
    assert len(value) == 64 and value == value.lower() and bytes.fromhex(value)


def test_large_batches_are_many_files(spark, folder, monkeypatch):
    for n, files in ((400, 4), (400_000, 5)):
        monkeypatch.setattr("rowsluice.plans.load_queries.scratch_path", lambda spark, label: f"{folder}/{n}")
        feed(Tables(spark, folder), spark.range(n), F.col("id") % FEED_BATCHES)
        assert len(glob.glob(f"{folder}/{n}/*.parquet")) == files * FEED_BATCHES
