"""Every registered query against its SQL twin on the smallest tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from rowsluice.plans import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def by_column(names, rows):
    place = [names.index(n) for n in sorted(names)]
    shown = [tuple(plain(r[i]) for i in place) for r in rows]
    return sorted(shown, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, duck, name):
    got = all_queries()[name](spark, FOLDER)
    want = duck.execute(all_oracles()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert by_column(got.columns, got.collect()) == by_column(names, want.fetchall())


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
