"""The Merkle manifest against a plain version."""

import random

import pytest
from brute import merkle

from rowsluice.llm.merkle import MerkleManifest
from rowsluice.llm.queries import op11_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, part string, node string, pos int, key string, s0 string, path string, n int"
NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def table(seed, sizes):
    r = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        rows += [(r.randrange(5 * n), r.choice(["a", None, "é"]), lang, r.choice([None, r.randrange(99)]), r.choice([None, "", "Ab cD", "É" * 40, "X" * r.randrange(9000)])) for _ in range(n)]
    rows += [(None, "s", "en", 1, "Null id"), (None, "s", "en", 1, "Null id"), (7, "s", "en", 1, "Tie"), (7, "t", "en", 1, "Tie")]
    r.shuffle(rows)
    return rows


def written(spark, folder, rows):
    full = [(*r, "p", "x", 1, "k", "y", "z", 2) for r in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("sizes", [
    {"en": 600, "fr": 8, "de": 1, None: 9, "": 64, "é": 65, "zz": 2, "日本": 1, "a": 3, "b": 1, "c": 1},
    {"en": 1}, {}, {"en": 5, "fr": 1},
])
def test_manifest(spark, folder, sizes):
    rows = table(len(sizes), sizes)
    got = op11_merkle_manifest(spark, written(spark, folder, rows))
    assert got.columns == NAMES
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(merkle(rows), key=key)


def test_single_and_empty(spark, folder):
    one = [(3, "s", None, None, None)]
    assert [tuple(r) for r in op11_merkle_manifest(spark, written(spark, folder, one)).collect()] == merkle(one)
    assert op11_merkle_manifest(spark, written(spark, folder, [])).collect() == []


def test_check_finds_changed_and_unknown_rows(spark, folder):
    rows = [(i, "s", "en" if i % 3 else "fr", i, f"Text {i}") for i in range(100)]
    docs = spark.read.parquet(written(spark, folder, rows) + "/documents.parquet")
    tree = MerkleManifest()
    proofs = tree.proved(docs)
    assert tree.check(docs, proofs).filter("NOT verified").count() == 0
    changed = docs.selectExpr("doc_id", "source", "lang", "n_chars + int(doc_id = 5) AS n_chars", "if(doc_id = 9, 'text 9', text) AS text")
    changed = changed.unionAll(changed.filter("doc_id = 1").selectExpr("1000L", "source", "lang", "n_chars", "text"))
    bad = tree.check(changed, proofs).filter("NOT verified").collect()
    assert sorted(r["doc_id"] for r in bad) == [5, 9, 1000]
