"""Rows and memory that must not grow with the square of a group or with copies of a task's input."""

import re
import sys
import tracemalloc
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from rowsluice.llm import anchors, common as c, jaccard, packing, quality, tokens


def test_tiles_give_fewer_rows_than_points():
    """Points that may all link, each of a component of its own, give a forest and not all of their pairs."""
    m, size = 60, 40
    points = pa.array([bytes([size // 16 + 1] * 16)] * m)
    columns = [np.zeros(m, np.int64), np.arange(m), np.zeros(m, np.int32), np.full(m, size), np.arange(m)]
    tile = pa.RecordBatch.from_arrays([*map(pa.array, columns), points], names=["tile", "id", "tag", "n", "root", "point"])
    made = pa.Table.from_batches(jaccard._trees(iter([tile]), share=75))
    assert made.num_rows == m - 1
    reached = {0}
    for _ in range(m):
        reached |= {x for a, b in zip(*(made[x].to_pylist() for x in "ab")) if {a, b} & reached for x in (a, b)}
    assert len(reached) == m


def test_near_copies_without_direct_links_to_the_first_are_joined(spark):
    """A chain of near copies: each links with its neighbours only, and all share a passage with many others."""
    words = [f"w{i}" for i in range(400)]
    chain = [" ".join(["common"] * 6 + words[10 * i : 10 * i + 100]) for i in range(12)]
    rest = [" ".join(["common"] * 6 + [f"x{i}y{j}" for j in range(90)]) for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(chain + rest, 1)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.JaccardJoin().joined(docs).collect()}
    assert got == {i: 1 if i <= 12 else i for i in range(1, 93)}


def test_only_texts_that_are_looked_for_travel(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(2_000)], "doc_id long, text string")
    rows = jaccard.JaccardJoin()._rows(docs)
    ends = rows.filter("id < 20").select("id", "tag")
    found = jaccard.JaccardJoin()._texts(rows, ends, 20)
    assert sorted((r["id"], r["text"]) for r in found.collect()) == [(i, f"text {i}") for i in range(20)]
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_verified_pairs_hold_few_sets_at_once(monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS", 3)
    texts = [f"a b c d e f {i // 2}" for i in range(10)]
    pairs = pa.RecordBatch.from_arrays(
        [pa.array(range(10)), pa.array(range(1, 11)), pa.array(texts), pa.array([*texts[1:], "z"])], names=["a", "b", "text_a", "text_b"]
    )
    made = list(jaccard._verified(iter([pairs]), k=5, share=75))
    assert max(map(len, made)) <= 3 and len(made) == 4
    assert [x for b in made for x in b["a"].to_pylist()] == [0, 2, 4, 6, 8]


def test_counts_of_prefixes_hold_few_copies():
    sent = [np.random.default_rng(i).integers(0, 1 << 40, 200_000).astype(np.uint64) for i in range(10)] + [np.full(9, 7, np.uint64)]
    tracemalloc.start()
    made = pa.Table.from_batches(anchors._counts(iter([]), lambda _: (x.copy() for x in sent), 8))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made.to_pylist() == [{"prefix": 7, "n": 9}]
    assert most < 2.5 * sum(x.nbytes for x in sent)
    for n in (0, 1, 7, 8):
        made = pa.Table.from_batches(anchors._counts(iter([]), lambda _, n=n: [np.arange(3, dtype=np.uint64), np.full(n, 9, np.uint64)], 8))
        assert made.to_pylist() == [{"prefix": 9, "n": 8}] * (n == 8)
    assert anchors._counts(iter([]), lambda _: [], 2).__next__().num_rows == 0


def test_packing_keeps_its_known_words(monkeypatch):
    """Words of a second table of texts, learned some 12 million counted characters ago, are not encoded anew."""
    path, calls = c.tokenizer_path(), []
    texts = pa.array([" ".join(f"q{i:x}" for i in range(at, at + 50_000)) for at in range(0, 600_000, 50_000)])
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, *a, learn=tokens.Encoder._learn: calls.append(len(a[0])) or learn(self, *a))
    monkeypatch.setattr(tokens, "encoder", lambda *a, one=tokens.Encoder(path, False, packing.KNOWN_CHARS): one)
    first = [ids.tolist() for _, _, ids, _ in tokens.encoded(texts, path, packing.KNOWN_CHARS)]
    learned = sum(calls)
    assert first == [ids.tolist() for _, _, ids, _ in tokens.encoded(texts, path, packing.KNOWN_CHARS)]
    assert learned > 590_000 and sum(calls) == learned


def _tasks(monkeypatch, docs) -> list:
    """The functions that operators over ``docs`` give to mapInArrow from now on."""
    given, original = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a, **k: given.append(f) or original(self, f, *a, **k))
    return given


def test_workers_drop_the_encoder_of_another_step(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one text", "a")], "doc_id long, text string, source string")
    tasks = _tasks(monkeypatch, docs)
    monkeypatch.setattr(packing.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    packing.Packer(c.tokenizer_path()).pieces(docs)
    c.once("encoder of a test", object)
    list(tasks.pop()(iter([])))
    kept = sys.modules["_rowsluice_llm_kept"]
    assert "encoder of a test" in vars(kept)
    quality.LineFrequency().profile(docs)
    list(tasks.pop()(iter([])))
    assert "encoder of a test" not in vars(kept)


def test_idle_workers_hold_little(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one text")], "doc_id long, text string")
    tasks = _tasks(monkeypatch, docs)
    jaccard.JaccardJoin().profiled(docs)

    def batches(n: int):
        for seed in range(n):
            words = np.random.default_rng(seed).integers(0, 1 << 20, (5_000, 300)).astype(str)
            texts = pa.array([" ".join(w) for w in words.tolist()])
            rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(np.zeros(len(texts), np.int32)), texts], names=["id", "tag", "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_batch(rows)
            del words, texts, rows
            yield from pa.ipc.open_stream(sink.getvalue())

    held = lambda: int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024
    c.powers(1 << 20)
    before = held()
    for _ in tasks[0](batches(2)):
        pass
    assert held() - before < 25
