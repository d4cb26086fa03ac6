"""Benchmark decontamination by a broadcast set of normalised n-grams.

Words are ASCII-lower-cased runs of letters, digits and non-ASCII characters. Each window
of ``n`` words of a benchmark item (all its words, if it has fewer) goes into a sorted hash
set that every task gets. Training texts are scanned once; hits of the set are verified word
by word and mark the words they cover. The broadcast holds at most ``block`` windows; a larger
benchmark is scanned in several blocks, whose hits are then united, with the same result.

Defined cases: null and empty texts and items have no words, are never contaminated and hit
nothing; repeated rows get equal rows; equal item ids count as one item; empty tables give
no rows or no hits; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsluice.llm import common as c

SEP = c.separators("alphanumerics")
WINDOWS = "size int, hash long, words binary, item string"
HITS = "doc_id long, key long, n_words long, begins array<int>, ends array<int>, items array<string>"
HITS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()),
     ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b" ".join(data[s:e].tobytes() for s, e in zip(starts, ends))


def _windows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            low = c.LOWER[data]
            starts, ends, doc = c.words(low, offsets, SEP)
            bounds, hashes = c.word_bounds(doc, end - first), c.range_hash(low, starts, ends)
            rows = []
            for i, item in enumerate(b["item"].slice(first, end - first).to_pylist()):
                a, z = bounds[i], bounds[i + 1]
                size = min(n, z - a)
                if size:
                    for k, h in enumerate(c.rolled(hashes[a:z], size).view(np.int64).tolist()):
                        rows.append((size, h, _joined(low, starts[a + k : a + k + size], ends[a + k : a + k + size]), item))
            size, h, text, item = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(size, pa.int32()), pa.array(h, pa.int64()), pa.array(text, pa.binary()), pa.array(item, pa.string())],
                names=["size", "hash", "words", "item"],
            )


class _Set:
    """The windows of one size: sorted hashes, a filter on their low bits, words and items."""

    def __init__(self, hashes: np.ndarray, words: list[bytes], items: list[str]):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.words, self.items = hashes[order], [words[i] for i in order], [items[i] for i in order]
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.hashes & c.U((1 << 22) - 1)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.bits[(hashes & c.U((1 << 22) - 1)).astype(np.int64)])
        place = np.searchsorted(self.hashes, hashes[at])
        return at[self.hashes[np.minimum(place, len(self.hashes) - 1)] == hashes[at]]

    def matched(self, h: int, words: bytes) -> set[str]:
        a, z = np.searchsorted(self.hashes, h), np.searchsorted(self.hashes, h, "right")
        return {self.items[i] for i in range(a, z) if self.words[i] == words}


def _scan(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    sets = [(size, _Set(*parts)) for size, parts in shared.value.items()]
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            low = c.LOWER[data]
            starts, ends, doc = c.words(low, offsets, SEP)
            hashes, bounds = c.range_hash(low, starts, ends), c.word_bounds(doc, end - first)
            found: dict[int, tuple[list[int], list[int], set[str]]] = {}
            for size, known in sets:
                windows = c.rolled(hashes, size)
                for i in known.hits(windows).tolist():
                    d = doc[i]
                    if d == doc[i + size - 1]:
                        items = known.matched(windows[i], _joined(low, starts[i : i + size], ends[i : i + size]))
                        if items:
                            begins, stops, all_items = found.setdefault(d, ([], [], set()))
                            begins.append(int(i - bounds[d]))
                            stops.append(int(i - bounds[d] + size))
                            all_items |= items
            none = ((), (), ())
            rows = [found.get(d, none) for d in range(end - first)]
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"].slice(first, end - first),
                    b["key"].slice(first, end - first),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                    pa.array([sorted(r[2]) for r in rows], pa.list_(pa.string())),
                ],
                schema=HITS_ARROW,
            )


@dataclass(frozen=True)
class Decontaminator:
    """``n``: words of a window; ``share``: a document is contaminated if 1/share of its words is hit."""

    n: int = 13
    share: int = 20
    block: int = 500_000

    def windows(self, benchmark: DataFrame) -> DataFrame:
        rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").filter("item IS NOT NULL")
        return c.in_arrow(rows, partial(_windows, n=self.n), WINDOWS).distinct()

    def _block(self, windows: DataFrame) -> dict:
        table = windows.toArrow()
        sizes, hashes = table["size"].to_numpy(), table["hash"].to_numpy().view(c.U)
        words, items = table["words"].to_pylist(), table["item"].to_pylist()
        out = {}
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            out[size] = (hashes[at], [words[i] for i in at], [items[i] for i in at])
        return out

    def hits(self, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
        """Word ranges and items hit, a row per document."""
        spark = docs.sparkSession
        windows = c.stored(self.windows(benchmark), "windows")
        blocks = max(1, -(-windows.count() // self.block))
        rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("doc_id", "text").alias("key"))
        parts = []
        for i in range(blocks):
            part = windows.filter(F.pmod("hash", F.lit(blocks)) == i)
            shared = spark.sparkContext.broadcast(self._block(part))
            parts.append(c.in_arrow(rows, partial(_scan, shared=shared), HITS))
        if blocks == 1:
            return parts[0]
        tagged = reduce(DataFrame.unionByName, (p.withColumn("block", F.lit(i)) for i, p in enumerate(parts)))
        once = tagged.groupBy("doc_id", "key", "block").agg(
            F.first("n_words").alias("n_words"), F.first("begins").alias("begins"),
            F.first("ends").alias("ends"), F.first("items").alias("items"), F.count("*").alias("copies"),
        )
        united = once.groupBy("doc_id", "key").agg(
            F.max("copies").alias("copies"), F.max("n_words").alias("n_words"),
            *(F.flatten(F.collect_list(n)).alias(n) for n in ("begins", "ends", "items")),
        )
        return united.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
            "doc_id", "key", "n_words", "begins", "ends", F.array_sort(F.array_distinct("items")).alias("items")
        )

    def judged(self, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
        """doc_id, key, n_words, n_hit, items, spans and the verdict, a row per document."""
        covered = F.flatten(F.zip_with("begins", "ends", lambda b, e: F.sequence(b, e - 1)))
        hits = self.hits(docs, benchmark).withColumn("n_hit", F.size(F.array_distinct(covered)).cast("long"))
        rule = (F.col("n_hit") > 0) & (F.col("n_hit") * self.share >= F.col("n_words"))
        return hits.withColumn("contaminated", rule)

    def clean(self, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
        """The documents that are not contaminated, with all of their columns."""
        bad = self.judged(docs, benchmark).filter("contaminated").select(
            F.col("key").alias("__key"), F.col("doc_id").alias("__id")
        ).distinct()
        match = (F.xxhash64("doc_id", "text") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
        return docs.join(bad, match, "left_anti")
