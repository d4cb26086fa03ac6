"""Token ids as Simple-8b words: a file format, its writer and its reader.

A 64-bit little-endian word has a selector in its top four bits and 60 bits of ids below it,
the first id lowest. Selector 0 is an escape: the next word is one raw id of any size.

A file is a Parquet table of blocks in ascending document order, so that Spark commits, finds
and splits it like any other table: ``part`` and ``block`` order the blocks, ``before`` is the
number of ids in earlier blocks of the part, ``doc_ids`` and ``counts`` list the documents,
``offsets`` the first word of each, ``words`` the packed bytes. A document starts a new word, so
any one can be decoded alone, and a block is decoded in one pass per selector.

Defined cases: a null or empty text has the end id only; a null doc_id sorts first; repeated
rows are written once each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rowsluice.llm.common import U
from rowsluice.llm.tokens import encoded
from rowsluice.session import scratch_path

# Fixed values of the published scheme: ids per word, and bits per id, for selectors 1 to 14.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
BLOCK_IDS = 1 << 18
#: Characters of known words a worker keeps; blocks leave more memory than other users of the encoder have.
KNOWN_CHARS = 40_000_000
BLOCKS = (
    "part int, block int, before long, n_ids long, doc_ids array<long>, counts array<long>, "
    "offsets array<long>, words binary"
)


def _longest(x: np.ndarray, k: int, doubled: dict[int, np.ndarray]) -> np.ndarray:
    """Maximum of each k values; places past the end count as too large."""
    span = 1 << k.bit_length() - 1
    if span not in doubled:
        half = _longest(x, span // 2, doubled)
        doubled[span] = np.maximum(half, np.concatenate((half[span // 2 :], np.full(min(span // 2, len(half)), 255, np.uint8))))
    full, rest = doubled[span], k - span
    return np.maximum(full, np.concatenate((full[rest:], np.full(min(rest, len(full)), 255, np.uint8)))) if rest else full


def pack(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of consecutive documents of ``counts`` ids, and the first word of each document."""
    ids = ids.astype(U)
    n, ends = len(ids), np.cumsum(counts)
    if not n:
        return np.zeros(0, U), np.zeros(len(counts), np.int64)
    bits = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    left = np.minimum(np.repeat(ends, counts) - np.arange(n), 255).astype(np.uint8)
    selector, doubled = np.zeros(n, np.uint8), {1: bits}
    for s in range(len(COUNTS), 0, -1):
        fits = (_longest(bits, COUNTS[s - 1], doubled) <= BITS[s - 1]) & (left >= COUNTS[s - 1])
        selector[fits] = s
    step = np.array((1, *COUNTS), np.uint8)[selector].tolist()
    at, i = [], 0
    while i < n:
        at.append(i)
        i += step[i]
    at = np.array(at)
    chosen = selector[at]
    words = chosen.astype(U) << U(60)
    for s in np.unique(chosen).tolist():
        if s:
            rows = np.flatnonzero(chosen == s)
            k, b = COUNTS[s - 1], BITS[s - 1]
            for j in range(k):
                words[rows] |= ids[at[rows] + j] << U(b * j)
    first = np.searchsorted(at, ends - counts)
    raw = np.flatnonzero(chosen == 0)
    if len(raw):
        first = first + np.searchsorted(raw, first)
        words = np.insert(words, raw + 1, ids[at[raw]])
    return words, first


def unpack(words: np.ndarray) -> np.ndarray:
    """All ids of whole documents' words."""
    selector = (words >> U(60)).astype(np.int64)
    raw = []
    for i in np.flatnonzero(selector == 0).tolist():
        if not raw or raw[-1] != i:
            raw.append(i + 1)
    values = words
    if raw:
        values = np.delete(words, np.array(raw) - 1)
        selector = np.delete(selector, np.array(raw) - 1)
        selector[np.array(raw) - 1 - np.arange(len(raw))] = 0
    sizes = np.array((1, *COUNTS, 0))[selector]
    place = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), U)
    for s in np.unique(selector).tolist():
        rows = np.flatnonzero(selector == s)
        if s == 0:
            out[place[rows]] = values[rows]
            continue
        k, b = COUNTS[s - 1], BITS[s - 1]
        for j in range(k):
            out[place[rows] + j] = values[rows] >> U(b * j) & U((1 << b) - 1)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    part, block, before = TaskContext.get().partitionId(), 0, 0
    kept: list[tuple] = []

    def cut():
        ids, counts = np.concatenate([k[1] for k in kept]), np.concatenate([k[2] for k in kept])
        words, first = pack(ids, counts)
        return pa.RecordBatch.from_pylist(
            [{"part": part, "block": block, "before": before, "n_ids": len(ids), "doc_ids": [d for k in kept for d in k[0]],
              "counts": counts, "offsets": first, "words": words.astype("<u8").tobytes()}],
            schema=pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
                              ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                              ("offsets", pa.list_(pa.int64())), ("words", pa.binary())]),
        )

    for b in batches:
        for first, end, ids, counts in encoded(b["text"], path, KNOWN_CHARS):
            kept.append((b["doc_id"].slice(first, end - first).to_pylist(), ids, counts))
            size = sum(len(k[1]) for k in kept)
            if size >= BLOCK_IDS:
                yield cut()
                kept, block, before = [], block + 1, before + size
    if kept:
        yield cut()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            ids = unpack(np.frombuffer(row["words"], "<u8")).astype("<u4")
            counts = np.array(row["counts"], np.int64)
            ends = np.cumsum(counts)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


@dataclass(frozen=True)
class TokenFiles:
    tokenizer: str

    def write(self, docs: DataFrame, path: str) -> None:
        """Encode all documents and write their ids in ascending doc_id order."""
        rows = docs.select(F.col("doc_id").cast("long"), "text")
        ordered = rows.repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"))
        ordered.mapInArrow(partial(_blocks, path=self.tokenizer), BLOCKS).write.option("compression", "zstd").parquet(path)

    def read(self, docs_spark, path: str) -> DataFrame:
        """doc_id, start, n_tokens and checksum of each document, from the files."""
        blocks = docs_spark.read.schema(BLOCKS).parquet(path)
        parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row per task that wrote
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        return (
            blocks.join(F.broadcast(bases), "part")
            .select("doc_ids", "counts", "words", (F.col("base") + F.col("before")).alias("start"))
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
        )

    def round_trip(self, docs: DataFrame) -> DataFrame:
        path = scratch_path(docs.sparkSession, "token-files")
        self.write(docs, path)
        return self.read(docs.sparkSession, path)
