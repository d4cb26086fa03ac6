"""Anchors: the places at which equal windows of symbols are brought together.

The anchor of a window is its k-gram with the smallest hash, the leftmost of equals. Equal
windows have equal anchors at equal places, so sending anchors instead of every suffix brings
all equal windows to one group, at two in each w + 1 places for windows of w k-grams.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsluice.llm.common import U, in_arrow, sliding_min

LEAST_ID = -(1 << 63)


def ids_of(column: pa.Array) -> np.ndarray:
    """Document ids; null is the smallest."""
    return column.fill_null(LEAST_ID).to_numpy(zero_copy_only=False)


class Listed:
    """A broadcast list of hashes."""

    def __init__(self, shared):
        self.shared = shared

    def known(self, hashes: np.ndarray) -> np.ndarray:
        listed = self.shared.value
        if not len(listed):
            return np.zeros(len(hashes), bool)
        return listed[np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)] == hashes


def _counts(batches: Iterator[pa.RecordBatch], sent: Callable, least: int) -> Iterator[pa.RecordBatch]:
    # the prefixes of a task are sorted in place: np.unique would hold some four more copies of them
    prefix = np.concatenate([*sent(batches), np.zeros(0, U)])
    prefix.sort()
    some = prefix[: max(0, len(prefix) - least + 1)] == prefix[least - 1 :]
    some[1:] &= prefix[1 : len(some)] != prefix[: max(0, len(some) - 1)]
    first = np.flatnonzero(some)
    n = np.searchsorted(prefix, prefix[first], "right") - first
    yield pa.RecordBatch.from_arrays([pa.array(prefix[first].view(np.int64)), pa.array(n)], names=["prefix", "n"])


def longer_prefixes(rows: DataFrame, sent: Callable, most: int = 5_000, listed: int = 1_000_000, least: int = 2) -> Listed:
    """Prefixes whose groups would have more than ``most`` rows, so that they need a longer prefix.

    The list is broadcast; its ``listed`` longest entries bound it to 8 MB, and any prefix beyond it
    has less than one in ``listed`` of all rows. Tasks report what they would send ``least`` times.
    """
    counts = in_arrow(rows, partial(_counts, sent=sent, least=least), "prefix long, n long")
    hot = counts.groupBy("prefix").agg(F.sum("n").alias("n")).filter(F.col("n") > most)
    found = hot.orderBy(F.desc("n"), "prefix").limit(listed).select("prefix").toArrow()
    values = np.sort(found["prefix"].to_numpy().view(U))
    return Listed(rows.sparkSession.sparkContext.broadcast(values))


def anchor_of(grams: np.ndarray, w: int) -> np.ndarray:
    """Place of the smallest of each w consecutive k-gram hashes."""
    ranked = (grams & ~U(0xFFFFFFFF)) | np.arange(len(grams), dtype=U)
    return (sliding_min(ranked, w) & U(0xFFFFFFFF)).astype(np.int64)


def runs(*keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal values in all keys, which are sorted or grouped."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def spread(first: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the number of its run."""
    mark = np.zeros(n, np.int64)  # the first run has number 0
    mark[first[1:]] = 1
    return np.cumsum(mark)


def blob_column(records: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column whose values are consecutive pieces of a byte array."""
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(records)])


def blobs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column."""
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows cut anew so that equal keys stay together."""
    kept: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        k = b[key].to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
        if last or (kept and kept[-1][key][-1].as_py() != k[-1]):
            kept.append(b.slice(0, last))
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
            kept = []
        kept.append(b.slice(last))
    if kept:
        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
