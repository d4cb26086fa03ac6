"""Substring dedup with prefix-partitioned suffix trees.

The suffixes of all texts, as sequences of words, are partitioned by prefix. Only suffixes that
start at an anchor are sent (see ``anchors``), each with the depth-``n`` paths of the windows
that the anchor stands for; every window of n words has exactly one anchor, so no window is
lost. Suffixes with one prefix meet sorted in one task, whose subtree's nodes at depth n are the
classes of equal windows; runs of covered windows are the maximal repeats.

A chunk of documents first settles its own windows: only the document with the smallest id that
has a window sends it. However often a window occurs, its group has a row per chunk at most. Prefixes
have k words, but n where k words would not part the suffixes into groups that fit a task.

Defined cases: a null or empty text has no words; texts with fewer than n words lose nothing; of
equal ids none is smaller, so repeated rows remove nothing from each other and get equal rows; a
null id is smaller than all others; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsluice.llm import common as c
from rowsluice.llm.anchors import (
    LEAST_ID, anchor_of, blob_column, blobs, ids_of, longer_prefixes, runs, spread, whole_groups,
)

HEAD = np.dtype([("doc", "<i8"), ("tag", "<i4"), ("at", "<i4")])
NODE = np.dtype([("back", "u1"), ("low", "<u4"), ("high", "<u2")])
SETTLED = np.dtype([("doc", "<i8"), ("tag", "<i4"), ("begin", "<i4"), ("end", "<i4")])


def _ranges(key: np.ndarray, at: np.ndarray, n: int):
    """Runs of consecutive windows with one key: index of the first, and the end of the last."""
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    return first, at[last] + n


class _Windows:
    """Words of a chunk, the paths of their windows, and which of these are settled or open."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, n: int, k: int):
        starts, ends, self.doc = c.words(data, offsets, c.separators("spaces"))
        doc = self.doc
        h = c.range_hash(data, starts, ends)
        self.grams, self.paths = c.rolled(h, k), c.rolled(h, n)
        self.anchor = anchor_of(self.grams, n - k + 1)
        self.place = np.arange(len(doc)) - np.searchsorted(doc, np.arange(len(offsets)))[doc]
        window = np.flatnonzero(doc[: len(self.paths)] == doc[n - 1 : n - 1 + len(self.paths)])
        # the smallest id with each window
        order = window[np.lexsort((ids[doc[window]], self.paths[window]))]
        new = runs(self.paths[order])
        least = ids[doc[order[new]]][spread(new, len(order))]
        later = ids[doc[order]] > least
        self.covered, self.opened = np.sort(order[later]), np.sort(order[~later])


def _counted(batches: Iterator[pa.RecordBatch], n: int, k: int) -> Iterator[np.ndarray]:
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            x = _Windows(data, offsets, ids_of(b["doc_id"].slice(first, end - first)), n, k)
            yield x.grams[np.unique(x.anchor[x.opened])]


def _suffixes(batches: Iterator[pa.RecordBatch], n: int, k: int, hot) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            ids = ids_of(b["doc_id"].slice(first, end - first))
            tags = b["tag"].slice(first, end - first).to_numpy()
            x = _Windows(data, offsets, ids, n, k)
            doc, place, grams, paths, covered, opened = x.doc, x.place, x.grams, x.paths, x.covered, x.opened
            # settled here
            r, stop = _ranges(doc[covered], place[covered], n)
            settled = np.zeros(len(r), SETTLED)
            settled["doc"], settled["tag"] = ids[doc[covered[r]]], tags[doc[covered[r]]]
            settled["begin"], settled["end"] = place[covered[r]], stop
            # a row for each anchor and its open windows, or for each window of a longer prefix
            a = x.anchor[opened]
            split = hot.known(grams[a])
            r = runs(a, np.where(split, opened, -1))
            prefix = np.where(split, c.mix(grams[a] ^ paths[opened]), grams[a])[r]
            size = np.diff(np.append(r, len(a)))
            head = np.zeros(len(r), HEAD)
            head["doc"], head["tag"], head["at"] = ids[doc[a[r]]], tags[doc[a[r]]], place[a[r]]
            node = np.zeros(len(a), NODE)
            node["back"], node["low"] = a - opened, (paths[opened] & c.U(0xFFFFFFFF)).astype(np.uint32)
            node["high"] = (paths[opened] >> c.U(48)).astype(np.uint16)
            lengths = HEAD.itemsize + NODE.itemsize * size
            out = np.zeros(int(lengths.sum()), np.uint8)
            begin = np.cumsum(lengths) - lengths
            out[(begin[:, None] + np.arange(HEAD.itemsize)).ravel()] = head.view(np.uint8)
            node_at = np.repeat(begin + HEAD.itemsize, size) + NODE.itemsize * (np.arange(len(a)) - np.repeat(r, size))
            out[(node_at[:, None] + np.arange(NODE.itemsize)).ravel()] = node.view(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((prefix.view(np.int64), c.mix(settled["doc"].astype(c.U)).view(np.int64)))),
                    pa.array(np.concatenate((np.ones(len(r), bool), np.zeros(len(settled), bool)))),
                    blob_column(
                        np.concatenate((out, settled.view(np.uint8))),
                        np.concatenate((lengths, np.full(len(settled), SETTLED.itemsize))),
                    ),
                ],
                names=["prefix", "open", "body"],
            )


def _subtrees(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in whole_groups(batches, "prefix"):
        opened = b["open"].to_numpy(zero_copy_only=False)
        data, offsets = blobs(b["body"])
        prefix = b["prefix"].to_numpy()
        done = offsets[:-1][~opened]
        settled = data[(done[:, None] + np.arange(SETTLED.itemsize)).ravel()].view(SETTLED)
        at, size = offsets[:-1][opened], (np.diff(offsets)[opened] - HEAD.itemsize) // NODE.itemsize
        head = data[(at[:, None] + np.arange(HEAD.itemsize)).ravel()].view(HEAD)
        row = np.repeat(np.arange(len(at)), size)
        node_at = np.repeat(at + HEAD.itemsize, size) + NODE.itemsize * (np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size))
        node = data[(node_at[:, None] + np.arange(NODE.itemsize)).ravel()].view(NODE)
        key = node["low"].astype(c.U) << c.U(24) | node["high"].astype(c.U) << c.U(8) | node["back"].astype(c.U)
        group, doc = prefix[opened][row], head["doc"][row]
        order = np.lexsort((doc, key, group))
        new = runs(group[order], key[order])
        least = doc[order[new]][spread(new, len(order))]
        hit = np.sort(order[doc[order] > least])
        start = head["at"][row[hit]] - node["back"][hit]
        r, stop = _ranges(row[hit], start, n)
        found = head[row[hit[r]]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((found["doc"], settled["doc"]))),
                pa.array(np.concatenate((found["tag"], settled["tag"]))),
                pa.array(np.concatenate((start[r], settled["begin"])), pa.int32()),
                pa.array(np.concatenate((stop, settled["end"])), pa.int32()),
            ],
            names=["id", "tag", "begin", "end"],
        )


SPACES = bytes(32 if 9 <= i <= 13 else i for i in range(256))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        columns = (b[n].to_pylist() for n in ("doc_id", "text", "begins", "ends"))
        rows = []
        for doc_id, text, begins, ends in zip(*columns):
            words = [w for w in (text or "").encode().translate(SPACES).split(b" ") if w]
            gone = c.flags_from_ranges(len(words), np.array(begins, np.int64), np.array(ends, np.int64)) if begins else None
            kept = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
            rows.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _removed(batches):
        digest = pa.array([hashlib.sha256(k).hexdigest() for k in b["kept"].to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns[:3], digest], names=[*b.schema.names[:3], "kept_sha256"])


@dataclass(frozen=True)
class SubstringDedup:
    """``n``: words of a window; ``k``: words of a prefix."""

    n: int = 13
    k: int = 5

    def repeats(self, docs: DataFrame) -> DataFrame:
        """id, tag, begin, end: word ranges that an earlier document has too (tag: checksum of the text)."""
        rows = docs.select(F.col("doc_id").cast("long"), "text", F.hash("text").alias("tag"))
        hot = longer_prefixes(rows, partial(_counted, n=self.n, k=self.k))
        suffixes = rows.mapInArrow(partial(_suffixes, n=self.n, k=self.k, hot=hot), "prefix long, open boolean, body binary")
        grouped = suffixes.repartition("prefix").sortWithinPartitions("prefix")
        return c.stored(grouped.mapInArrow(partial(_subtrees, n=self.n), "id long, tag int, begin int, end int"), "repeats")

    def _joined(self, docs: DataFrame) -> DataFrame:
        """Each document with its ranges."""
        ranges = self.repeats(docs).groupBy("id", "tag").agg(
            F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")
        )
        rows = docs.select(F.col("doc_id").cast("long"), "text")
        match = (F.coalesce("doc_id", F.lit(LEAST_ID)) == F.col("id")) & (F.hash("text") == F.col("tag"))
        return rows.join(ranges, match, "left").select("doc_id", "text", "begins", "ends")

    def removed(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_words, n_removed and the kept words as UTF-8, joined by spaces."""
        return self._joined(docs).mapInArrow(_removed, "doc_id long, n_words long, n_removed long, kept binary")

    def digested(self, docs: DataFrame) -> DataFrame:
        """As ``removed``, with the SHA-256 of what is kept instead of the bytes."""
        schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
        return self._joined(docs).mapInArrow(_digested, schema)
