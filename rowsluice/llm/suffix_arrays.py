"""Substring dedup over bytes with longest-previous-factor tests.

A byte string of ``n`` bytes repeats if the longest previous or next factor at its start reaches
n; with suffixes ordered only as far as n bytes, equal strings are one run of the order, and the
previous and next smaller positions of a place are its neighbours in that run sorted by position.

Three steps keep that order small. (1) Strings are brought together by their anchors (see
``anchors``). All strings of one anchor form a block; blocks of equal content are one run for all
of their strings, so a block travels as one hash. (2) Only blocks that meet different blocks with
their anchor are looked at string by string, which is where copies begin, end or differ.
(3) Covered ranges return to their texts. A chunk of documents first settles equal blocks of its
own and sends one of them. Anchors that very many blocks share are told apart by the whole block,
and then by the whole string, so that no group grows with the corpus (``longer_prefixes``).

With ``keep_first`` the first copy of each string, by document and place, stays; without it all
copies go.

Defined cases: a null or empty text has no bytes and loses none; matches never cross documents;
repeated rows are copies of each other and get equal rows, but with ``keep_first`` they count as
one row, and equal ids are told apart by the checksum of their text; a null id is the smallest; an empty table gives no rows;
further columns are ignored.
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
    anchor_of, blob_column, blobs, ids_of, longer_prefixes, LEAST_ID, runs, spread, whole_groups,
)

BLOCK = np.dtype([("doc", "<i8"), ("tag", "<i4"), ("at", "<i4"), ("left", "<u2"), ("count", "<u2"), ("key", "<u8"), ("many", "u1")])
CLOSER = "id long, tag int, begin int, end int, prefix long, left int, wants boolean"


class _Blocks:
    """Blocks of a chunk: lo, hi (first and last string), anchor, prefix, key and document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, n: int, k: int):
        grams = c.window_hash(data, k)
        anchor = anchor_of(grams, n - k + 1)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        at = np.flatnonzero(doc[: len(anchor)] == doc[n - 1 : n - 1 + len(anchor)])
        a = anchor[at]
        first = runs(a, doc[at])
        last = np.append(first[1:], len(at))[: len(first)] - 1
        self.lo, self.hi, self.anchor = at[first], at[last], a[first]
        self.prefix, self.doc = grams[self.anchor], doc[self.lo]
        self.left, self.count = self.anchor - self.lo, self.hi - self.lo + 1
        whole = c.range_hash(data, self.lo, self.hi + n, seed=2)
        self.key = c.mix(whole + (self.left * 1024 + self.count).astype(c.U) * c.U(0x9E3779B97F4A7C15))


def _counted(batches: Iterator[pa.RecordBatch], n: int, k: int) -> Iterator[np.ndarray]:
    for b in batches:
        for _, _, data, offsets in c.chunks(b["text"]):
            if len(data) >= n:
                blocks = _Blocks(data, offsets, n, k)
                yield blocks.prefix[np.unique(np.stack((blocks.prefix, blocks.key)), axis=1, return_index=True)[1]]


def _merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Runs of blocks that follow each other in a document: first and last index."""
    new = np.ones(len(lo), bool)
    if len(lo):
        new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] != hi[:-1] + 1)
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(lo))[: len(first)] - 1


def _send(batches: Iterator[pa.RecordBatch], n: int, k: int, keep_first: bool, hot) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            if len(data) < n:
                continue
            x = _Blocks(data, offsets, n, k)
            if not len(x.lo):
                continue
            ids = ids_of(b["doc_id"].slice(first, end - first))
            tags = b["tag"].slice(first, end - first).to_numpy()
            order = np.lexsort((x.lo - offsets[x.doc], tags[x.doc], ids[x.doc], x.key, x.prefix))
            new = runs(x.prefix[order], x.key[order])
            size = np.diff(np.append(new, len(order)))
            leads = order[new]
            rest = np.ones(len(order), bool)
            rest[leads] = False
            if not keep_first:
                rest[leads[size > 1]] = True
            done = np.flatnonzero(rest)
            f, l = _merged(x.doc[done], x.lo[done], x.hi[done])
            f, l = done[f], done[l]
            block = np.zeros(len(leads), BLOCK)
            block["doc"], block["tag"], block["at"] = ids[x.doc[leads]], tags[x.doc[leads]], x.anchor[leads] - offsets[x.doc[leads]]
            block["left"], block["count"], block["key"], block["many"] = x.left[leads], x.count[leads], x.key[leads], size > 1
            prefix = x.prefix[leads]
            split = hot.known(prefix)
            prefix = np.where(split, c.mix(prefix ^ x.key[leads]), prefix)
            n_open, n_done = len(leads), len(f)
            none = np.zeros(n_open, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((prefix.view(np.int64), c.mix(f.astype(c.U) + c.U(first)).view(np.int64)))),
                    pa.array(np.concatenate((x.prefix[leads].view(np.int64), np.zeros(n_done, np.int64)))),
                    pa.array(np.concatenate((np.where(split, 2, 1), np.zeros(n_done, np.int64))), pa.int8()),
                    blob_column(block.view(np.uint8), np.concatenate((np.full(n_open, BLOCK.itemsize), np.zeros(n_done, np.int64)))),
                    pa.array(np.concatenate((none, ids[x.doc[f]]))),
                    pa.array(np.concatenate((none, tags[x.doc[f]])), pa.int32()),
                    pa.array(np.concatenate((none, x.lo[f] - offsets[x.doc[f]])), pa.int32()),
                    pa.array(np.concatenate((none, x.hi[l] + n - offsets[x.doc[f]])), pa.int32()),
                ],
                names=["key", "prefix", "state", "block", "id", "tag", "begin", "end"],
            )


SENT = "key long, prefix long, state byte, block binary, id long, tag int, begin int, end int"


def _meet(batches: Iterator[pa.RecordBatch], n: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    for b in whole_groups(batches, "key"):
        state = b["state"].to_numpy()
        done = pa.array(np.flatnonzero(state == 0))
        at = np.flatnonzero(state)
        raw, _ = blobs(b["block"].take(pa.array(at)))
        x, group, alone = raw.view(BLOCK), b["key"].to_numpy()[at], state[at] == 2
        order = np.lexsort((x["at"], x["tag"], x["doc"], x["key"], group))
        new = runs(group[order], x["key"][order])
        number = spread(new, len(order))
        size = np.diff(np.append(new, len(order)))[number]
        lead = np.zeros(len(order), bool)
        lead[new] = True
        covered = ~lead if keep_first else (size > 1) | (x["many"][order] > 0)
        g = group[order]
        start = runs(g)
        of = spread(start, len(g))
        mixed = np.bincount(of, lead, len(start))[of] > 1
        closer = lead & (mixed | alone[order])
        wants = closer & ~covered
        closer &= (np.bincount(of, wants, len(start))[of] > 0) | alone[order]
        c_at, l_at = order[covered], order[closer]
        lo = x["at"].astype(np.int64) - x["left"]
        prefix = b["prefix"].to_numpy()[at]
        def column(name, settled, covers, looks, kind):
            return pa.array(np.concatenate((b[name].take(done).to_numpy() if settled is None else np.full(len(done), settled), covers, looks)), kind)
        zero = np.zeros(len(c_at), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                column("id", None, x["doc"][c_at], x["doc"][l_at], pa.int64()),
                column("tag", None, x["tag"][c_at], x["tag"][l_at], pa.int32()),
                column("begin", None, lo[c_at], lo[l_at], pa.int32()),
                column("end", None, lo[c_at] + x["count"][c_at] - 1 + n, lo[l_at] + x["count"][l_at], pa.int32()),
                column("", 0, zero, prefix[l_at], pa.int64()),
                column("", -1, zero - 1, x["left"][l_at], pa.int32()),
                pa.array(np.concatenate((np.zeros(len(done) + len(c_at), bool), wants[closer]))),
            ],
            names=["id", "tag", "begin", "end", "prefix", "left", "wants"],
        )


STRINGS = np.dtype([("doc", "<i8"), ("tag", "<i4"), ("at", "<i4"), ("back", "<u2"), ("wants", "u1")])


def _closer(batches: Iterator[pa.RecordBatch], n: int, hot) -> Iterator[pa.RecordBatch]:
    """A row for each block to be looked at, with the hashes of its strings."""
    for b in batches:
        ids, tags, row = ids_of(b["id"]), b["tag"].to_numpy(), 0
        for first, end, data, offsets in c.chunks(b["text"]):
            part = b.slice(first, end - first)
            looks = part["looks"]
            o = looks.offsets.to_numpy()
            x = looks.flatten()
            doc = np.repeat(np.arange(end - first), np.diff(o))
            begin, stop, left, prefix = (x.field(n_).to_numpy(zero_copy_only=False) for n_ in ("begin", "end", "left", "prefix"))
            wants = x.field("wants").to_numpy(zero_copy_only=False)
            size = (stop - begin).astype(np.int64)
            r = np.repeat(np.arange(len(size)), size)
            back = np.arange(len(r)) - np.repeat(np.cumsum(size) - size, size)
            start = begin[r] + back + offsets[doc[r]]
            h = c.range_hash(data, start, start + n, seed=3)
            head = np.zeros(len(size), STRINGS)
            head["doc"], head["tag"], head["at"] = ids[first:end][doc], tags[first:end][doc], begin
            head["back"], head["wants"] = left, wants
            split = hot.known(prefix.view(c.U))
            # whole blocks by their prefix, or single strings by all of their bytes
            by = [
                (prefix[~split], head[~split], size[~split], h[~split[r]]),
            ]
            s = split[r]
            one = head[r[s]]
            one["at"], one["back"] = one["at"] + back[s], one["back"].astype(np.int64) - back[s] & 0xFFFF
            by.append((c.mix(prefix.view(c.U)[r[s]] ^ h[s]).view(np.int64), one, np.ones(len(one), np.int64), h[s]))
            for key, heads, sizes, hashes in by:
                if len(key):
                    lengths = STRINGS.itemsize + 8 * sizes
                    out = np.zeros(int(lengths.sum()), np.uint8)
                    at = np.cumsum(lengths) - lengths
                    out[(at[:, None] + np.arange(STRINGS.itemsize)).ravel()] = heads.view(np.uint8)
                    q = np.repeat(at + STRINGS.itemsize, sizes) + 8 * (np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
                    out[(q[:, None] + np.arange(8)).ravel()] = hashes.view(np.uint8)
                    yield pa.RecordBatch.from_arrays([pa.array(key), blob_column(out, lengths)], names=["key", "body"])


def _factors(batches: Iterator[pa.RecordBatch], n: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Strings with an earlier (or any other) equal string, by neighbours in the truncated suffix order."""
    for b in whole_groups(batches, "key"):
        data, offsets = blobs(b["body"])
        at, size = offsets[:-1], (np.diff(offsets) - STRINGS.itemsize) // 8
        head = data[(at[:, None] + np.arange(STRINGS.itemsize)).ravel()].view(STRINGS)
        r = np.repeat(np.arange(len(at)), size)
        back = np.arange(len(r)) - np.repeat(np.cumsum(size) - size, size)
        q = np.repeat(at + STRINGS.itemsize, size) + 8 * back
        h = data[(q[:, None] + np.arange(8)).ravel()].view(c.U)
        place = head["at"][r].astype(np.int64) + back
        depth = (head["back"][r].astype(np.int64) - back).astype(c.U)
        order = np.lexsort((place, head["tag"][r], head["doc"][r], h, depth, b["key"].to_numpy()[r]))
        o = r[order]
        new = runs(b["key"].to_numpy()[o], depth[order], h[order])
        lead = np.zeros(len(order), bool)
        lead[new] = True
        size_of = np.diff(np.append(new, len(order)))[spread(new, len(order))]
        hit = (~lead if keep_first else size_of > 1) & (head["wants"][o] > 0)
        found = np.sort(order[hit])
        row, start = r[found], place[found]
        f, l = _merged(row, start, start)
        yield pa.RecordBatch.from_arrays(
            [pa.array(head["doc"][row[f]]), pa.array(head["tag"][row[f]]),
             pa.array(start[f], pa.int32()), pa.array(start[l] + n, pa.int32())],
            names=["id", "tag", "begin", "end"],
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            part = b.slice(first, end - first)
            doc = np.repeat(np.arange(end - first), np.diff(offsets))
            begins, ends = part["begins"], part["ends"]
            counts = begins.value_lengths().fill_null(0).to_numpy()
            of = offsets[np.repeat(np.arange(end - first), counts)]
            gone = c.flags_from_ranges(len(data), begins.flatten().to_numpy() + of, ends.flatten().to_numpy() + of)
            new = gone.copy()
            new[1:] &= ~gone[:-1] | (doc[1:] != doc[:-1])
            kept = data[~gone]
            cuts = np.concatenate(([0], np.cumsum(~gone)))[offsets]
            total = lambda x: np.bincount(doc[x], minlength=end - first)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(np.diff(offsets)), pa.array(total(gone)), pa.array(total(new)),
                 blob_column(kept, np.diff(cuts))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _cut(batches):
        digest = pa.array([hashlib.sha256(k).hexdigest() for k in b["kept"].to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns[:4], digest], names=[*b.schema.names[:4], "kept_sha256"])


@dataclass(frozen=True)
class FactorDedup:
    """``n``: bytes of a string; ``k``: bytes of a prefix; ``keep_first``: let the first copy stay."""

    n: int = 200
    k: int = 64
    keep_first: bool = True

    def repeats(self, docs: DataFrame) -> DataFrame:
        """id, tag, begin, end: byte ranges to remove (tag: checksum of the text)."""
        rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tag", F.hash("text"))
        if self.keep_first:
            rows = rows.dropDuplicates(["doc_id", "text"])
        hot = longer_prefixes(rows, partial(_counted, n=self.n, k=self.k))
        sent = rows.mapInArrow(partial(_send, n=self.n, k=self.k, keep_first=self.keep_first, hot=hot), SENT)
        grouped = sent.repartition("key").sortWithinPartitions("key")
        met = c.stored(grouped.mapInArrow(partial(_meet, n=self.n, keep_first=self.keep_first), CLOSER), "blocks")
        looks = met.filter("left >= 0").groupBy("id", "tag").agg(
            F.collect_set(F.struct("begin", "end", "prefix", "left", "wants")).alias("looks")
        )
        texts = rows.select(F.coalesce("doc_id", F.lit(LEAST_ID)).alias("id"), "tag", "text").dropDuplicates(["id", "tag"])
        strings = texts.join(looks, ["id", "tag"]).mapInArrow(partial(_closer, n=self.n, hot=hot), "key long, body binary")
        strings = strings.repartition("key").sortWithinPartitions("key")
        found = c.stored(
            strings.mapInArrow(partial(_factors, n=self.n, keep_first=self.keep_first), "id long, tag int, begin int, end int"),
            "strings",
        )
        return met.filter("left < 0").select("id", "tag", "begin", "end").unionByName(found)

    def _joined(self, docs: DataFrame) -> DataFrame:
        ranges = self.repeats(docs).groupBy("id", "tag").agg(
            F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")
        )
        rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        match = (F.coalesce("doc_id", F.lit(LEAST_ID)) == F.col("id")) & (F.hash("text") == F.col("tag"))
        return rows.join(ranges, match, "left").select("doc_id", "text", "begins", "ends")

    def removed(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans and the bytes kept."""
        return self._joined(docs).mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")

    def digested(self, docs: DataFrame) -> DataFrame:
        """As ``removed``, with the SHA-256 of what is kept instead of the bytes."""
        schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        return self._joined(docs).mapInArrow(_digested, schema)
