"""Alignment of two tokenizers over the same bytes, by divide and conquer at shared cuts.

A byte offset where a token of A and one of B both end is a cut. All intervals of a chunk of
documents are halved together: from the middle of each, bisecting A's and B's ends in turn leads to
the nearest cut on either side. What lies between these two has no cut and is a leaf group; both
outer parts, each at most half as long, are halved again. Every token is passed over once.

Links are counted without making all pairs of a group: equal ids of a group are taken together
first. Texts are encoded once, in units of about ``UNIT`` characters; a unit is one row with the
distinct id pairs of its documents, how many of these have each, and each document's pairs as
places in that list. Only these distinct pairs are counted across the corpus; their counts go
back to the units by the units' numbers.

Defined cases: a text that is null, empty, or not spelled exactly by the tokens of both sides (such as
one with U+2581) has no tokens; special tokens in a text are plain text; repeated rows count as documents
each; a null doc_id is kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rowsluice.llm import common as c
from rowsluice.llm.common import stored
from rowsluice.llm.pieces import BYTE, NORMAL, PART, SPACE, Model, decimals, encoder as piece_encoder, portions, texts_of
from rowsluice.llm.tokens import CUT, Encoder

#: Characters of the texts of a unit, and of those that are aligned together.
UNIT, STEP = 4 << 20, 1 << 19
#: Id pairs expanded at once, and characters of words known to a worker's encoder of A.
PAIRS, KNOWN_CHARS = 1 << 20, 6_000_000
COMMA, BAR, SEMICOLON = (ord(x) for x in ",|;")
UNITS = (
    "unit long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "digests array<string>, sizes array<long>, places binary, times binary, codes array<long>, n_docs array<long>"
)
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The byte of each character in byte-level vocabularies: printable ones stand for themselves,
    the others for the code points from 256 on, in order."""
    shown = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bytes:
    """The bytes of each id of a vocabulary."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        total = np.cumsum(sizes)
        return self.data[np.repeat(self.starts[ids] - (total - sizes), sizes) + np.arange(total[-1] if len(ids) else 0)]


class ByteSide:
    """Tokens of space + text by a byte-level BPE."""

    def __init__(self, path: str):
        self.tool = Encoder(path, known_chars=KNOWN_CHARS)
        known, alphabet = self.tool.tokenizer.get_vocab(), byte_alphabet()
        entries = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            entries[i] = bytes(alphabet[ch] for ch in token) if all(ch in alphabet for ch in token) else b""
        self.bytes, self.n = Bytes(entries), len(entries)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """A space before a word is no place for a merge, so words are looked up, and long texts go in parts."""
        parts = [list(portions(t, CUT)) for t in texts]
        n_parts, parts = [len(p) for p in parts], list(chain.from_iterable(parts))
        out, at = [], 0
        while at < len(parts):
            size, end = 0, at
            while end < len(parts) and size <= PART:
                size += len(parts[end])
                end += 1
            ids, sizes = self.tool.ids_of([" " + p for p in parts[at:end]])
            out += np.split(ids.astype(np.int64), np.cumsum(sizes)[:-1])
            at = end
        if len(parts) == len(texts):
            return out
        ends = np.cumsum(n_parts).tolist()
        return [np.concatenate([np.zeros(0, np.int64), *out[e - n : e]]) for e, n in zip(ends, n_parts)]


class PieceSide:
    """Tokens of a text by a SentencePiece BPE, which puts the space before it itself."""

    def __init__(self, path: str):
        model: Model = piece_encoder(path).model
        entries = [p.replace(SPACE, " ").encode() if k == NORMAL else b"" for p, k in zip(model.pieces, model.types.tolist())]
        for i in np.flatnonzero(model.types == BYTE).tolist():
            entries[i] = bytes([int(model.pieces[i][3:5], 16)])
        self.bytes, self.n, self.path = Bytes(entries), len(entries), path

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [ids.astype(np.int64) for ids in piece_encoder(self.path).encode(texts)]


def cuts(ends_a: np.ndarray, ends_b: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """All shared ends. ``edges``: 0 and the end of each document, itself a shared end of both sides.

    Intervals are kept in order, so that neighbouring bisections walk the same memory.
    """
    from_a, from_b = np.append(0, ends_a), np.append(0, ends_b)  # with each document's start
    places = np.searchsorted(from_a, edges)
    low, high = places[:-1], places[1:]
    found = [places[1:]]
    wide = high - low > 1
    low, high = low[wide], high[wide]
    while len(low):
        left = (low + high) // 2
        right = left.copy()
        active, b = np.arange(len(low)), from_b[np.searchsorted(from_b, from_a[right])]
        while len(active := active[(missed := b != from_a[right[active]])]):  # the nearest cut from the middle on
            right[active] = np.searchsorted(from_a, b[missed])
            b = from_b[np.searchsorted(from_b, from_a[right[active]])]
        active = np.flatnonzero(right != left)
        b = from_b[np.searchsorted(from_b, from_a[left[active]], "right") - 1]
        while len(active := active[(missed := b != from_a[left[active]])]):  # and before it
            left[active] = np.searchsorted(from_a, b[missed], "right") - 1
            b = from_b[np.searchsorted(from_b, from_a[left[active]], "right") - 1]
        found += [left[left > low], right[(right < high) & (right != left)]]
        low, high = np.column_stack((low, right)).ravel(), np.column_stack((left, high)).ravel()
        wide = high - low > 1
        low, high = low[wide], high[wide]
    return from_a[np.sort(np.concatenate(found))]


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.diff(first, append=len(keys))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(values, first) if len(first) else values[:0]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.span = self.a.n * self.b.n

    def aligned(self, texts: list[str]) -> dict:
        """Counts, digests and linked id pairs of each text.

        ``pairs`` are keys of text and pair (text * span + a * n_b + b) in order, ``times`` the links
        of each.
        """
        a, b = self.a.encode(texts), self.b.encode(texts)
        for i, text in enumerate(texts):
            want = np.frombuffer(b" " + text.encode(), np.uint8)
            same = text and all(np.array_equal(side.bytes.joined(x[i]), want) for side, x in ((self.a, a), (self.b, b)))
            if not same:
                a[i] = b[i] = np.zeros(0, np.int64)
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        ids_a, ids_b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (a, b))
        ends_a, ends_b = np.cumsum(self.a.bytes.sizes[ids_a]), np.cumsum(self.b.bytes.sizes[ids_b])
        last_a = np.append(0, ends_a)[np.cumsum(n_a)]
        edges = np.append(0, last_a[n_a > 0])
        shared = cuts(ends_a, ends_b, edges) if len(ids_a) else np.zeros(0, np.int64)
        text_of = np.flatnonzero(n_a > 0)[np.searchsorted(edges[1:], shared)] if len(shared) else np.zeros(0, np.int64)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        sizes_a, sizes_b = (np.bincount(g, minlength=len(shared)).astype(np.int64) for g in (group_a, group_b))
        n_links = np.zeros(len(texts), np.int64)
        np.add.at(n_links, text_of, sizes_a * sizes_b)
        pairs, times = self._pairs(group_a, ids_a, group_b, ids_b, text_of)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text_of, minlength=len(texts)), "n_links": n_links,
            "digests": self._digests(group_a, ids_a, group_b, ids_b, np.bincount(text_of, minlength=len(texts))),
            "pairs": pairs, "times": times,
        }

    def _pairs(self, group_a, ids_a, group_b, ids_b, text_of) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked pairs of each text and the number of their links."""
        key_a, times_a = _grouped(group_a * self.a.n + ids_a)
        key_b, times_b = _grouped(group_b * self.b.n + ids_b)
        of_a = key_a // self.a.n
        groups = np.arange(len(text_of) + 1)
        starts_b = np.searchsorted(key_b // self.b.n, groups)
        per_a = starts_b[of_a + 1] - starts_b[of_a]  # distinct ids of B that each distinct id of A meets
        total, kept = np.cumsum(per_a), []
        at = 0
        while at < len(key_a):
            done = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, done + PAIRS, "right")))
            n = per_a[at:end]
            row = np.repeat(np.arange(at, end), n)
            other = np.repeat(starts_b[of_a[at:end]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            code = (key_a[row] % self.a.n) * self.b.n + key_b[other] % self.b.n
            kept.append(_summed(text_of[of_a[row]] * self.span + code, times_a[row] * times_b[other]))
            at = end
        if not kept:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return kept[0] if len(kept) == 1 else _summed(*(np.concatenate(x) for x in zip(*kept)))

    def _digests(self, group_a, ids_a, group_b, ids_b, n_groups) -> list[str]:
        """SHA-256 of each text's groups, ``a1,a2|b1;a3|b2,b3``; empty without groups."""
        closes_a, closes_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (group_a, group_b))
        order = np.argsort(np.concatenate((group_a * 2, group_b * 2 + 1)), kind="stable")
        marks = np.concatenate((np.where(closes_a, BAR, COMMA), np.where(closes_b, SEMICOLON, COMMA))).astype(np.uint8)[order]
        ids = np.concatenate((ids_a, ids_b))[order]
        groups = np.concatenate((group_a, group_b))[order]
        table = decimals(max(self.a.n, self.b.n))
        ends_of_text = np.searchsorted(groups, np.cumsum(n_groups))
        out, at = [], 0
        for end in ends_of_text.tolist():
            h = hashlib.sha256()
            for start in range(at, end, 1 << 20):
                stop = min(start + (1 << 20), end)
                part = table.text(ids[start:stop], marks[start:stop])
                h.update(part if stop < end else part[:-1])
            out.append(h.hexdigest() if end > at else "")
            at = end
        return out


def aligner(path_a: str, path_b: str) -> Aligner:
    return c.once(f"aligner {path_a} {path_b}", lambda: Aligner(path_a, path_b))


def _units(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    tool = aligner(path_a, path_b)
    task, number = TaskContext.get().partitionId(), 0
    kept, size = [], 0

    def row():
        doc_ids = [i for ids, _ in kept for i in ids]
        texts, pairs, times, before = [], [], [], 0
        for ids, found in kept:
            texts.append(found["pairs"] // tool.span + before)
            pairs.append(found["pairs"] % tool.span)
            times.append(found["times"])
            before += len(ids)
        codes, places = np.unique(np.concatenate(pairs), return_inverse=True)
        joined = lambda name: np.concatenate([f[name] for _, f in kept])
        fields = {
            "unit": task << 32 | number, "doc_ids": doc_ids, **{n: joined(n) for n in ("n_a", "n_b", "n_groups", "n_links")},
            "digests": [d for _, f in kept for d in f["digests"]], "sizes": np.bincount(np.concatenate(texts), minlength=before),
            "places": places.astype("<u4").tobytes(), "times": np.concatenate(times).astype("<u8").tobytes(),
            "codes": codes, "n_docs": np.bincount(places, minlength=len(codes)),
        }
        return pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) if k == "unit" else pa.array([v], pa.binary()) if isinstance(v, bytes)
             else pa.array([v], pa.list_(pa.string() if k == "digests" else pa.int64())) for k, v in fields.items()],
            names=list(fields),
        )

    for b in batches:
        texts = texts_of(b["text"])
        sizes = np.cumsum([len(t) for t in texts])
        first = 0
        while first < len(texts):  # whole texts, about STEP characters of them
            done = sizes[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(sizes, done + STEP, "right")))
            kept.append((b["doc_id"].slice(first, end - first).to_pylist(), tool.aligned(texts[first:end])))
            size += int(sizes[end - 1] - done)
            first = end
            if size >= UNIT:
                yield row()
                kept, size, number = [], 0, number + 1
    if kept:
        yield row()


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            value = lambda name: b[name][i]  # noqa: E731, B023
            numbers = lambda name: value(name).values.to_numpy(zero_copy_only=False)  # noqa: E731, B023
            sizes, doc_ids = numbers("sizes"), value("doc_ids").values
            places, times = np.frombuffer(value("places").as_py(), "<u4"), np.frombuffer(value("times").as_py(), "<u8").astype(np.int64)
            counts, best = np.zeros(0, np.int64), np.zeros(0, bool)
            if value("looked").is_valid:
                looked = value("looked").values
                counts, best = (looked.field(k).to_numpy(zero_copy_only=False) for k in ("n", "best"))
            ends = np.append(0, np.cumsum(sizes))
            total = lambda x: np.diff(np.append(0, np.cumsum(x))[ends])  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [doc_ids, *(value(n).values for n in ("n_a", "n_b", "n_groups", "n_links")),
                 pa.array(total(times * best[places])), pa.array(total(times * counts[places])), value("digests").values],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


@dataclass(frozen=True)
class TokenAligner:
    """``tokenizer``: a byte-level BPE file (A); ``model``: a SentencePiece BPE file (B)."""

    tokenizer: str
    model: str

    @property
    def n_b(self) -> int:
        return len(Model(self.model).pieces)

    def units(self, docs: DataFrame) -> DataFrame:
        """One row for about ``UNIT`` bytes of text; written once, as two plans read it."""
        rows = docs.select(F.col("doc_id").cast("long"), "text")
        return stored(rows.mapInArrow(partial(_units, path_a=self.tokenizer, path_b=self.model), UNITS), "alignments")

    def _entries(self, units: DataFrame) -> DataFrame:
        found = units.select("unit", F.posexplode(F.arrays_zip("codes", "n_docs")).alias("place", "x"))
        return found.select("unit", "place", F.col("x.codes").alias("code"), F.col("x.n_docs").alias("n"))

    def _counted(self, units: DataFrame) -> DataFrame:
        """code, n (documents with the pair) and best (the highest n of its id of A)."""
        counts = self._entries(units).groupBy("code").agg(F.sum("n").alias("n"))
        counts = counts.withColumn("a", F.floor(F.col("code") / self.n_b).cast("int"))
        highest = counts.groupBy("a").agg(F.max("n").alias("highest"))  # at most a row per id of A
        return counts.join(F.broadcast(highest), "a").select("code", "n", (F.col("n") == F.col("highest")).alias("best"))

    def translations(self, docs: DataFrame) -> DataFrame:
        """a, b, n_docs and best of every linked pair of ids."""
        counted = self._counted(self.units(docs))
        b = F.pmod("code", F.lit(self.n_b)).cast("int")
        return counted.select(F.floor(F.col("code") / self.n_b).cast("int").alias("a"), b.alias("b"), F.col("n").alias("n_docs"), "best")

    def aligned(self, docs: DataFrame) -> DataFrame:
        """Counts, links and the groups' digest of each document."""
        units = self.units(docs)
        looked = (
            self._entries(units).select("unit", "place", "code").join(self._counted(units), "code")
            .groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("place", "n", "best"))).alias("looked"))
        )
        return units.drop("codes", "n_docs").join(looked, "unit", "left").mapInArrow(_scored, ALIGNED)
