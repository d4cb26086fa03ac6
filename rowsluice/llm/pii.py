"""Personal data by fixed forms and bootstrapped contexts.

Addresses, IPs, cards and phone numbers of fixed form are the seeds. Each seed induces two
lexical patterns: the two words before it, and the words before and after it. Patterns that
hold several different seeds are looked up in every text; their other fillers that could be
identifiers become candidates. Patterns and candidates then score each other in rounds over
their graph: a pattern by the share of its fillers that are known or believed, a candidate by
the patterns it fills. Believed candidates of high-confidence patterns are added; spans of fixed
form always stay.

The patterns looked up at once are at most ``block``; more are looked up in several scans.

A filler that starts with a word of digits and signs goes on over all such words after it; one with more
digits than its kind has is none.

Defined cases: a null or empty text has no spans; a pattern needs its words within one text;
repeated rows get equal rows; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsluice.llm import common as c

KINDS = ("email", "ip", "card", "phone")
LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
NUMERIC = np.zeros(256, bool)
NUMERIC[list(b"0123456789().+-")] = True
NORMAL = c.LOWER.copy()
NORMAL[0x30:0x3A] = 0x30
SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
SEED = pa.struct([("kind", pa.int32()), ("value", pa.int64()), ("patterns", pa.list_(pa.int64()))])
BASE = (
    "doc_id long, key long, base array<struct<start: long, kind: int, end: long>>, "
    "seeds array<struct<kind: int, value: long, patterns: array<long>>>"
)
FOUND = "pattern long, kind int, value long, n long, doc_id long, key long, start long, end long"


def emails(text: bytes) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find(b"@")
    while at >= 0:
        start = last + len(text[last:at].rstrip(LOCAL))
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            last = match.end()
            yield start, last
        elif start == at:
            last = at + 1
        at = text.find(b"@", max(at + 1, last))


def luhn(digits: bytes) -> bool:
    total = sum(d - 48 for d in digits[-1::-2])
    return (total + sum((d - 48) * 2 - 9 * (d > 52) for d in digits[-2::-2])) % 10 == 0


def _digits(x: bytes) -> bytes:
    return bytes(b for b in x if 48 <= b <= 57)


def base_spans(text: bytes, with_digits: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, in bytes, by start and then kind."""
    spans = [(s, 0, e) for s, e in emails(text)]
    if with_digits:
        for m in IP.finditer(text):
            if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in m[0].split(b".")):
                spans.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                spans.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def could_be(kind: int, filler: bytes) -> bool:
    """Whether a filler has the rough shape of a kind."""
    digits = len(_digits(filler))
    if kind == 0:
        return b"@" in filler or (b"at)" in filler or b"at]" in filler) and len(filler) > 8
    if kind == 1:
        return digits >= 4 and (filler.count(b".") >= 3 or filler.count(b":") >= 3)
    return 9 <= digits <= (19 if kind == 2 else 15) and digits * 2 > len(filler)


def _contexts(data: np.ndarray, offsets: np.ndarray):
    """Words and the hashes of the pair before, and of the words around, each of them."""
    starts, ends, doc = c.words(data, offsets, c.separators("spaces"))
    h = c.range_hash(NORMAL[data], starts, ends)
    return starts, ends, doc, h


def number_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each word is of digits and signs only, and the last word of the run of such words it is in.

    An identifier may be written in several words; runs do not leave a document, other words end where they start.
    """
    other = np.concatenate(([0], np.cumsum(~NUMERIC[data])))
    numeric, places = other[ends] == other[starts], np.arange(len(starts))
    last = np.flatnonzero(np.append(~numeric[1:] | (doc[1:] != doc[:-1]), True)[: len(starts)])
    return numeric, np.where(numeric, last[np.searchsorted(last, places)], places)


def _before(h):
    return c.mix(h[:-1] * c.U(0x9E3779B97F4A7C15) + h[1:])


def _around(left, right):
    return c.mix(left * c.U(0xC2B2AE3D27D4EB4F) + right * c.U(0x165667B19E3779F9))


def _value(x: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True)


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            some = np.diff(np.concatenate(([0], np.cumsum(DIGIT[data])))[offsets]) > 0
            found = [
                base_spans(data[a:z].tobytes(), bool(d)) for a, z, d in zip(offsets[:-1], offsets[1:], some)
            ]
            starts, ends, doc, h = _contexts(data, offsets)
            rows, seeds = [], []
            for i, spans in enumerate(found):
                o = int(offsets[i])
                rows.append([{"start": int(points[o + s] - points[o]), "kind": k, "end": int(points[o + e] - points[o])} for s, k, e in spans])
                own = []
                for s, k, e in spans:
                    slot = int(np.searchsorted(starts, o + s, "right")) - 1
                    after = int(np.searchsorted(starts, o + e))
                    patterns = []
                    if slot > 1 and doc[slot - 2] == i:
                        patterns.append(_before(h[slot - 2 : slot]))
                    if slot > 0 and doc[slot - 1] == i and after < len(doc) and doc[after] == i:
                        patterns.append(_around(h[slot - 1 : slot], h[after : after + 1]))
                    own.append({"kind": k, "value": _value(data[o + s : o + e].tobytes()),
                                "patterns": [int(p.view(np.int64)[0]) for p in patterns]})
                seeds.append(own)
            yield pa.RecordBatch.from_arrays(
                [*(b[n].slice(first, end - first) for n in ("doc_id", "key")),
                 pa.array(rows, pa.list_(SPAN)), pa.array(seeds, pa.list_(SEED))],
                names=["doc_id", "key", "base", "seeds"],
            )


def _lookup(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    patterns, kinds = shared.value
    bits = np.zeros(1 << 22, bool)
    bits[(patterns & c.U((1 << 22) - 1)).astype(np.int64)] = True
    others: dict[int, int] = {}
    schema = pa.schema([(n, pa.int32() if n == "kind" else pa.int64()) for n in
                        ("pattern", "kind", "value", "n", "doc_id", "key", "start", "end")])
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            starts, ends, doc, h = _contexts(data, offsets)
            ids, keys = (b[n].slice(first, end - first).to_pylist() for n in ("doc_id", "key"))
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            rows = []
            if len(h) < 3:
                continue
            numeric, stops = number_runs(data, starts, ends, doc)
            inner = np.append(False, numeric[1:] & numeric[:-1] & (doc[1:] == doc[:-1]))  # not where a run starts
            places = np.flatnonzero(~inner)
            pair, single = places[places > 1], places[(places > 0) & (stops[places] + 1 < len(h))]
            for slots, left, hashes in (
                (pair, 2, _before(h)[pair - 2]),
                (single, 1, _around(h[single - 1], h[stops[single] + 1])),
            ):
                at = np.flatnonzero(bits[(hashes & c.U((1 << 22) - 1)).astype(np.int64)])
                lo, hi = np.searchsorted(patterns, hashes[at]), np.searchsorted(patterns, hashes[at], "right")
                for j in np.flatnonzero(hi > lo).tolist():
                    slot = int(slots[at[j]])
                    stop, d = int(stops[slot]), int(doc[slot])
                    if doc[slot - left] != d or left == 1 and doc[stop + 1] != d:
                        continue
                    raw = data[starts[slot] : ends[stop]].tobytes()
                    core = raw.strip(b".,;:!?\"'<>()[]|#$%&*")
                    shift = raw.find(core)
                    for p in range(lo[j], hi[j]):
                        kind, pattern = int(kinds[p]), int(patterns[p : p + 1].view(np.int64)[0])
                        if core and could_be(kind, core):
                            a, o = int(starts[slot]) + shift, int(offsets[d])
                            rows.append((pattern, kind, _value(core), 1, ids[d], keys[d],
                                         int(points[a] - points[o]), int(points[a + len(core)] - points[o])))
                        else:
                            others[p] = others.get(p, 0) + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
    if others:
        rows = [(int(patterns[p : p + 1].view(np.int64)[0]), int(kinds[p]), None, n, None, None, None, None) for p, n in others.items()]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


@dataclass(frozen=True)
class ContextExtractor:
    """``min_seeds`` different seeds make a pattern; ``belief`` is the score to accept."""

    min_seeds: int = 3
    belief: float = 0.8
    rounds: int = 3
    block: int = 500_000

    def base(self, docs: DataFrame) -> DataFrame:
        rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("doc_id", "text").alias("key"))
        return c.stored(c.in_arrow(rows, _base, BASE), "pii-base")

    def patterns(self, base: DataFrame) -> DataFrame:
        """pattern, kind, seeds: contexts of several different seeds of one kind."""
        seeds = base.select(F.explode("seeds").alias("s")).select("s.kind", "s.value", F.explode("s.patterns").alias("pattern"))
        return seeds.distinct().groupBy("pattern", "kind").agg(F.count("*").alias("seeds")).filter(
            F.col("seeds") >= self.min_seeds
        )

    def fillers(self, docs: DataFrame, patterns: DataFrame) -> DataFrame | None:
        """What fills the patterns: a row per possible identifier, and counts of all else."""
        kept = c.stored(patterns, "pii-patterns")
        blocks = -(-kept.count() // self.block)
        rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("doc_id", "text").alias("key"))
        parts = []
        for i in range(blocks):
            part = kept.filter(F.pmod("pattern", F.lit(blocks)) == i).toArrow()
            hashes, kinds = part["pattern"].to_numpy().view(c.U), part["kind"].to_numpy()
            order = np.argsort(hashes, kind="stable")
            shared = docs.sparkSession.sparkContext.broadcast((hashes[order], kinds[order]))
            parts.append(c.in_arrow(rows, partial(_lookup, shared=shared), FOUND))
        return c.stored(reduce(DataFrame.unionByName, parts), "pii-fillers") if parts else None

    def believed(self, fillers: DataFrame, seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Scores of patterns and of new instances after the rounds."""
        totals = fillers.groupBy("pattern", "kind").agg(F.sum("n").alias("total"))
        edges = c.stored(
            fillers.filter("value IS NOT NULL").groupBy("pattern", "kind", "value").agg(F.sum("n").alias("n"))
            .join(seeds.withColumn("seed", F.lit(True)), ["kind", "value"], "left")
            .join(totals, ["pattern", "kind"]), "pii-edges",
        )
        scored = edges.withColumn("score", F.coalesce(F.col("seed"), F.lit(False)).cast("double"))
        for _ in range(self.rounds):
            patterns = scored.groupBy("pattern", "kind").agg(
                (F.sum(F.col("n") * F.col("score")) / F.max("total")).alias("confidence")
            )
            doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))
            instances = edges.join(patterns, ["pattern", "kind"]).groupBy("kind", "value").agg(
                F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(doubt)).alias("score")
            )
            scored = c.stored(edges.join(instances, ["kind", "value"]), "pii-round")
        return patterns, scored.filter("seed IS NULL").select("kind", "value", "score").distinct()

    def extracted(self, docs: DataFrame) -> DataFrame:
        """doc_id, key, base spans and all spans, a row per document."""
        base = self.base(docs)
        found = self.fillers(docs, self.patterns(base))
        if found is None:
            return base.select("doc_id", "key", "base", F.col("base").alias("spans"))
        seeds = base.select(F.explode("seeds").alias("s")).select("s.kind", "s.value").distinct()
        patterns, instances = self.believed(found, seeds)
        added = (
            found.filter("value IS NOT NULL")
            .join(patterns.filter(F.col("confidence") >= self.belief), ["pattern", "kind"])
            .join(instances.filter(F.col("score") >= self.belief), ["kind", "value"])
            .groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("added"))
        )
        match = F.col("b.key").eqNullSafe(F.col("a.key")) & F.col("b.doc_id").eqNullSafe(F.col("a.doc_id"))
        apart = lambda x: ~F.exists("base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
        return (
            base.alias("b").join(added.alias("a"), match, "left")
            .select("b.doc_id", "b.key", "base", F.filter(F.coalesce("added", F.expr("cast(array() AS array<struct<start: long, kind: int, end: long>>)")), apart).alias("added"))
            .select("doc_id", "key", "base", F.array_sort(F.concat("base", "added")).alias("spans"))
        )

    def redacted(self, docs: DataFrame) -> DataFrame:
        """The documents with each span replaced by its kind in brackets, and all of their columns."""
        spans = self.extracted(docs).filter(F.size("spans") > 0).select(
            F.col("key").alias("__key"), F.col("doc_id").alias("__id"), F.col("spans").alias("__spans")
        ).dropDuplicates(["__key", "__id"])
        match = (F.xxhash64("doc_id", "text") == F.col("__key")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
        text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(replaced(F.col("text"), F.col("__spans")))
        return docs.join(spans, match, "left").withColumn("text", text).select(*(F.col(f"`{n}`") for n in docs.columns))


def replaced(text, spans):
    """``text`` with spans replaced; of overlapping spans the first counts, the later is cut to what follows it."""
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    name = lambda k: F.element_at(F.array(*(F.lit(f"[{n}]") for n in KINDS)), k + 1)

    def step(done, s):
        skip = s["end"] <= done["at"]
        gap = F.substring(text, (done["at"] + 1).cast("int"), F.greatest(F.lit(0), s["start"] - done["at"]).cast("int"))
        out = F.when(skip, done["out"]).otherwise(F.concat(done["out"], gap, name(s["kind"])))
        return F.struct(out.alias("out"), F.greatest(done["at"], s["end"]).alias("at"))

    def finish(done):
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))

    return F.aggregate(spans, zero, step, finish)


def listed(spans):
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(n) for n in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )
