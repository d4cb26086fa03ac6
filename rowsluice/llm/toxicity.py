"""Toxicity scores by FTRL-proximal logistic regression over hashed n-grams.

Features are the hashed words, word pairs and skip pairs (one word between) that a text has.
The model learns online from a bounded sample of labelled rows, with a learning rate for each
coordinate and an L1 penalty that leaves few weights; those are broadcast and score every text
in one pass.

The sample is the ``max_rows`` labelled documents with the smallest hashes of their ids, so it is
the same on every run. The weights are bounded by the number of buckets.

Defined cases: null labels are not learned from, of several labels of a document the largest
counts; null and empty texts have no features and score by the bias alone; without any label all
scores are 0; repeated rows get equal rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsluice.llm import common as c

SEP = c.separators("alphanumerics")
BIAS = -1


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each word, pair and skip pair."""
    low = c.LOWER[data]
    starts, ends, doc = c.words(low, offsets, SEP)
    h = c.range_hash(low, starts, ends)
    docs, buckets = [doc], [h]
    for gap, factor in ((1, c.U(0x9E3779B97F4A7C15)), (2, c.U(0xC2B2AE3D27D4EB4F))):
        same = doc[: len(doc) - gap] == doc[gap:] if len(doc) > gap else np.zeros(0, bool)
        docs.append(doc[: len(same)][same])
        buckets.append(c.mix(h[: len(same)] * factor + h[gap:][: len(same)])[same])
    return np.concatenate(docs), (np.concatenate(buckets) >> c.U(64 - bits)).astype(np.int64)


def _examples(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            doc, bucket = features(data, offsets, bits)
            both = np.unique(doc << bits | bucket)
            cuts = np.searchsorted(both, np.arange(end - first + 1) << bits)
            lists = pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()), pa.array(both & (1 << bits) - 1, pa.int32())
            )
            rest = [b[n].slice(first, end - first) for n in ("place", "label")]
            yield pa.RecordBatch.from_arrays([*rest, lists], names=["place", "label", "buckets"])


@dataclass(frozen=True)
class Ftrl:
    """Learner settings; ``bits`` is the logarithm of the number of buckets."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.1
    epochs: int = 3

    def learn(self, examples: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, float]:
        """Weights and bias after some passes over (label, buckets)."""
        size = (1 << self.bits) + 1
        z, n = np.zeros(size), np.zeros(size)
        l1 = np.full(size, self.l1)
        l1[-1] = 0.0

        def weights(at):
            zi = z[at]
            shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1[at], 0)
            return -shrunk / ((self.beta + np.sqrt(n[at])) / self.alpha + self.l2 * (l1[at] > 0))

        for _ in range(self.epochs):
            for label, buckets in examples:
                at = np.append(buckets, size - 1)
                w = weights(at)
                g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
                z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / self.alpha * w
                n[at] += g * g
        w = weights(np.arange(size))
        return w[:-1], float(w[-1])


def _train(batches: Iterator[pa.RecordBatch], learner: Ftrl) -> Iterator[pa.RecordBatch]:
    examples = []
    for b in batches:
        cuts, flat = b["buckets"].offsets.to_numpy(), b["buckets"].values.to_numpy()
        examples += [(y, flat[a:z]) for y, a, z in zip(b["label"].to_pylist(), cuts[:-1], cuts[1:])]
    if examples:
        w, bias = learner.learn(examples)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, BIAS)), pa.array(np.append(w[at], bias))], names=["bucket", "weight"]
        )


def _score(batches: Iterator[pa.RecordBatch], shared, bits: int) -> Iterator[pa.RecordBatch]:
    at, w, bias = shared.value
    dense = np.zeros(1 << bits)
    dense[at] = w
    used = dense != 0
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"]):
            doc, bucket = features(data, offsets, bits)
            some = used[bucket]
            both = np.unique(doc[some] << bits | bucket[some])
            total = np.bincount(both >> bits, dense[both & (1 << bits) - 1], end - first) + bias
            score = np.where(np.isneginf(total), 0.0, 1 / (1 + np.exp(-np.clip(total, -700, 700))))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].slice(first, end - first), pa.array(score)], names=["doc_id", "score"]
            )


@dataclass(frozen=True)
class ToxicityModel:
    learner: Ftrl = Ftrl()
    max_rows: int = 20_000
    threshold: float = 0.3

    def sample(self, docs: DataFrame, labels: DataFrame) -> DataFrame:
        """At most ``max_rows`` labelled documents in the order of their ids' hashes."""
        known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
            F.max("toxic").cast("int").alias("label")
        )
        place = F.xxhash64("doc_id")
        chosen = known.withColumn("place", place).orderBy("place", "doc_id").limit(self.max_rows)
        # max_rows rows of three numbers
        return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text"])

    def fit(self, docs: DataFrame, labels: DataFrame) -> DataFrame:
        """bucket, weight rows; bucket -1 is the bias."""
        examples = self.sample(docs, labels).select("place", "label", "text").mapInArrow(
            partial(_examples, bits=self.learner.bits), "place long, label int, buckets array<int>"
        )
        ordered = c.stored(examples, "examples").repartition(1).sortWithinPartitions("place", "label")
        return ordered.mapInArrow(partial(_train, learner=self.learner), "bucket long, weight double")

    def score(self, docs: DataFrame, weights: DataFrame) -> DataFrame:
        """doc_id and score of each document."""
        rows = weights.collect()  # the buckets at most
        at = np.array([r["bucket"] for r in rows if r["bucket"] != BIAS], np.int64)
        w = np.array([r["weight"] for r in rows if r["bucket"] != BIAS], float)
        bias = next((r["weight"] for r in rows if r["bucket"] == BIAS), -float("inf"))
        shared = docs.sparkSession.sparkContext.broadcast((at, w, bias))
        return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            partial(_score, shared=shared, bits=self.learner.bits), "doc_id long, score double"
        )


def held_out(doc_id: str = "doc_id"):
    """Rows never learned from: a quarter by the checksum of the id's text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
