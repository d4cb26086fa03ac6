"""Best-fit packing of tokenised documents by minimum bin slack.

Each bin starts with the longest piece left; a bitset subset-sum over the lengths still
available finds the fullest way to fill its rest. That search needs only the number of
pieces of each length, at most ``capacity`` numbers however large the corpus is, and a found
combination is repeated for as long as its lengths last. Pieces then find their bin by their
rank among pieces of equal length: tasks count their own pieces, the counts of tasks are
summed in order, and no group of equal lengths meets in one task. The ids of each piece are kept
with it: ``sequences`` has them in their order, ``packed`` a checksum of them.

Defined cases: a null or empty text is one piece with the end id; a document longer than the
capacity is cut, its first piece taking the remainder; repeated rows are packed once each; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rowsluice.llm import common as c
from rowsluice.llm.anchors import blob_column, blobs, runs, whole_groups
from rowsluice.llm.tokens import encoded

#: Characters of known words that a worker keeps; with half as many, words met again were encoded anew too often.
KNOWN_CHARS = 20_000_000
#: Tables that workers keep through the steps of the operator.
KEPT = ("encoder ",)
PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids", pa.binary()), ("part", pa.int64()), ("rank", pa.int64())]
)


def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
    for b in batches:
        for first, end, ids, counts in encoded(b["text"], path, KNOWN_CHARS):
            n = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            head = counts - (n - 1) * capacity
            start = np.where(piece > 0, head[doc] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, head[doc])
            raw = blob_column(ids.astype("<u4"), 4 * length)  # pieces follow each other as the ids do
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].slice(first, end - first).take(pa.array(doc)), pa.array(piece, pa.int32()),
                 pa.array(start), pa.array(length), raw,
                 pa.array(np.full(len(doc), part)), pa.array(rank)],
                schema=PIECES,
            )
            c.give_back()


def fullest(available: np.ndarray, room: int) -> dict[int, int]:
    """Lengths and their multiples that fill ``room`` as far as the available pieces can."""
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for length in np.flatnonzero(available[: room + 1])[::-1].tolist():
        left, take = min(int(available[length]), room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left -= take
            take *= 2
        if reach >> room:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def minimum_slack(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many bins are filled with each."""
    left, plan = counts.copy(), []
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        used = fullest(left, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        bins = min(int(left[n]) // m for n, m in used.items())
        for n, m in used.items():
            left[n] -= m * bins
        plan.append((used, bins))
    return plan


def _slots(plan) -> dict[str, np.ndarray]:
    """For each length and combination: the first rank it takes, its first bin, place and multiple."""
    rows, taken, first = [], {}, 0
    for used, bins in plan:
        place = 0
        for length, multiple in sorted(used.items(), reverse=True):
            rows.append((length, taken.get(length, 0), first, place, multiple))
            taken[length] = taken.get(length, 0) + multiple * bins
            place += length * multiple
        first += bins
    table = np.array(rows or np.zeros((0, 5)), np.int64)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return dict(zip(("length", "rank", "bin", "place", "multiple"), table.T))


def _placed(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    slots = shared.value
    keys = slots["length"] << 48 | slots["rank"]
    for b in batches:
        length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
        at = np.searchsorted(keys, length << 48 | rank, "right") - 1
        nth, of = np.divmod(rank - slots["rank"][at], slots["multiple"][at])
        kept = [x for x in b.schema.names if x != "rank"]
        yield pa.RecordBatch.from_arrays(
            [*(b[x] for x in kept), pa.array(slots["bin"][at] + nth), pa.array(slots["place"][at] + of * length)],
            names=[*kept, "sequence_id", "offset"],
        )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences from rows ordered by sequence and offset: the ids of one follow each other already."""
    for b in whole_groups(batches, "sequence_id"):
        key = b["sequence_id"].to_numpy()
        first = runs(key)
        cuts = pa.array(np.append(first, len(key)).astype(np.int32))
        data, ends = blobs(b["ids"])
        ids = np.frombuffer(data.tobytes(), "<u4").astype(np.int32)
        at = (ends[np.append(first, len(key))] // 4).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[first]), pa.ListArray.from_arrays(pa.array(at), pa.array(ids)),
             *(pa.ListArray.from_arrays(cuts, b[x]) for x in ("doc_id", "piece", "offset"))],
            names=["sequence_id", "ids", "doc_ids", "pieces", "offsets"],
        )


@dataclass(frozen=True)
class Packer:
    tokenizer: str
    capacity: int = 1024

    def pieces(self, docs: DataFrame) -> DataFrame:
        """The pieces of all documents with their ids (32 bits each, little-endian), stored."""
        rows = docs.select(F.col("doc_id").cast("long"), "text")
        schema = "doc_id long, piece int, start long, length long, ids binary, part long, rank long"
        return c.stored(c.in_arrow(rows, partial(_cut, path=self.tokenizer, capacity=self.capacity), schema, KEPT), "pieces")

    def placed(self, docs: DataFrame, with_ids: bool = True) -> DataFrame:
        """doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset: a row per piece."""
        pieces = self.pieces(docs)
        by_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
        counts = np.zeros(self.capacity + 1, np.int64)
        for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
            counts[row["length"]] = row["n"]
        plan = minimum_slack(counts, self.capacity)
        shared = docs.sparkSession.sparkContext.broadcast(_slots(plan))
        before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = by_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
        shown = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
        ranked = pieces.select(*shown, "part", "rank").join(offsets, ["length", "part"])
        ranked = ranked.select(*shown, (F.col("rank") + F.col("earlier")).alias("rank"))
        ids = "ids binary, " if with_ids else ""
        schema = f"doc_id long, piece int, start long, length long, ids_crc32 long, {ids}sequence_id long, offset long"
        return c.in_arrow(ranked, partial(_placed, shared=shared), schema, KEPT)

    def packed(self, docs: DataFrame) -> DataFrame:
        """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row per piece."""
        return self.placed(docs, with_ids=False)

    def sequences(self, docs: DataFrame) -> DataFrame:
        """sequence_id, its token ids, and doc_ids, pieces and offsets of what it holds: a row per sequence."""
        dealt = self.placed(docs).repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
        schema = "sequence_id long, ids array<int>, doc_ids array<long>, pieces array<int>, offsets array<long>"
        return c.in_arrow(dealt, _joined, schema, KEPT)
