"""Streaming ingest: JSONL files -> validation -> micro-batch loads.

The digests of the unique keys of all loaded rows are kept in files, so their number is bounded by storage; a
batch reads the partitions it has digests for. Only keys that repeat or were loaded before are joined to the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from rowsluice.streaming.digests import DigestFiles
from rowsluice.streaming.staged import LOADED, REJECTED, SOUND, StagedLoad

__all__ = ["KEYS", "LOADED", "REJECTED", "Ingest"]
KEYS = "keys"


@dataclass(frozen=True)
class Ingest(StagedLoad):
    """A streaming load of one table.

    Uniqueness holds over the whole stream, among rows that break no other rule and whose keys no earlier
    batch has loaded; a rejected row keeps no key from a later one. Keys are kept for good, as a
    duplicate may arrive at any time.

    Key files are partitioned by the first ``prefix`` digits of the digest; more digits suit long streams
    of small batches.
    """

    prefix: int = 1

    # -- one micro-batch ----------------------------------------------------
    def load_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Load a batch of rows as they came."""
        staged, labels = self.staged(batch)
        self.load_staged(staged, batch_id, labels)

    def load_staged(self, staged: DataFrame, batch_id: int, labels: list[str]) -> None:
        rows = self.numbered(staged, batch_id)
        rows = self._judged(rows, batch_id, labels)
        judged = self.kept(rows, "judged")
        self.write_judged(judged, batch_id, labels)
        if labels:
            good = judged.filter(f"{SOUND} AND size(_repeats) = 0")
            digests = F.explode(F.array(*[f"_digest{i}" for i in range(len(labels))])).alias("digest")
            self._keys.keep(good.select(digests), batch_id)

    @property
    def _keys(self) -> DigestFiles:
        return DigestFiles(self.path(KEYS), self.prefix)

    def _judged(self, rows: DataFrame, batch_id: int, labels: list[str]) -> DataFrame:
        """Staged rows with ``_repeats``."""
        digests = [f"_digest{i}" for i in range(len(labels))]
        if not digests:
            return rows
        mine = rows.filter(SOUND).select(F.explode(F.array(*digests)).alias("digest")).filter("digest IS NOT NULL")
        known = self._keys.known(mine, F.col("batch_id") < batch_id)
        if known is not None:
            known = self.kept(known, "known")
            for i, digest in enumerate(digests):  # all keys first: a row rejected here competes for nothing
                hits = known.select(F.col("digest").alias(digest), F.lit(True).alias("_hit"))
                rows = self.repeated(rows, hits, i, F.expr(SOUND) & F.col("_hit"))
        for i, digest in enumerate(digests):
            alive = rows.filter(f"{SOUND} AND size(_repeats) = 0 AND {digest} IS NOT NULL").groupBy(digest)
            shared = alive.agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")).filter("_n > 1").drop("_n")
            again = F.expr(f"{SOUND} AND size(_repeats) = 0") & (F.col("_place") != F.col("_first"))
            rows = self.repeated(rows, shared, i, again)
        return rows

    # -- the stream ---------------------------------------------------------
    def start(self, rows: DataFrame, available_now: bool = True, **trigger) -> StreamingQuery:
        """Run the load over a stream of rows (see ``stream_jsonl``); rules are planned once.

        Malformed lines that the stream passes on are set aside in the folder ``malformed``.
        """
        staged, labels = self.staged(rows)
        writer = staged.writeStream.foreachBatch(lambda b, i: self.load_staged(b, i, labels))
        writer = writer.option("checkpointLocation", self.path("_stream"))
        trigger = {"availableNow": True} if available_now else trigger
        return writer.trigger(**trigger).start()
