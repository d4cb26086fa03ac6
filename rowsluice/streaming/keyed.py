"""Streaming loads whose unique keys live in operator state.

``Ingest`` keeps the keys of all loaded rows in files and reads those it has digests for.
Here every key digest has the number of the batch that claimed it first, in a RocksDB state store: a
batch looks up its own digests and nothing else, however long the stream is. The store's size is
bounded by the executors' disks. Its changelog goes to the checkpoint, so a restart or a lost executor
continues with the same keys.

The state belongs to a streaming aggregation of its own for each key (``Claims``), which runs beside
the load: a batch claims each digest once, however many rows have it, and gets back those that an earlier batch has.

Of the rows of one key and batch the first by place (row order, then content) owns it; keys are
claimed in turn by rows that break no other rule and no earlier key. A row that a later key rejects
keeps its claim on the earlier ones, which is where this differs from ``Ingest``: state is written as
the key is claimed, before the later keys are known. A replayed batch claims the same digests under the same number.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from threading import Thread

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from rowsluice.streaming.staged import SOUND, StagedLoad

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
CLAIM = "digest binary, batch_id long"
TAKEN = "digest binary, newest long"


@contextmanager
def state_settings(spark: SparkSession):
    """A query takes its state store from the settings at its start."""
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Claims:
    """The first claim of each digest of one unique key, in the state of a query that runs from ``start`` to ``stop``.

    Claims and answers pass through files below ``path``; claims that have been answered are removed by Spark.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.claims, self.answered = f"{path}/claims", []

    def start(self) -> None:
        for query in self.spark.streams.active:  # one that a load just ended has left
            if query.name == self.path:
                query.stop()
        # the file source wants its folder
        self.spark.createDataFrame([], CLAIM).write.mode("append").parquet(self.claims)
        claims = self.spark.readStream.schema(CLAIM).option("cleanSource", "delete").parquet(self.claims)
        first = claims.groupBy("digest").agg(F.min("batch_id").alias("owner"), F.max("batch_id").alias("newest"))
        writer = first.writeStream.outputMode("update").foreachBatch(self._answer).queryName(self.path)
        writer = writer.option("checkpointLocation", f"{self.path}/_state").trigger(processingTime="500 milliseconds")
        with state_settings(self.spark):
            self.query = writer.start()

    def _answer(self, claimed: DataFrame, number: int) -> None:
        path = f"{self.path}/taken/{number}-{uuid.uuid4().hex}"
        claimed.filter("owner < newest").select("digest", "newest").write.parquet(path)
        self.answered.append(path)

    def taken(self, digests: DataFrame, batch_id: int) -> DataFrame:
        """Claim the distinct ``digests`` for a batch; those that an earlier batch has claimed."""
        digests.select("digest", F.lit(batch_id).cast("long").alias("batch_id")).write.mode("append").parquet(self.claims)
        self.query.processAllAvailable()
        paths, self.answered = self.answered, []
        found = self.spark.read.schema(TAKEN).parquet(*paths) if paths else self.spark.createDataFrame([], TAKEN)
        return found.filter(F.col("newest") == batch_id).select("digest").distinct()

    def stop(self) -> None:
        self.query.stop()


class KeyedIngest(StagedLoad):
    """A streaming load of one table whose unique keys live in operator state."""

    def load_staged(self, staged: DataFrame, batch_id: int, labels: list[str], keys: list[Claims]) -> None:
        rows = self.numbered(staged, batch_id)
        for i, key in enumerate(keys):
            alive = F.expr(f"{SOUND} AND size(_repeats) = 0")
            digest = F.col(f"_digest{i}").alias("digest")
            firsts = rows.filter(alive & digest.isNotNull()).groupBy(digest).agg(
                F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
            )
            firsts = self.kept(firsts, f"firsts{i}")
            taken = key.taken(firsts, batch_id).withColumn("_taken", F.lit(True))
            shared = firsts.join(taken, "digest", "left").filter("_n > 1 OR _taken").drop("_n")
            again = alive & (F.coalesce("_taken", F.lit(False)) | (F.col("_place") != F.col("_first")))
            rows = self.repeated(rows, shared.withColumnRenamed("digest", f"_digest{i}"), i, again)
        self.write_judged(self.kept(rows, "judged"), batch_id, labels)

    def start(self, rows: DataFrame, available_now: bool = True, **trigger) -> StreamingQuery:
        """Run the load over a stream of rows (see ``stream_jsonl``)."""
        staged, labels = self.staged(rows)
        keys = [Claims(rows.sparkSession, self.path(f"_keys/{i}")) for i in range(len(labels))]
        for key in keys:
            key.start()
        writer = staged.writeStream.foreachBatch(lambda b, i: self.load_staged(b, i, labels, keys))
        writer = writer.option("checkpointLocation", self.path("_stream"))
        trigger = {"availableNow": True} if available_now else trigger
        try:
            query = writer.trigger(**trigger).start()
        except BaseException:
            _stopped(keys)
            raise
        Thread(target=_followed, args=(query, keys), daemon=True).start()
        return query


def _stopped(keys: list[Claims]) -> None:
    for key in keys:
        key.stop()


def _followed(query: StreamingQuery, keys: list[Claims]) -> None:
    """The keys' queries end with the load's, however that ends."""
    try:
        query.awaitTermination()
    except Exception:  # noqa: BLE001 - whoever waits for the load gets it
        pass
    finally:
        _stopped(keys)
