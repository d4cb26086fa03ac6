"""Streaming loads of several tables whose rows refer to each other.

A row whose parent has not arrived waits: it is put aside with the batch and offered again with the
next one, until the parent has been loaded, its patience ends, or the stream does. Each batch handles
its tables parents first, so a child that comes with its parent does not wait at all.

What is known of the parents are digests of the referenced keys of all loaded rows, in files that a batch
reads only the partitions of that it refers to. References shrink to distinct keys before they meet
these, and only missing ones are joined to the rows. The waiting rows are written anew by each batch: work grows with their number, not with
the stream's length.

Defined cases: a reference with a null part is not checked; a row that breaks another rule is rejected at
once and never waits; a row may refer to itself or to rows of its own table and batch; a table outside
the load is not checked; tables that refer to each other in a circle are refused.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from rowsluice.operators.match import fk_edges
from rowsluice.operators.order import ordered_names
from rowsluice.operators.spec import TableSpec, columns_frame
from rowsluice.session import shared_dir
from rowsluice.streaming.digests import DigestFiles
from rowsluice.streaming.ingest import Ingest
from rowsluice.streaming.staged import LOADED, REJECTED, SOUND

WAITING, REFERENCED = "waiting", "referenced"
#: The batch number that rows rejected at the end of the stream are filed under.
END = -1
SINCE = "_since"


def reference_digest(label: str, values: list[Column]) -> Column:
    """A digest of a referenced key; null where a part is missing."""
    whole = reduce(lambda a, b: a & b, [v.isNotNull() for v in values])
    parts = F.struct(F.lit(label).alias("key"), *[v.alias(f"p{i}") for i, v in enumerate(values)])
    return F.when(whole, F.unhex(F.sha2(F.to_json(parts), 256)))


@dataclass(frozen=True)
class RelatedIngest:
    """A streaming load of ``specs`` below ``root``, one folder per table as in ``Ingest``.

    The stream has a column ``table`` with the name of each row's table; rows of other tables are left
    out. ``patience`` is the number of further batches a row waits for its parent; without it, it waits
    until ``finish``.
    """

    specs: tuple[TableSpec, ...]
    root: str
    order: tuple[str, ...]
    table: str = "table_name"
    row: str | None = "row"
    strict: bool = False
    patience: int | None = None
    prefix: int = 1

    def of(self, name: str) -> Ingest:
        spec = next(s for s in self.specs if s.name == name)
        return Ingest(spec, f"{self.root.rstrip('/')}/{name}", self.order, self.row, self.strict, prefix=self.prefix)

    def references(self, spec: TableSpec) -> list[tuple[list[str], TableSpec, list[str], str]]:
        """(columns, parent, parent columns, label) of each reference inside the load."""
        inside = {s.name: s for s in self.specs}
        return [
            (columns, inside[parent], keys, f"{parent}({','.join(keys)})")
            for columns, parent, keys in spec.references
            if parent in inside
        ]

    def referenced(self, spec: TableSpec) -> dict[str, list[str]]:
        """The keys of a table that others refer to, by label."""
        return {label: keys for s in self.specs for _, parent, keys, label in self.references(s) if parent.name == spec.name}

    def _digest(self, spec: TableSpec, columns: list[str], parent: TableSpec, keys: list[str], label: str) -> Column:
        """The digest of a reference, from columns that have the target's types."""
        types = [parent.column(k).spark_type for k in keys]
        return reference_digest(label, [F.col(f"`{spec.column(c).name}`").cast(t).cast("string") for c, t in zip(columns, types, strict=True)])

    # -- one batch ----------------------------------------------------------
    def load_batch(self, batch: DataFrame, batch_id: int, names: list[str]) -> None:
        batch = batch.persist()
        try:
            for name in names:
                rows = batch.filter(F.col(self.table) == name).drop(self.table)
                self._load_table(rows, self.of(name), batch_id)
            done = batch.sparkSession.createDataFrame([(batch_id,)], "number long")
            done.write.mode("overwrite").parquet(f"{self._batches}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    @property
    def _batches(self) -> str:
        return f"{self.root.rstrip('/')}/batches"

    def _load_table(self, rows: DataFrame, load: Ingest, batch_id: int) -> None:
        spec, refers = load.spec, bool(self.references(load.spec))
        staged, labels = load.staged(rows)
        staged = staged.withColumn(SINCE, F.lit(batch_id).cast("long"))
        if refers:
            if batch_id:  # rows wait as they were staged
                staged = staged.unionByName(rows.sparkSession.read.schema(staged.schema).parquet(load.path(WAITING, batch_id - 1)))
            marked = load.kept(self._marked(load.kept(staged, "offered"), spec, batch_id), "marked")
            late = F.lit(False) if self.patience is None else F.col(SINCE) + self.patience <= batch_id
            missing = marked.filter("_missing")
            missing.filter(~late).select(staged.columns).write.mode("overwrite").parquet(load.path(WAITING, batch_id))
            staged = marked.filter("NOT _missing").select(staged.columns)
        load.load_staged(staged.drop(SINCE), batch_id, labels)
        if refers and self.patience is not None:
            self._rejections(missing.filter(late), load).write.mode("append").parquet(load.path(REJECTED, batch_id))
        kept = self.referenced(spec)
        if kept:
            loaded = rows.sparkSession.read.schema(spec.schema).parquet(load.path(LOADED, batch_id))
            digests = [self._digest(spec, keys, spec, keys, label) for label, keys in kept.items()]
            self._files(load).keep(loaded.select(F.explode(F.array(*digests)).alias("digest")), batch_id)

    def _files(self, load: Ingest) -> DigestFiles:
        return DigestFiles(load.path(REFERENCED), self.prefix)

    def _marked(self, staged: DataFrame, spec: TableSpec, batch_id: int) -> DataFrame:
        """Staged rows and whether a parent is missing (``_missing``)."""
        refs, typed = self.references(spec), staged.withColumn("_missing", F.lit(False))
        if not refs:
            return typed
        typed = typed.withColumns({f"_ref{i}": self._digest(spec, *ref) for i, ref in enumerate(refs)})
        own = [f"_own{i}" for i, ref in enumerate(refs) if ref[1].name == spec.name]
        typed = typed.withColumns({f"_own{i}": self._digest(spec, ref[2], ref[1], ref[2], ref[3]) for i, ref in enumerate(refs) if ref[1].name == spec.name})
        for i, (_, parent, _, _) in enumerate(refs):
            if parent.name != spec.name:
                typed = self._flagged(typed, f"_ref{i}", self._unknown(typed, f"_ref{i}", parent, batch_id, None))
        if own:
            typed = self._within(typed, refs, batch_id)
        return typed

    def _unknown(self, typed: DataFrame, ref: str, parent: TableSpec, batch_id: int, own: DataFrame | None) -> DataFrame:
        """References of good rows that no loaded row answers."""
        used = typed.filter(f"{SOUND} AND NOT _missing AND {ref} IS NOT NULL").select(F.col(ref).alias("digest")).distinct()
        # rows of earlier batches, and of this one if the parent's table has been loaded already
        known = self._files(self.of(parent.name)).known(used, F.col("batch_id") <= batch_id if own is None else F.col("batch_id") < batch_id)
        found = [k for k in (known, own) if k is not None]
        return reduce(lambda left, k: left.join(k, "digest", "left_anti"), found, used)

    def _flagged(self, typed: DataFrame, ref: str, unknown: DataFrame) -> DataFrame:
        unknown = unknown.select(F.col("digest").alias(ref), F.lit(True).alias("_hit"))
        out = typed.join(unknown, ref, "left")
        missing = F.col("_missing") | F.coalesce(F.col("_hit") & F.expr(SOUND), F.lit(False))
        return out.withColumn("_missing", missing).select(typed.columns)

    def _within(self, typed: DataFrame, refs: list, batch_id: int) -> DataFrame:
        """References of a table to itself: rows count as parents of each other unless their own are missing.

        A round for each level of rows that fall out; without missing parents there is one.
        """
        before = -1
        shared_dir(typed.sparkSession)
        while True:
            typed = typed.checkpoint()
            now = typed.filter("_missing").count()
            if now == before:
                return typed
            before = now
            for i, (_, parent, _, _) in enumerate(refs):
                if f"_own{i}" in typed.columns:
                    own = typed.filter(f"{SOUND} AND NOT _missing AND _own{i} IS NOT NULL").select(F.col(f"_own{i}").alias("digest")).distinct()
                    typed = self._flagged(typed, f"_ref{i}", self._unknown(typed, f"_ref{i}", parent, batch_id, own))

    def _rejections(self, rows: DataFrame, load: Ingest) -> DataFrame:
        spec = load.spec
        columns = list(dict.fromkeys(c for cols, *_ in self.references(spec) for c in cols))
        shown = F.concat_ws(",", *[F.col(f"`{spec.column(c).name}`").cast("string") for c in columns])
        return rows.select(
            *load.places(),
            F.lit(spec.by_name[columns[0].lower()][0]).alias("ordinal"), F.lit(",".join(columns)).alias("column_name"),
            F.lit("reference").alias("rule"), shown.alias("value"),
            F.concat(F.lit("no parent row came for "), shown).alias("message"), F.lit(spec.name).alias("table_name"),
        )

    # -- the stream ---------------------------------------------------------
    def names(self, spark: SparkSession) -> list[str]:
        """The tables parents first."""
        tables = spark.createDataFrame([("", s.name, i) for i, s in enumerate(self.specs)], "database string, table_name string, position int")
        return ordered_names(tables, fk_edges(columns_frame(spark, list(self.specs))))

    def start(self, rows: DataFrame, available_now: bool = True, **trigger) -> StreamingQuery:
        names = self.names(rows.sparkSession)
        writer = rows.writeStream.foreachBatch(lambda b, i: self.load_batch(b, i, names))
        writer = writer.option("checkpointLocation", f"{self.root.rstrip('/')}/_stream")
        trigger = {"availableNow": True} if available_now else trigger
        return writer.trigger(**trigger).start()

    def finish(self, spark: SparkSession) -> None:
        """Reject the rows that still wait; to be called when the stream has ended.

        They are filed under batch END, which a later call writes anew: a stream that goes on afterwards
        still finds them waiting.
        """
        for spec in self.specs:
            if self.references(spec):
                self._left(spark, spec).write.mode("overwrite").parquet(self.of(spec.name).path(REJECTED, END))

    def _left(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        """Rejections of the rows that the last batch left waiting."""
        last = spark.read.parquet(self._batches).agg(F.max("number")).first()[0]  # it may have left none waiting
        return self._rejections(self.waiting(spark, spec.name).filter(F.col("batch_id") == last), self.of(spec.name))

    # -- results ------------------------------------------------------------
    def waiting(self, spark: SparkSession, name: str) -> DataFrame:
        """The rows that each batch left waiting, with its ``batch_id``."""
        return spark.read.parquet(self.of(name).path(WAITING))

    def loaded(self, spark: SparkSession, name: str) -> DataFrame:
        return self.of(name).loaded(spark)

    def rejected(self, spark: SparkSession, name: str) -> DataFrame:
        return self.of(name).rejected(spark)
