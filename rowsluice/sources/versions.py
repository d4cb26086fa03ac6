"""Targets that a load of several tables changes all at once or not at all.

``begin()`` of such a sink gives a staged view of it: truncations and appends show there only, until
``publish()`` makes all of them visible in one step. A load that fails before leaves nothing behind that
readers could see.

``VersionedSink`` keeps tables as folders that are never changed. A published version is one small file that
lists the folders of every table; it is committed by a single rename, and readers take the newest. Appending
adds a folder to a table's list and copies nothing. Two loads that started from the same version compete: the
first to publish wins, by the smallest random name if both do at once, and the other fails with ``PublishConflict``.

``JdbcSink.begin`` (see ``sinks``) stages rows in tables of their own and moves them by ``INSERT ... SELECT``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsluice.operators.spec import TableSpec

POINTER = "sequence long, version string, table_name string, folders array<string>"


class PublishConflict(RuntimeError):
    """Another load published a version in the meantime."""


@dataclass(frozen=True)
class Snapshot:
    """A published version: its place in the history, its name, and the folders of each table."""

    sequence: int = 0
    version: str = ""
    tables: dict[str, tuple[str, ...]] = field(default_factory=dict)


@dataclass(frozen=True)
class VersionedSink:
    """Tables below ``root``, on storage all executors reach."""

    spark: SparkSession
    root: str

    def path(self, part: str) -> str:
        return f"{self.root.rstrip('/')}/{part}"

    # -- versions -----------------------------------------------------------
    def _published(self) -> DataFrame | None:
        """The pointer rows of all published versions, losers of a tie left out."""
        try:
            rows = self.spark.read.schema(POINTER).parquet(self.path("published"))
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        winners = rows.groupBy("sequence").agg(F.min("version").alias("version"))
        return rows.join(winners, ["sequence", "version"])

    def history(self) -> DataFrame:
        """sequence, version and number of tables of every published version."""
        rows = self._published()
        if rows is None:
            return self.spark.createDataFrame([], "sequence long, version string, tables long")
        return rows.groupBy("sequence", "version").agg(F.count("table_name").alias("tables"))

    def snapshot(self, sequence: int | None = None) -> Snapshot:
        """The newest version, or the one of that number; a database's tables are few enough to list."""
        rows = self._published()
        if rows is None:
            found = []
        elif sequence is None:
            found = rows.join(F.broadcast(rows.agg(F.max("sequence").alias("sequence"))), "sequence").collect()
        else:
            found = rows.filter(F.col("sequence") == sequence).collect()
        if not found:
            if sequence:
                raise LookupError(f"no version {sequence} below {self.root}")
            return Snapshot()
        tables = {r["table_name"]: tuple(r["folders"]) for r in found if r["table_name"] is not None}
        return Snapshot(found[0]["sequence"], found[0]["version"], tables)

    def begin(self) -> StagedVersion:
        return StagedVersion(self, self.snapshot(), uuid.uuid4().hex)

    # -- as a sink, each call a version of its own --------------------------
    def exists(self, table: str) -> bool:
        return table in self.snapshot().tables

    def create(self, spec: TableSpec) -> None:
        staged = self.begin()
        if not staged.exists(spec.name):
            staged.truncate([spec])
            staged.publish()

    def truncate(self, specs: list[TableSpec]) -> None:
        staged = self.begin()
        staged.truncate(specs)
        staged.publish()

    def append(self, rows: DataFrame, table: str) -> None:
        staged = self.begin()
        staged.append(rows, table)
        staged.publish()

    def read(self, table: str, sequence: int | None = None) -> DataFrame:
        """A table as of the newest version, or of the one of that number.

        The frame keeps to that version, whatever is published while it is used.
        """
        return self._frame(self.snapshot(sequence).tables, table)

    def _frame(self, tables: dict[str, tuple[str, ...]], table: str) -> DataFrame:
        if table not in tables:
            raise LookupError(f"no table {table!r} below {self.root}")
        return self.spark.read.parquet(*[self.path(f) for f in tables[table]])


class StagedVersion:
    """A version in the making: what its loads wrote is read through it only."""

    def __init__(self, sink: VersionedSink, base: Snapshot, version: str):
        self.sink, self.base, self.version = sink, base, version
        self.tables = dict(base.tables)
        self._written = 0

    def _write(self, rows: DataFrame, table: str) -> str:
        folder = f"data/{self.version}/{self._written}-{table}"
        self._written += 1
        rows.write.parquet(self.sink.path(folder))
        return folder

    def exists(self, table: str) -> bool:
        return table in self.tables

    def truncate(self, specs: list[TableSpec]) -> None:
        for spec in specs:  # an empty folder keeps the columns
            self.tables[spec.name] = (self._write(self.sink.spark.createDataFrame([], spec.schema), spec.name),)

    def append(self, rows: DataFrame, table: str) -> None:
        self.tables[table] = (*self.tables.get(table, ()), self._write(rows, table))

    def read(self, table: str) -> DataFrame:
        return self.sink._frame(self.tables, table)

    def publish(self) -> str:
        """Make the version the newest; its number and name."""
        spark, sequence = self.sink.spark, self.base.sequence + 1
        self._refuse_if_overtaken(sequence, published=False)
        rows = [(sequence, self.version, name, list(folders)) for name, folders in self.tables.items()]
        pointer = spark.createDataFrame(rows or [(sequence, self.version, None, [])], POINTER)
        pointer.coalesce(1).write.mode("append").parquet(self.sink.path("published"))
        self._refuse_if_overtaken(sequence, published=True)
        return f"version {sequence} ({self.version})"

    def _refuse_if_overtaken(self, sequence: int, published: bool) -> None:
        newest = self.sink.snapshot()
        if newest.sequence > sequence and published:
            newest = self.sink.snapshot(sequence)
        if newest.sequence >= sequence and newest.version != self.version:
            raise PublishConflict(f"version {newest.sequence} was published since version {self.base.sequence} was read")
