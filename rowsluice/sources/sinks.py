"""Targets rows are loaded into: Parquet folders, session tables, databases.

A sink knows whether a table exists, can empty a set of tables and can append
rows. Spark's own committers make file and table writes atomic per job; a JDBC
write is one transaction per partition. Sinks with ``begin`` can also make a load
of several tables visible in one step (``JdbcSink`` here, ``versions.VersionedSink``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsluice.functions.text import quoted
from rowsluice.operators.spec import TableSpec
from rowsluice.sources.jdbc import Connection, run_statements

MIN_BATCH, MAX_BATCH, DEFAULT_BATCH = 1, 5000, 500


class Sink(Protocol):
    def exists(self, table: str) -> bool: ...

    def truncate(self, specs: list[TableSpec]) -> None: ...

    def append(self, rows: DataFrame, table: str) -> None: ...

    def read(self, table: str) -> DataFrame: ...


def checked_batch_size(size: int) -> int:
    if not MIN_BATCH <= size <= MAX_BATCH:
        raise ValueError(f"batch size must be {MIN_BATCH}-{MAX_BATCH}")
    return size


@dataclass(frozen=True)
class ParquetSink:
    """One folder per table below ``root``, on storage all executors reach."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def exists(self, table: str) -> bool:
        try:
            self.spark.read.parquet(self.path(table)).schema  # noqa: B018
        except Exception as problem:
            if "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
                return False
            raise
        return True

    def create(self, spec: TableSpec) -> None:
        self.spark.createDataFrame([], spec.schema).write.mode("ignore").parquet(self.path(spec.name))

    def truncate(self, specs: list[TableSpec]) -> None:
        for spec in reversed(specs):
            self.spark.createDataFrame([], spec.schema).write.mode("overwrite").parquet(
                self.path(spec.name)
            )

    def append(self, rows: DataFrame, table: str) -> None:
        rows.write.mode("append").parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))


@dataclass(frozen=True)
class TableSink:
    """Tables of the session catalog."""

    spark: SparkSession
    database: str = "default"
    format: str = "parquet"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def create(self, spec: TableSpec) -> None:
        if not self.exists(spec.name):
            self.spark.createDataFrame([], spec.schema).write.format(self.format).saveAsTable(
                self.name(spec.name)
            )

    def truncate(self, specs: list[TableSpec]) -> None:
        for spec in reversed(specs):
            self.spark.sql(f"TRUNCATE TABLE {self.name(spec.name)}")

    def append(self, rows: DataFrame, table: str) -> None:
        rows.write.mode("append").format(self.format).saveAsTable(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))


@dataclass(frozen=True)
class JdbcSink:
    """A relational database. ``writers`` bounds its parallel connections."""

    spark: SparkSession
    connection: Connection
    batch_size: int = DEFAULT_BATCH
    writers: int = 16

    def __post_init__(self):
        checked_batch_size(self.batch_size)

    def _reader(self):
        return self.spark.read.format("jdbc").options(**self.connection.jdbc_options)

    def exists(self, table: str) -> bool:
        probe = f"(SELECT * FROM {quoted(table, self.connection.driver)} WHERE 1 = 0) probe"
        try:
            self._reader().option("dbtable", probe).load()
        except Exception as problem:
            text = str(problem).lower()
            if "does not exist" in text or "doesn't exist" in text or "not found" in text:
                return False
            raise
        return True

    def truncate(self, specs: list[TableSpec]) -> None:
        """Empty all tables of a load, given parents first."""
        names = [s.name for s in specs]
        if not names:
            return
        if self.connection.driver == "postgres":
            # One statement for all tables, or references among them refuse it.
            run_statements(self.spark, self.connection, truncate_statements("postgres", names))
            return
        options = dict(self.connection.jdbc_options)
        if self.connection.driver == "mysql":
            options["sessionVariables"] = "FOREIGN_KEY_CHECKS=0"
        for spec in reversed(specs):
            (
                self.read(spec.name)
                .limit(0)
                .write.format("jdbc")
                .options(**options)
                .option("dbtable", quoted(spec.name, self.connection.driver))
                .option("truncate", "true")
                .mode("overwrite")
                .save()
            )

    def append(self, rows: DataFrame, table: str) -> None:
        """Add rows at once; a task that is run again after its commit repeats its rows (see ``begin``)."""
        self.write(rows, table, "append")

    def write(self, rows: DataFrame, table: str, mode: str) -> None:
        (
            rows.write.format("jdbc")
            .options(**self.connection.jdbc_options)
            .option("dbtable", quoted(table, self.connection.driver))
            .option("batchsize", self.batch_size)
            .option("numPartitions", self.writers)
            .mode(mode)
            .save()
        )

    def read(self, table: str) -> DataFrame:
        return self._reader().option("dbtable", quoted(table, self.connection.driver)).load()


    def begin(self, load_id: str | None = None) -> StagedLoad:
        """A load whose rows become visible together; one ``load_id`` takes effect once only."""
        return StagedLoad(self, load_id or uuid.uuid4().hex)


PART, ATTEMPT = "rowsluice_part", "rowsluice_attempt"
LOADS = "rowsluice_loads"


def _tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    part, attempt = task.partitionId(), task.taskAttemptId()
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * n, pa.int32()), pa.array([attempt] * n, pa.int64())],
            names=[*batch.schema.names, PART, ATTEMPT],
        )


class StagedLoad:
    """Rows on their way into a database, exactly once.

    Spark writes a partition in one transaction, but a task that is run again after its commit, or twice at
    once, writes its rows again. So rows go to a staging table first, tagged with partition and task attempt, and
    ``publish`` moves one attempt of each partition into the targets. Emptied targets, moved rows and the
    load's id are one transaction: readers see all tables of a load or none, and a load that is repeated
    with its id after it was published changes nothing.
    """

    def __init__(self, sink: JdbcSink, load_id: str):
        self.sink, self.load_id = sink, load_id
        self.emptied: list[str] = []
        self.staged: dict[str, tuple[str, list[str]]] = {}

    def _name(self, table: str) -> str:
        return quoted(table, self.sink.connection.driver)

    def exists(self, table: str) -> bool:
        return self.sink.exists(table)

    def truncate(self, specs: list[TableSpec]) -> None:
        """Empty these tables when the load is published (given parents first)."""
        self.emptied += [s.name for s in specs]

    def append(self, rows: DataFrame, table: str) -> None:
        staging = f"{table}_{self.load_id[:12]}"
        self.staged[table] = (staging, rows.columns)
        schema = T.StructType([*rows.schema.fields, T.StructField(PART, T.IntegerType()), T.StructField(ATTEMPT, T.LongType())])
        # a repeated load starts its staging table anew
        self.sink.write(rows.coalesce(self.sink.writers).mapInArrow(_tagged, schema), staging, "overwrite")

    def read(self, table: str) -> DataFrame:
        """The target without emptied rows, and the staged ones."""
        parts = [] if table in self.emptied else [self.sink.read(table)]
        if table in self.staged:
            staging, columns = self.staged[table]
            rows = self.sink.read(staging)
            first = rows.groupBy(PART).agg(F.min(ATTEMPT).alias(ATTEMPT))
            parts.append(rows.join(first, [PART, ATTEMPT]).select(*columns))
        return reduce(DataFrame.unionByName, parts) if parts else self.sink.read(table).limit(0)

    def moves(self) -> list[str]:
        """The statements of the one transaction: children are emptied first, parents filled first."""
        out = [f"DELETE FROM {self._name(t)}" for t in reversed(self.emptied)]
        part, attempt = self._name(PART), self._name(ATTEMPT)
        for table, (staging, columns) in self.staged.items():
            shown = ", ".join(self._name(c) for c in columns)
            taken = ", ".join(f"s.{self._name(c)}" for c in columns)
            out.append(
                f"INSERT INTO {self._name(table)} ({shown}) SELECT {taken} FROM {self._name(staging)} s"
                f" JOIN (SELECT {part} AS p, MIN({attempt}) AS a FROM {self._name(staging)} GROUP BY {part}) f"
                f" ON s.{part} = f.p AND s.{attempt} = f.a"
            )
        return out

    def publish(self) -> str:
        sink = self.sink
        run = lambda statements: run_statements(sink.spark, sink.connection, statements)
        if not sink.exists(LOADS):
            run([f"CREATE TABLE {self._name(LOADS)} ({self._name('load_id')} VARCHAR(64) NOT NULL PRIMARY KEY)"])
        loads = sink.read(LOADS)
        done = loads.filter(F.col(loads.columns[0]) == self.load_id).count()
        if not done:  # the primary key refuses a second load of this id that runs at the same time
            literal = self.load_id.replace("'", "''")
            run([f"INSERT INTO {self._name(LOADS)} VALUES ('{literal}')", *self.moves()])
        run([f"DROP TABLE {self._name(staging)}" for staging, _ in self.staged.values()])
        return f"load {self.load_id}" + (" (published before)" if done else "")


def truncate_statements(dialect: str, tables: list[str]) -> list[str]:
    """TRUNCATE text for tables listed parents first: one statement where the
    dialect takes several tables, else one per table, children first."""
    if not tables:
        return []
    if dialect == "mysql":
        return [f"TRUNCATE TABLE {quoted(t, dialect)}" for t in reversed(tables)]
    return ["TRUNCATE TABLE " + ", ".join(quoted(t, dialect) for t in tables)]
