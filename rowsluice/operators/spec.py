"""Declared tables: columns, keys, references and CHECKs.

A spec is what validation and loading of one table need on the driver; its
size is bounded by the number of columns a database table can have. Catalogs
of many tables stay DataFrames (see ``rowsluice.sources.catalog``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsluice.functions.text import base_type_of
from rowsluice.functions.variants import spark_type

COLUMN_SCHEMA = (
    "database string, table_name string, ordinal int, name string, type string, nullable boolean, is_pk boolean, "
    "is_unique boolean, fk_ref string, unsigned boolean, length int, precision int, scale int, "
    "values array<string>"
)
CHECK_SCHEMA = "database string, table_name string, name string, expr string, cols array<string>"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True
    is_pk: bool = False
    unique: bool = False
    fk_ref: str = ""
    unsigned: bool = False
    length: int = 0
    precision: int = 0
    scale: int = 0
    values: tuple[str, ...] = ()

    @property
    def base(self) -> str:
        return base_type_of(self.type)

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.type, self.unsigned, self.precision, self.scale)


@dataclass(frozen=True)
class CheckSpec:
    name: str
    expr: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    checks: tuple[CheckSpec, ...] = ()
    composite_unique: tuple[tuple[str, ...], ...] = ()
    composite_fks: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    dialect: str = "postgres"
    by_name: dict[str, tuple[int, ColumnSpec]] = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        index = {c.name.lower(): (i, c) for i, c in enumerate(self.columns, start=1)}
        object.__setattr__(self, "by_name", index)

    def column(self, name: str) -> ColumnSpec | None:
        found = self.by_name.get(name.lower())
        return found[1] if found else None

    @property
    def primary_key(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.is_pk)

    @property
    def unique_keys(self) -> list[tuple[str, ...]]:
        """The primary key as one tuple, every unique column, composite uniques."""
        keys = [self.primary_key] if self.primary_key else []
        keys += [(c.name,) for c in self.columns if c.unique and (c.name,) not in keys]
        return keys + [k for k in self.composite_unique if k not in keys]

    @property
    def parents(self) -> list[str]:
        """Referenced tables, in column order, each once."""
        tables = [c.fk_ref.split(".", 1)[0] for c in self.columns if "." in c.fk_ref]
        tables += [parent for _, parent, _ in self.composite_fks]
        return list(dict.fromkeys(t for t in tables if t))

    @property
    def references(self) -> list[tuple[list[str], str, list[str]]]:
        """(columns, parent table, parent columns): composite keys as declared, others one by one."""
        found = [(list(cols), parent, list(keys)) for cols, parent, keys in self.composite_fks]
        for column in self.columns:
            parent, _, parent_column = column.fk_ref.partition(".")
            if parent and parent_column:
                found.append(([column.name], parent, [parent_column]))
        return found

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns])

    @classmethod
    def from_catalog(
        cls, table: str, columns: DataFrame, checks: DataFrame | None = None, dialect="postgres"
    ) -> TableSpec:
        """Read one table's spec out of catalog DataFrames."""
        rows = columns.filter(F.col("table_name") == table).orderBy("ordinal").collect()
        if not rows:
            raise LookupError(f"table {table!r} not found")
        found = (
            checks.filter(F.col("table_name") == table).orderBy("name").collect()
            if checks is not None
            else []
        )
        return cls(
            table,
            tuple(
                ColumnSpec(
                    r["name"], r["type"], r["nullable"], r["is_pk"], r["is_unique"],
                    r["fk_ref"] or "", r["unsigned"], r["length"], r["precision"], r["scale"],
                    tuple(r["values"] or ()),
                )
                for r in rows
            ),
            tuple(CheckSpec(r["name"], r["expr"]) for r in found),
            dialect=dialect,
        )


def columns_frame(spark: SparkSession, specs: list[TableSpec], database: str = "") -> DataFrame:
    """Declared specs as a columns catalog."""
    rows = [
        (
            database, s.name, i, c.name, c.base, c.nullable, c.is_pk, c.unique, c.fk_ref, c.unsigned,
            c.length, c.precision, c.scale, list(c.values),
        )
        for s in specs
        for i, c in enumerate(s.columns, start=1)
    ]
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def checks_frame(spark: SparkSession, specs: list[TableSpec], database: str = "") -> DataFrame:
    """Declared CHECKs as a checks catalog."""
    from rowsluice.operators.checks import referenced_columns

    rows = [
        (
            database, s.name, k.name, k.expr,
            referenced_columns(k.expr, [c.name for c in s.columns], s.dialect),
        )
        for s in specs
        for k in s.checks
    ]
    return spark.createDataFrame(rows, CHECK_SCHEMA)
