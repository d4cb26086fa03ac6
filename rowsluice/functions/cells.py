"""One view over a cell, whether it sits in a typed column or in a raw JSON row.

Rules and CHECKs ask a cell for its text, its number or its exact integer and
get a Column back (or None where the declared type rules the reading out), so
one rule definition serves both typed frames and raw ``map<string,variant>``
rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsluice.functions.text import strip_space

# What counts as a number in text. Suffixes such as 1d, hexadecimal, NaN and
# infinities do not; Spark's cast alone would let some of them through.
DECIMAL_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
INTEGER_TEXT = r"^[+-]?[0-9]+$"

WIDE = "decimal(38,0)"


def number_in_text(text: Column) -> Column:
    """The double a text spells, or NULL when it spells none or overflows."""
    trimmed = strip_space(text)
    number = F.when(trimmed.rlike(DECIMAL_TEXT), trimmed.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def integer_in_text(text: Column) -> Column:
    """The exact integer a text spells; more than 38 digits saturate.

    A saturated value lies outside every declared integer range, which is all
    a range rule needs; NULL would let the overflow pass unseen.
    """
    trimmed = strip_space(text)
    huge = "9" * 38
    saturated = F.when(trimmed.startswith("-"), F.lit("-" + huge)).otherwise(F.lit(huge))
    return F.when(
        trimmed.rlike(INTEGER_TEXT),
        F.coalesce(trimmed.try_cast(WIDE), saturated.cast(WIDE)),
    )


@dataclass(frozen=True)
class Cell:
    """A named cell. ``family`` is what the plan knows about its type."""

    name: str
    family: str  # integer | number | text | boolean | time | nested | raw
    col: Column
    readings: dict[str, Column] | None = None  # of a raw cell, see with_cells

    # -- presence -----------------------------------------------------------
    def null_given(self) -> Column:
        """The cell is there and holds null (a missing key is not "given")."""
        return F.coalesce(F.is_variant_null(self.col), F.lit(False)) if self.raw else self.col.isNull()

    def empty(self) -> Column:
        """Null or missing: the operand of IS NULL."""
        if self.raw:
            return self.col.isNull() | F.is_variant_null(self.col)
        return self.col.isNull()

    # -- readings -----------------------------------------------------------
    @property
    def raw(self) -> bool:
        return self.family == "raw"

    def kind(self) -> Column:
        """Leading word of the JSON kind: STRING, BIGINT, OBJECT, VOID, ..."""
        return self.readings["kind"] if self.readings is not None else variant_kind(self.col)

    def text(self) -> Column | None:
        if self.family == "text":
            return self.col
        if self.raw:
            return self.readings["text"] if self.readings is not None else variant_text(self.col)
        return None

    def number(self) -> Column | None:
        """The value where it is a number by itself (booleans count as 1 and 0)."""
        if self.family in ("integer", "number"):
            return self.col
        if self.family == "boolean":
            return self.col.cast("int")
        if self.raw:
            return F.when(
                self.kind().isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN"),
                F.try_variant_get(self.col, "$", "double"),
            )
        return None

    def integer(self) -> Column | None:
        """The exact integer where the value is integral, else NULL."""
        if self.family == "integer":
            return self.col
        if self.family == "number":
            return F.when(self.col % 1 == 0, self.col)
        if self.family == "text":
            return integer_in_text(self.col)
        if self.raw:
            kind = self.kind()
            real = F.try_variant_get(self.col, "$", "double")
            exact = F.try_variant_get(self.col, "$", WIDE)
            edge = F.when(real < 0, F.lit("-" + "9" * 38)).otherwise(F.lit("9" * 38)).cast(WIDE)
            return (
                F.when(kind == "BIGINT", exact)
                .when(
                    kind.isin("DECIMAL", "DOUBLE", "FLOAT") & (real % 1 == 0),
                    F.coalesce(exact, edge),
                )
                .when(kind == "STRING", integer_in_text(self.text()))
            )
        return None

    def shown(self) -> Column:
        """The value as text, for reports."""
        if self.raw:
            return F.try_variant_get(self.col, "$", "string")
        if self.family == "nested":
            return F.to_json(self.col)
        return self.col.cast("string")


def variant_kind(value: Column) -> Column:
    described = F.schema_of_variant(value)
    return F.substring_index(F.substring_index(described, "<", 1), "(", 1)


def variant_text(value: Column) -> Column:
    return F.when(variant_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


READINGS = "_reading"
PIN = "_pin"


def pinned(df: DataFrame, columns: list[Column]) -> DataFrame:
    """The frame with further columns that are worked out once per row.

    The optimizer copies projected expressions into every filter above that
    mentions them, which for JSON readings multiplies the work. It leaves a
    projection alone that also holds a non-deterministic column, as long as
    that is used: filters over the new columns go through ``unpinned``.
    """
    return df.select("*", *columns, F.spark_partition_id().alias(PIN))


def unpinned(df: DataFrame, condition: Column) -> Column:
    """A condition that stays above the projection ``pinned`` made."""
    return condition & (F.col(PIN) >= 0) if PIN in df.columns else condition


def with_cells(df: DataFrame, row: str, names: list[str], text, prefix: str) -> DataFrame:
    """Raw rows with value, kind and text of the named cells worked out once.

    They are flat columns: structs that are only taken apart again would be
    dissolved, and their parts worked out at every mention.
    """
    cells = []
    for i, name in enumerate(names):
        value = F.col(row)[name.lower()]
        readings = {"value": value, "kind": variant_kind(value), "text": text(value)}
        cells += [reading.alias(f"{prefix}_{part}{i}") for part, reading in readings.items()]
    return pinned(df.drop(PIN), cells)


def cell_readings(prefix: str, position: int) -> dict[str, Column]:
    """The columns ``with_cells`` made for the cell at a position."""
    return {part: F.col(f"{prefix}_{part}{position}") for part in ("value", "kind", "text")}


def typed_cell(name: str, data_type: T.DataType, col: Column | None = None) -> Cell:
    col = F.col(f"`{name}`") if col is None else col
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        family = "integer"
    elif isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        family = "number"
    elif isinstance(data_type, T.StringType):
        family = "text"
    elif isinstance(data_type, T.BooleanType):
        family = "boolean"
    elif isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        family = "time"
    elif isinstance(data_type, T.VariantType):
        family = "raw"
    else:
        family = "nested"
    return Cell(name, family, col)


def raw_cell(name: str, row: Column) -> Cell:
    """A cell of a raw row whose keys were lower-cased by the JSON source."""
    return Cell(name, "raw", row[name.lower()])


def frame_cells(
    df: DataFrame, row: str | None = None, names: list[str] | None = None
) -> dict[str, Cell]:
    """Cells by lower-case name: of a typed frame, or of its raw ``row`` column."""
    if row is None:
        return {f.name.lower(): typed_cell(f.name, f.dataType) for f in df.schema.fields}
    if f"{READINGS}_kind0" not in df.columns:
        return {n.lower(): raw_cell(n, F.col(row)) for n in names or []}
    cells = {}
    for i, name in enumerate(names or []):
        readings = cell_readings(READINGS, i)
        cells[name.lower()] = Cell(name, "raw", readings["value"], readings)
    return cells
