"""From source rows to the columns of a target table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsluice.functions.cells import cell_readings, with_cells
from rowsluice.functions.variants import converted, inferred_type, writable_text
from rowsluice.operators.spec import TableSpec


def write_projection(
    df: DataFrame, spec: TableSpec, row: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Target columns in declared order and type; absent ones are NULL.

    Raw rows are unwrapped and converted; typed frames are cast. ``keep`` names
    further columns to carry along (e.g. the row order).
    """
    present = {c.lower(): c for c in df.columns}
    if row is not None:
        df = with_cells(df, row, [c.name for c in spec.columns], writable_text, WRITTEN)

    def target(position, col) -> Column:
        if row is not None:
            value = converted(**cell_readings(WRITTEN, position), target=col.spark_type)
        elif col.name.lower() in present:
            value = F.col(f"`{present[col.name.lower()]}`").cast(col.spark_type)
        else:
            value = F.lit(None).cast(col.spark_type)
        return value.alias(col.name)

    names = {c.name.lower() for c in spec.columns}
    carried = [k for k in keep if k.lower() not in names]
    return df.select(*carried, *[target(i, c) for i, c in enumerate(spec.columns)])


WRITTEN = "_written"


def row_keys(row: Column) -> Column:
    return F.sort_array(F.map_keys(row))


def sorted_row(row: Column) -> Column:
    """The row with its keys in sorted order, for showing it."""
    keys = row_keys(row)
    return F.map_from_arrays(keys, F.transform(keys, lambda k: row[k]))


def first_row_columns(df: DataFrame, row: str, order: list[str], by: list[str] | None = None) -> DataFrame:
    """Sorted keys of the first row in row order (per group ``by``)."""
    first = F.min(F.struct(*order, row_keys(F.col(row)).alias("keys")))
    return df.groupBy(*(by or [])).agg(first["keys"].alias("columns"))


def all_columns(df: DataFrame, row: str, by: list[str] | None = None) -> DataFrame:
    """Sorted union of the keys of all rows (per group ``by``).

    Keys are made distinct before they are collected, so what is collected is
    a list of column names, not of rows.
    """
    keys = df.select(*(by or []), F.explode(F.map_keys(row)).alias("key")).distinct()
    return keys.groupBy(*(by or [])).agg(F.sort_array(F.collect_list("key")).alias("columns"))


def infer_schema(df: DataFrame, row: str, keep: list[str], exact: bool = False) -> DataFrame:
    """Name and inferred type of every key of every row."""
    cells = df.select(*keep, F.explode(row).alias("name", "value"))
    return cells.select(*keep, "name", inferred_type(F.col("value"), exact).alias("type"))
