"""Synthetic rows that satisfy a table's declared constraints.

Every value is seeded integer arithmetic over the row number, so a table of
any size is generated in parallel, without a shuffle, and a lost task makes
the same rows again. Parents of a table of n rows have keys 1..n, which is
how children find them.
"""

from __future__ import annotations

import ast
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsluice.functions.families import FAMILIES, integer_bounds
from rowsluice.operators.checks import UnsupportedCheck, list_items, normalize_check, parse_check, range_ends
from rowsluice.operators.spec import ColumnSpec, TableSpec

DEFAULT_ROWS = 100
MULTIPLIER, STEP = 48_271, 11
DEFAULT_SPAN = 1_000


@dataclass
class Limits:
    """What constant CHECKs leave of a column's domain."""

    low: float | None = None
    high: float | None = None
    choices: list | None = None

    def narrow(self, low=None, high=None):
        if low is not None:
            self.low = low if self.low is None else max(self.low, low)
        if high is not None:
            self.high = high if self.high is None else min(self.high, high)


def constant_limits(spec: TableSpec) -> dict[str, Limits]:
    """Bounds and lists from CHECKs that are conjunctions of constant tests."""
    limits: dict[str, Limits] = {}
    for check in spec.checks:
        try:
            tree, leaves = parse_check(normalize_check(check.expr), spec.dialect)
        except UnsupportedCheck:
            continue
        parts = tree.values if isinstance(tree, ast.BoolOp) and isinstance(tree.op, ast.And) else [tree]
        for part in parts:
            _apply(part, leaves, limits)
    return limits


def _constant(node, leaves):
    if isinstance(node, ast.UnaryOp) and isinstance(node.operand, ast.Name):
        return -leaves[node.operand.id].value
    if isinstance(node, ast.Name) and leaves[node.id].kind != "name":
        return leaves[node.id].value
    return None


def _apply(part, leaves, limits) -> None:
    if not (isinstance(part, ast.Compare) and isinstance(part.left, ast.Name)):
        return
    subject = leaves[part.left.id]
    if subject.kind != "name":
        return
    found = limits.setdefault(subject.value, Limits())
    op, right = part.ops[0], part.comparators[0]
    if isinstance(op, ast.In):
        ends = range_ends(right)
        if ends:
            found.narrow(*[_constant(e, leaves) for e in ends])
        else:
            choices = [_constant(i, leaves) for i in list_items(right)]
            if all(c is not None for c in choices):
                found.choices = choices
        return
    value = _constant(right, leaves)
    if value is None:
        return
    if isinstance(op, ast.Eq):
        found.choices = [value]
    elif isinstance(value, str):
        return
    elif isinstance(op, ast.GtE):
        found.narrow(low=value)
    elif isinstance(op, ast.Gt):
        found.narrow(low=value + 1)
    elif isinstance(op, ast.LtE):
        found.narrow(high=value)
    elif isinstance(op, ast.Lt):
        found.narrow(high=value - 1)


def _mixed(row: Column, salt: int, span: int) -> Column:
    """A number in 0..span-1 that varies with the row and the column."""
    return F.pmod(row * F.lit(MULTIPLIER) + F.lit(salt * STEP), F.lit(span))


def generate_rows(
    spark: SparkSession,
    spec: TableSpec,
    rows: int = DEFAULT_ROWS,
    parent_rows: dict[str, int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``rows`` rows of a table. ``parent_rows`` gives the size of every parent."""
    if rows < 1:
        raise ValueError("rows must be >= 1")
    parent_rows = {**(parent_rows or {}), spec.name: rows}
    base = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    limits = constant_limits(spec)
    key = [c for c in spec.columns if c.is_pk]
    columns = [
        _column(spec, c, i, F.col("id"), rows, parent_rows, limits.get(c.name.lower(), Limits()), key)
        for i, c in enumerate(spec.columns, start=1)
    ]
    return base.select(*columns)


def _column(spec, col: ColumnSpec, salt, row, rows, parent_rows, limits, key) -> Column:
    parent = col.fk_ref.split(".", 1)[0] if "." in col.fk_ref else ""
    size = parent_rows.get(parent, 0)
    alone = col.unique or (col.is_pk and len(key) == 1)
    if col.is_pk and len(key) > 1:
        value = _key_part(col, row, rows, parent_rows, key) + 1
    elif size and alone:
        if rows > size:
            raise ValueError(f"{spec.name}.{col.name}: {rows} rows cannot be unique among {size} parents")
        value = row + 1
    elif size:
        # A row may only refer to itself or earlier rows of its own table.
        value = F.pmod(row * F.lit(MULTIPLIER), row + 1) + 1 if parent == spec.name else _mixed(row, salt, size) + 1
    elif alone:
        value = row + 1
    else:
        return _free_value(col, salt, row, limits).cast(col.spark_type).alias(col.name)
    return _fitting(spec, col, value, rows).cast(col.spark_type).alias(col.name)


def _key_part(col, row, rows, parent_rows, key) -> Column:
    """Composite keys: row number in mixed radix, one digit per key column."""
    radixes = []
    for k in key[:-1]:
        parent = k.fk_ref.split(".", 1)[0]
        radixes.append(max(1, parent_rows.get(parent, 0) or round(rows ** (1 / len(key))) or 1))
    digit = row
    for k, radix in zip(key, [*radixes, None], strict=True):
        if k is col:
            return digit if radix is None else F.pmod(digit, F.lit(radix))
        digit = F.call_function("div", digit, F.lit(radix).cast("bigint"))
    raise LookupError(col.name)


def _fitting(spec, col: ColumnSpec, number: Column, rows: int) -> Column:
    """A key number in the type of its column, if all of them fit."""
    bounds = integer_bounds(col.base, col.unsigned, strict=True)
    if bounds:
        if rows > bounds[1]:
            raise ValueError(f"{spec.name}.{col.name}: {rows} keys do not fit {col.type}")
        return number
    if isinstance(col.spark_type, T.StringType):
        prefix = f"{col.name}-"
        if col.length and len(prefix) + len(str(rows)) > col.length:
            prefix = ""
        if col.length and len(str(rows)) > col.length:
            raise ValueError(f"{spec.name}.{col.name}: {rows} keys do not fit length {col.length}")
        return F.concat(F.lit(prefix), number.cast("string"))
    return number


def _free_value(col: ColumnSpec, salt: int, row: Column, limits: Limits) -> Column:
    choices = limits.choices or list(col.values)
    if choices:
        pick = _mixed(row, salt, len(choices)).cast("int") + 1
        return F.element_at(F.array(*[F.lit(c) for c in choices]), pick)
    bounds = integer_bounds(col.base, col.unsigned, strict=True)
    if bounds or col.base in FAMILIES["number"]:
        low = bounds[0] if bounds and bounds[0] == 0 else 0
        high = min(bounds[1], DEFAULT_SPAN) if bounds else DEFAULT_SPAN
        if limits.low is not None:
            low, high = limits.low, max(high, limits.low + DEFAULT_SPAN)
        if limits.high is not None:
            high, low = limits.high, min(low, limits.high) if limits.low is None else low
        if bounds:
            high = min(high, bounds[1])
        if high < low:
            raise ValueError(f"{col.name}: no value satisfies its constraints")
        if col.precision and not bounds:
            high = min(high, 10 ** (col.precision - col.scale) - 1)
        return _mixed(row, salt, int(high) - int(low) + 1) + F.lit(int(low))
    if col.base in FAMILIES["boolean"]:
        return _mixed(row, salt, 2) == 1
    if isinstance(col.spark_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_seconds(F.lit(1_704_067_200) + _mixed(row, salt, 86_400 * 365))
    if col.base in ("json", "jsonb"):
        return F.concat(F.lit('{"n":'), _mixed(row, salt, DEFAULT_SPAN).cast("string"), F.lit("}"))
    if col.base == "uuid":
        digest = F.md5(F.concat_ws("-", F.lit(str(salt)), row.cast("string")))
        return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    text = F.concat(F.lit(f"{col.name}-"), _mixed(row, salt, DEFAULT_SPAN).cast("string"))
    return F.substring(text, 1, col.length) if col.length else text


def generate_tables(
    spark: SparkSession, specs: list[TableSpec], rows: dict[str, int]
) -> dict[str, DataFrame]:
    """Rows for several tables; children point at the generated parents."""
    return {
        s.name: generate_rows(spark, s, rows.get(s.name, DEFAULT_ROWS), rows) for s in specs
    }
