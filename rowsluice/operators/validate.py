"""Row validation against declared constraints, set at a time.

Every row-local rule is a boolean Column, so all rules of a table run in one
pass over it inside whole-stage codegen. Uniqueness needs one aggregation per
key. A rule's ``bad`` is TRUE where the row violates it; NULL and FALSE pass.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsluice.functions.cells import READINGS, Cell, frame_cells, unpinned, variant_text, with_cells
from rowsluice.functions.families import integer_bounds
from rowsluice.functions.text import WHITE_SPACE
from rowsluice.functions.variants import writable_as
from rowsluice.operators.checks import compile_checks
from rowsluice.operators.keys import duplicate_keys, flag_repeats, repeated_rows
from rowsluice.operators.spec import ColumnSpec, TableSpec

# Position that puts table-wide rules (CHECKs) after all column rules.
AFTER_COLUMNS = 1_000_000
HIT = "struct<ordinal:int,column_name:string,rule:string,value:string,message:string>"


class ValidationFailed(RuntimeError):
    """Raised in abort mode; carries the first violation in row order."""

    def __init__(self, violation):
        super().__init__(f"refused before writing: {violation['message']}")
        self.violation = violation


@dataclass(frozen=True)
class Rule:
    column: str
    ordinal: int
    name: str
    bad: Column
    value: Column
    message: Column


def _message(*parts) -> Column:
    return F.concat(
        *[F.coalesce(p, F.lit("null")) if isinstance(p, Column) else F.lit(p) for p in parts]
    )


# ---- one rule per kind of constraint --------------------------------------


def not_null_rule(col: ColumnSpec, cell: Cell) -> Column | None:
    return None if col.nullable else cell.null_given()


def listed_rule(col: ColumnSpec, cell: Cell) -> Column | None:
    """Enum membership, or for ``set`` membership of every comma-separated part."""
    if col.base not in ("enum", "set") or not col.values:
        return None
    text = cell.text()
    if text is None:
        return ~cell.empty()
    if col.base == "enum":
        outside = ~text.isin(*col.values)
    else:
        outside = ~text.rlike(set_pattern(col.values))
    if cell.raw:
        return F.when(text.isNull(), ~cell.empty()).otherwise(outside)
    return outside


def set_pattern(members: tuple[str, ...]) -> str:
    """Comma-separated members, each with white space around it allowed.

    One pattern keeps the rule inside generated code, which splitting and
    comparing arrays would leave. Parts have no comma and are trimmed, so
    members that are not like that can never occur.
    """
    possible = [m for m in members if "," not in m and m == m.strip(WHITE_SPACE)]
    part = r"\s*(?:" + "|".join(map(re.escape, possible)) + r")\s*" if possible else "(?!)"
    return rf"(?U)\A{part}(?:,{part})*\z"


def range_rule(col: ColumnSpec, cell: Cell, strict: bool) -> Column | None:
    bounds = integer_bounds(col.base, col.unsigned, strict)
    value = cell.integer()
    if bounds is None or value is None:
        return None
    low, high = (F.lit(b) if abs(b) < 2**63 else F.lit(str(b)).cast("decimal(20,0)") for b in bounds)
    return (value < low) | (value > high)


def length_rule(col: ColumnSpec, cell: Cell) -> Column | None:
    """Length in code points; applies to text values whatever the declared type."""
    text = cell.text()
    if col.length <= 0 or text is None:
        return None
    return F.char_length(text) > col.length


def type_rule(col: ColumnSpec, cell: Cell) -> Column | None:
    """Raw values their target column could not hold without loss (lake targets only)."""
    if not cell.raw:
        return None
    return ~cell.empty() & writable_as(cell.col, col.spark_type).isNull()


def column_rules(
    col: ColumnSpec, ordinal: int, cell: Cell, strict: bool, convertible: bool = False
) -> list[Rule]:
    name, shown = col.name, cell.shown()
    bounds = integer_bounds(col.base, col.unsigned, strict) or ("", "")
    found = [
        ("not_null", not_null_rule(col, cell), _message(f'"{name}": a value is required')),
        (
            col.base if col.base == "set" else "enum",
            listed_rule(col, cell),
            _message(f'"{name}": "', shown, f'" is not among {", ".join(col.values)}'),
        ),
        (
            "range",
            range_rule(col, cell, strict),
            _message(f'"{name}": ', shown, f" lies outside {bounds[0]} to {bounds[1]}"),
        ),
        (
            "length",
            length_rule(col, cell),
            _message(
                f'"{name}": length ', F.char_length(shown).cast("string"), f" is above {col.length}"
            ),
        ),
    ]
    if strict or convertible:
        found.append(
            (
                "type",
                type_rule(col, cell),
                _message(f'"{name}": "', shown, f'" cannot become {col.type}'),
            )
        )
    return [Rule(name, ordinal, rule, bad, shown, text) for rule, bad, text in found if bad is not None]


@dataclass(frozen=True)
class Validator:
    """Validation of one table.

    ``row`` names the raw ``map<string,variant>`` column of a JSON source; a
    typed frame has none. ``order`` names the columns that define row order:
    files carry no order of their own, so "first" always means first by these.
    ``convertible`` adds the rule that raw values fit their target type, which
    loads need as lake tables would hold NULL instead; ``strict`` adds it too
    and also checks 64-bit ranges.
    ``extra_rules`` maps a rule name to a Column that is TRUE for good rows.
    """

    spec: TableSpec
    order: tuple[str, ...]
    row: str | None = None
    strict: bool = False
    convertible: bool = False
    extra_rules: dict[str, Callable[[], Column]] = field(default_factory=dict)

    # -- rules --------------------------------------------------------------
    def cells(self, df: DataFrame) -> dict[str, Cell]:
        return frame_cells(df, self.row, [c.name for c in self.spec.columns])

    def prepared(self, df: DataFrame) -> DataFrame:
        """The frame the rules are to be evaluated over."""
        if self.row is None:
            return df
        return with_cells(
            df, self.row, [c.name for c in self.spec.columns], variant_text, READINGS
        )

    def checks(self, df: DataFrame):
        """(compiled CHECKs, skipped ones as (name, expr, reason))."""
        return compile_checks(self.spec.checks, self.cells(df), self.spec.dialect)

    def unknown_columns(self, df: DataFrame) -> list[str]:
        """Columns of a typed frame that the target lacks (besides the row order)."""
        if self.row is not None:
            return []
        return [
            f for f in df.columns if self.spec.column(f) is None and f not in self.order
        ]

    def rules(self, df: DataFrame) -> list[Rule]:
        cells = self.cells(df)
        rules = []
        if self.row is not None:
            known = F.array(*[F.lit(c.name.lower()) for c in self.spec.columns])
            extra = F.array_except(F.map_keys(self.row), known)
            rules.append(
                Rule(
                    "", 0, "unknown_column", F.size(extra) > 0, F.array_join(F.sort_array(extra), ","),
                    _message('no target column for "', F.array_join(F.sort_array(extra), '", "'), '"'),
                )
            )
        for name in self.unknown_columns(df):
            rules.append(
                Rule(name, 0, "unknown_column", F.lit(True), F.lit(name), _message(f'no target column for "{name}"'))
            )
        for ordinal, col in enumerate(self.spec.columns, start=1):
            cell = cells.get(col.name.lower())
            if cell is not None:
                rules += column_rules(col, ordinal, cell, self.strict, self.convertible)
        for check in self.checks(df)[0]:
            shown = []
            for i, name in enumerate(check.columns):
                shown += [f"{', ' if i else ' with '}{name}=", cells[name.lower()].shown()]
            values = F.concat_ws(", ", *[cells[n.lower()].shown() for n in check.columns])
            rules.append(
                Rule(
                    check.name, AFTER_COLUMNS, "check", check.fails, values,
                    _message(f'CHECK "{check.name}" ({check.expr}) does not hold', *shown),
                )
            )
        for name, condition in self.extra_rules.items():
            rules.append(
                Rule(name, AFTER_COLUMNS, "custom", ~condition(), F.lit(None).cast("string"), _message(f'rule "{name}" does not hold'))
            )
        return rules

    def any_bad(self, df: DataFrame, total: bool = True) -> Column:
        """TRUE where a row breaks at least one row-local rule.

        Never NULL if ``total``; a filter needs no such guard, and without it
        the conditions reach the scan.
        """
        bad = [r.bad for r in self.rules(df)]
        if not bad:
            return F.lit(False)
        found = reduce(operator.or_, bad)
        return unpinned(df, F.coalesce(found, F.lit(False)) if total else found)

    # -- uniqueness ---------------------------------------------------------
    def keyed(self, df: DataFrame) -> tuple[DataFrame, list[tuple[list[str], tuple[str, ...]]]]:
        """The frame with key columns ready to group by, and the unique keys.

        VARIANT values cannot be grouped: a raw value is keyed by its kind and
        text, so the number 1 and the text "1" stay apart.
        """
        present = {c.lower() for c in df.columns}
        usable = []
        if self.row is None:
            for key in self.spec.unique_keys:
                if all(k.lower() in present for k in key):
                    usable.append((list(key), key))
            return df, usable
        cells = self.cells(df)
        added = {}
        for key in self.spec.unique_keys:
            names = []
            for k in key:
                cell = cells[k.lower()]
                added[f"_u_{k}"] = F.when(
                    ~cell.empty(),
                    F.concat(
                        F.when(cell.kind() == "STRING", "t").otherwise("v"),
                        F.coalesce(cell.text(), _number_text(cell), F.to_json(cell.col)),
                    ),
                )
                names.append(f"_u_{k}")
            usable.append((names, key))
        return df.withColumns(added) if added else df, usable

    def repeats(self, df: DataFrame) -> DataFrame | None:
        """Violations of every unique key, as rows like ``violations``."""
        keyed, keys = self.keyed(df)
        found = None
        for names, key in keys:
            label = ",".join(key)
            hits = repeated_rows(keyed, names, list(self.order))
            value = F.concat_ws(",", *[F.col(n).cast("string") for n in names])
            if self.row is not None:
                cells = self.cells(df)
                value = F.concat_ws(",", *[cells[k.lower()].shown() for k in key])
            first = F.col("first_row") if len(self.order) == 1 else F.to_json("first_row")
            part = hits.select(
                *self.order,
                F.lit(self.spec.by_name[key[0].lower()][0]).alias("ordinal"),
                F.lit(label).alias("column_name"),
                F.lit("unique").alias("rule"),
                value.alias("value"),
                _message(
                    f'"{label}": an earlier row has "', value, '" too (row ', first.cast("string"), ")"
                ).alias("message"),
            )
            found = part if found is None else found.unionByName(part)
        return found

    # -- results ------------------------------------------------------------
    def hits(self, prepared: DataFrame) -> Column:
        """The row-local violations of a row as an array; empty where it breaks no rule."""
        rules = self.rules(prepared)
        if not rules:
            return F.array().cast(f"array<{HIT}>")
        found = [
            F.when(
                r.bad,
                F.struct(
                    F.lit(r.ordinal).alias("ordinal"),
                    F.lit(r.column).alias("column_name"),
                    F.lit(r.name).alias("rule"),
                    r.value.alias("value"),
                    r.message.alias("message"),
                ),
            )
            for r in rules
        ]
        return F.array_compact(F.array(*found))

    def violations(self, df: DataFrame, unique: bool = True) -> DataFrame:
        """One row per violation: row order, table, column, rule, value, message."""
        prepared = self.prepared(df)
        parts = []
        if self.rules(prepared):
            # The plain filter goes first: reports are built for failing rows
            # only, and an outer explode keeps the optimizer from adding a
            # second, non-codegen copy of all rules as a filter of its own.
            parts.append(
                prepared.filter(self.any_bad(prepared, total=False))
                .select(*self.order, F.explode_outer(self.hits(prepared)).alias("hit"))
                .select(*self.order, "hit.*")
            )
        repeats = self.repeats(df) if unique else None
        if repeats is not None:
            parts.append(repeats)
        if not parts:  # nothing is declared about this table
            text = [F.lit("").alias(c) for c in ("column_name", "rule", "value", "message")]
            parts.append(
                df.filter(F.lit(False)).select(*self.order, F.lit(0).alias("ordinal"), *text)
            )
        return reduce(DataFrame.unionByName, parts).withColumn("table_name", F.lit(self.spec.name))

    def first_violation(self, df: DataFrame) -> DataFrame:
        """The violation a row-by-row check in row order would stop at."""
        return (
            self.violations(df)
            .orderBy(*self.order, "ordinal", "rule", "column_name")
            .limit(1)
        )

    def summary(self, df: DataFrame) -> DataFrame:
        """Violations per column and rule, zeros included; one pass plus one
        aggregation per unique key."""
        prepared = self.prepared(df)
        rules = self.rules(prepared)
        schema = "table_name string, column_name string, rule string, violations bigint"
        parts = []
        if rules:
            counts = prepared.agg(*[F.count_if(r.bad).alias(f"r{i}") for i, r in enumerate(rules)])
            rows = F.array(
                *[
                    F.struct(
                        F.lit(self.spec.name).alias("table_name"),
                        F.lit(r.column).alias("column_name"),
                        F.lit(r.name).alias("rule"),
                        F.col(f"r{i}").alias("violations"),
                    )
                    for i, r in enumerate(rules)
                ]
            )
            parts.append(counts.select(F.inline(rows)))
        keyed, keys = self.keyed(df)
        for names, key in keys:
            extra = duplicate_keys(keyed, names, count="_count").agg(
                F.coalesce(F.sum(F.col("_count") - 1), F.lit(0)).cast("bigint").alias("violations")
            )
            parts.append(
                extra.select(
                    F.lit(self.spec.name).alias("table_name"),
                    F.lit(",".join(key)).alias("column_name"),
                    F.lit("unique").alias("rule"),
                    "violations",
                )
            )
        if not parts:
            return df.sparkSession.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, parts)

    def flagged(self, df: DataFrame, name: str = "rejected") -> DataFrame:
        """Every row with a boolean telling whether it breaks any rule.

        Unique keys compete among rows that break no other rule: a rejected
        row does not keep its key from a later, corrected one.
        """
        prepared = self.prepared(df)
        out = prepared.select(*df.columns, self.any_bad(prepared).alias(name))
        keyed, keys = self.keyed(out)
        if not keys:
            return out
        return flag_repeats(keyed, [names for names, _ in keys], list(self.order), name).select(
            *df.columns, name
        )

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows that pass every rule, rows that do not)."""
        flagged = self.flagged(df)
        return (
            flagged.filter(~F.col("rejected")).drop("rejected"),
            flagged.filter(F.col("rejected")).drop("rejected"),
        )

    def check(self, df: DataFrame) -> None:
        """Raise on the first violation."""
        found = self.first_violation(df).collect()
        if found:
            raise ValidationFailed(found[0])


def _number_text(cell: Cell) -> Column:
    """Numbers by value: 1 and 1.0 are one key."""
    return F.when(
        cell.kind().isin("BIGINT", "DECIMAL"),
        F.regexp_replace(
            F.try_variant_get(cell.col, "$", "decimal(38,18)").cast("string"), r"\.?0+$", ""
        ),
    )
