"""Matching schemas to targets and foreign-key edges between tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsluice.functions.families import types_fit
from rowsluice.functions.text import base_type, reference_table, split_reference
from rowsluice.operators.spec import TableSpec

TABLE = ["database", "table_name"]


def match_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Every source column with its state in the target table.

    Both frames have ``database, table_name, name, type``. Names match without
    regard to case; extra target columns are fine. ``state`` is ``ok``,
    ``missing`` or ``mismatch`` and ``problem`` says what is wrong.
    """
    wanted = target.select(
        *TABLE, F.lower("name").alias("_key"), F.col("type").alias("target_type")
    )
    # Base types get columns of their own: the family test mentions each often.
    joined = (
        source.withColumn("_key", F.lower("name"))
        .join(wanted, [*TABLE, "_key"], "left")
        .withColumn("_source", base_type(F.col("type")))
        .withColumn("_target", base_type(F.col("target_type")))
    )
    fits = types_fit(F.col("_source"), F.col("_target"))
    state = (
        F.when(F.col("target_type").isNull(), "missing")
        .when(~fits, "mismatch")
        .otherwise("ok")
    )
    problem = F.when(
        F.col("state") == "missing",
        F.concat(F.lit('no target column "'), "name", F.lit('"')),
    ).when(
        F.col("state") == "mismatch",
        F.concat(
            F.lit('"'), "name", F.lit('": '), "type", F.lit(" does not go into "), "target_type"
        ),
    )
    return joined.withColumn("state", state).withColumn("problem", problem).drop("_key", "_source", "_target")


def schema_subset(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per source table: whether it fits its target, and all problems.

    ``source`` needs an ``ordinal`` column for the order of the problems.
    """
    listed = F.sort_array(
        F.collect_list(F.when(F.col("problem").isNotNull(), F.struct("ordinal", "problem")))
    )
    return (
        match_columns(source, target)
        .groupBy(*TABLE)
        .agg(F.array_join(listed["problem"], "\n").alias("problems"))
        .withColumn("ok", F.col("problems") == "")
    )


def spec_problems(columns: list[tuple[str, str]], spec: TableSpec) -> list[str]:
    """The same check for one table on the driver, before a load starts."""
    from rowsluice.functions.families import ACCEPTED_BY, FAMILIES
    from rowsluice.functions.text import base_type_of

    problems = []
    for name, declared in columns:
        target = spec.column(name)
        if target is None:
            problems.append(f'no target column "{name}"')
            continue
        have, want = base_type_of(declared), target.base
        together = any(have in family and want in family for family in FAMILIES.values())
        if not (have == want or together or want in ACCEPTED_BY.get(have, ())):
            problems.append(f'"{name}": {declared} does not go into {target.type}')
    return problems


def keys_outside(keys: Column, target_columns: list[str]) -> Column:
    """Row keys that are not target columns, ignoring case, in sorted order."""
    known = F.array(*[F.lit(c.lower()) for c in target_columns])
    return F.sort_array(F.filter(keys, lambda k: ~F.array_contains(known, F.lower(k))))


def fk_edges(columns: DataFrame, selection: DataFrame | None = None) -> DataFrame:
    """Parent edges of tables: ``database, child, parent, ordinal``.

    Malformed references are dropped, each parent counts once at its first
    column, and with a ``selection`` (``database, table_name``) both ends have
    to be in it.
    """
    edges = (
        columns.select(
            "database",
            F.col("table_name").alias("child"),
            reference_table(F.col("fk_ref")).alias("parent"),
            "ordinal",
        )
        .filter(F.col("parent").isNotNull())
        .groupBy("database", "child", "parent")
        .agg(F.min("ordinal").alias("ordinal"))
    )
    if selection is None:
        return edges
    chosen = selection.select(*TABLE)
    return edges.join(
        chosen.withColumnRenamed("table_name", "parent"), ["database", "parent"], "left_semi"
    ).join(chosen.withColumnRenamed("table_name", "child"), ["database", "child"], "left_semi")


def fk_pruned(columns: DataFrame, selection: DataFrame) -> DataFrame:
    """References whose target table is selected: column, ref table, ref column."""
    table, column = split_reference(F.col("fk_ref"))
    return (
        columns.select(*TABLE, "ordinal", "name", table.alias("ref_table"), column.alias("ref_column"))
        .filter(F.col("ref_table").isNotNull())
        .join(
            selection.select("database", F.col("table_name").alias("ref_table")),
            ["database", "ref_table"],
            "left_semi",
        )
    )
