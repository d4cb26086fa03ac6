"""Portable descriptions of tables: parsed shape, DDL text, fingerprints.

One row per table, built for all tables in one job. Arrays hold the columns
of one table, whose number databases cap at a few thousand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsluice.functions.text import ddl_type, quote_identifier, sized_length, split_reference

TABLE = ["database", "table_name"]


def parsed_tables(
    columns: DataFrame,
    checks: DataFrame | None = None,
    selection: DataFrame | None = None,
    max_check_bytes: int | None = None,
) -> DataFrame:
    """``database, table_name, fields, indexes, sql`` for every table.

    ``indexes`` come in the order PRIMARY, UNIQUE, FOREIGN, CHECK, each in
    column order (CHECKs by name). References to tables outside ``selection``
    are pruned, as are CHECKs without columns and, if a limit is given, those
    of more than ``max_check_bytes``.
    """
    ref_table, ref_column = split_reference(F.col("fk_ref"))
    prepared = columns.withColumn("ref_table", ref_table).withColumn("ref_column", ref_column)
    if selection is not None:
        chosen = selection.select(*TABLE)
        prepared = prepared.join(chosen, TABLE, "left_semi").join(
            chosen.select("database", F.col("table_name").alias("ref_table"), F.lit(True).alias("kept")),
            ["database", "ref_table"],
            "left",
        )
        prepared = prepared.withColumn("ref_table", F.when(F.col("kept"), F.col("ref_table")))
    field = F.struct(
        "ordinal", "name", "type", F.col("nullable").alias("null"),
        sized_length(F.col("type"), F.col("length")).alias("length"),
        "unsigned", "precision", "scale", "values", "is_pk", "is_unique", "ref_table", "ref_column",
    )
    grouped = prepared.groupBy(*TABLE).agg(F.sort_array(F.collect_list(field)).alias("c"))
    nothing = F.lit(None).cast("string")

    def index(kind, cols: Column, table=nothing, refs=None, expr=nothing) -> Column:
        return F.struct(
            F.lit(kind).alias("type"),
            cols.alias("cols"),
            table.alias("ref_table"),
            (refs if refs is not None else F.array().cast("array<string>")).alias("ref_cols"),
            expr.alias("expr"),
        )

    keys = F.filter("c", lambda c: c["is_pk"])["name"]
    uniques = F.filter("c", lambda c: c["is_unique"] & ~c["is_pk"])
    foreign = F.filter("c", lambda c: c["ref_table"].isNotNull() & c["ref_column"].isNotNull())
    indexes = F.concat(
        F.filter(F.array(index("PRIMARY", keys)), lambda i: F.size(i["cols"]) > 0),
        F.transform(uniques, lambda c: index("UNIQUE", F.array(c["name"]))),
        F.transform(
            foreign,
            lambda c: index("FOREIGN", F.array(c["name"]), c["ref_table"], F.array(c["ref_column"])),
        ),
    )
    tables = grouped.withColumn("indexes", indexes)
    if checks is not None:
        kept = checks.filter(F.size("cols") > 0)
        if max_check_bytes is not None:
            kept = kept.filter(F.octet_length("expr") <= max_check_bytes)
        by_table = kept.groupBy(*TABLE).agg(
            F.sort_array(F.collect_list(F.struct("name", "expr", "cols"))).alias("k")
        )
        check_indexes = F.transform("k", lambda k: index("CHECK", k["cols"], expr=k["expr"]))
        tables = tables.join(by_table, TABLE, "left").withColumn(
            "indexes",
            F.when(F.col("k").isNull(), F.col("indexes")).otherwise(
                F.concat("indexes", check_indexes)
            ),
        )
    fields = F.transform(
        "c",
        lambda c: F.struct(
            *[c[n].alias(n) for n in ("name", "type", "null", "length", "unsigned", "precision", "scale", "values")]
        ),
    )
    return tables.withColumn("fields", fields).select(
        *TABLE, "fields", "indexes", create_table(F.col("table_name"), F.col("fields"), F.col("indexes")).alias("sql")
    )


def _names(cols: Column) -> Column:
    return F.array_join(F.transform(cols, lambda c: quote_identifier(c)), ", ")


def create_table(table: Column, fields: Column, indexes: Column) -> Column:
    """Deterministic CREATE TABLE text; a description, never executed."""
    field_lines = F.transform(
        fields,
        lambda f: F.concat(
            F.lit("  "),
            quote_identifier(f["name"]),
            F.lit(" "),
            ddl_type(f["type"], f["length"], f["unsigned"], f["precision"], f["scale"], f["values"]),
            F.when(f["null"], " NULL").otherwise(" NOT NULL"),
        ),
    )
    index_lines = F.transform(
        indexes,
        lambda i: F.when(
            i["type"] == "PRIMARY", F.concat(F.lit("  PRIMARY KEY ("), _names(i["cols"]), F.lit(")"))
        )
        .when(
            (i["type"] == "UNIQUE") & (F.size(i["cols"]) == 1),
            F.concat(F.lit("  UNIQUE ("), _names(i["cols"]), F.lit(")")),
        )
        .when(
            (i["type"] == "FOREIGN") & (F.size(i["ref_cols"]) > 0),
            F.concat(
                F.lit("  FOREIGN KEY ("), _names(i["cols"]), F.lit(") REFERENCES "),
                quote_identifier(i["ref_table"]), F.lit(" ("), _names(i["ref_cols"]), F.lit(")"),
            ),
        )
        .when(i["type"] == "CHECK", F.concat(F.lit("  CHECK ("), i["expr"], F.lit(")"))),
    )
    lines = F.concat(field_lines, F.array_compact(index_lines))
    return F.concat(
        F.lit("CREATE TABLE "), quote_identifier(table), F.lit(" (\n"),
        F.array_join(lines, ",\n"), F.lit("\n);\n"),
    )


def fingerprints(selection: DataFrame, driver: Column, host: Column, port: Column) -> DataFrame:
    """The identity of a selection of tables per database: a SHA-256 digest of
    driver, host, port, database and its sorted table names.

    ``driver``, ``host`` and ``port`` may be literals or columns that are the
    same for all rows of a database.
    """
    names = selection.select(
        "database", "table_name", driver.alias("driver"), host.alias("host"), port.alias("port")
    )
    tables = F.array_join(F.sort_array(F.collect_list("table_name")), ",")
    return names.groupBy("database", "driver", "host", "port").agg(
        F.sha2(
            F.concat_ws("|", "driver", "host", F.col("port").cast("string"), "database", tables), 256
        ).alias("fingerprint")
    )


def pull_actions(requests: DataFrame, manifest: DataFrame) -> DataFrame:
    """What a pull does, by fingerprint: ``create``, ``recreate``, ``regenerate``
    or ``reuse``.

    ``requests`` has ``fingerprint, force, regenerate``; ``manifest`` has one
    row per known ``fingerprint`` with its ``schema_id``.
    """
    known = manifest.select("fingerprint", "schema_id")
    action = (
        F.when(F.col("schema_id").isNull(), "create")
        .when(F.col("force"), "recreate")
        .when(F.col("regenerate"), "regenerate")
        .otherwise("reuse")
    )
    return requests.join(known, "fingerprint", "left").withColumn("action", action)
