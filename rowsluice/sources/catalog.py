"""Catalog operators over information-schema shaped DataFrames.

They work on all tables of all databases in one job. Inputs are plain frames,
read live over JDBC (``rowsluice.sources.jdbc``) or kept as lake tables:

* tables: ``database, table_name, table_type``
* columns: ``database, table_name, column_name, ordinal_position, data_type,
  column_type, is_nullable, character_maximum_length, numeric_precision,
  numeric_scale``
* constraints: ``database, table_name, constraint_name, constraint_type``
* key usage: ``database, table_name, constraint_name, column_name,
  ordinal_position``
* references: ``database, table_name, constraint_name, ordinal_position,
  ref_table, ref_column``
* check definitions: ``database, table_name, name, definition``

Constraints are matched by table as well as by name: two tables may use the
same constraint name. The columns of one table are few (databases cap them at
a few thousand), so grouping by table never builds large groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsluice.functions.text import base_type, enum_domain, known_int, strip_space
from rowsluice.operators.checks import check_names, normalized_check

TABLE = ["database", "table_name"]
CONSTRAINT = [*TABLE, "constraint_name"]


def list_tables(tables: DataFrame) -> DataFrame:
    """Base tables (no views), ordered by name."""
    return (
        tables.filter(F.col("table_type") == "BASE TABLE").select(*TABLE).orderBy(*TABLE)
    )


def table_exists(wanted: DataFrame, tables: DataFrame) -> DataFrame:
    """Each wanted table and whether it exists; views count here."""
    known = tables.select(*TABLE, F.lit(True).alias("found")).dropDuplicates(TABLE)
    return wanted.join(known, TABLE, "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def _keys_of_type(constraints: DataFrame, usage: DataFrame, kind: str) -> DataFrame:
    return usage.join(
        constraints.filter(F.col("constraint_type") == kind).select(*CONSTRAINT), CONSTRAINT
    )


def primary_keys(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """All columns of every primary key."""
    return _keys_of_type(constraints, usage, "PRIMARY KEY").select(*TABLE, "column_name")


def single_column_uniques(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """Columns that are unique on their own; parts of composite uniques are not."""
    return (
        _keys_of_type(constraints, usage, "UNIQUE")
        .groupBy(*CONSTRAINT)
        .agg(F.count(F.lit(1)).alias("n"), F.min("column_name").alias("column_name"))
        .filter(F.col("n") == 1)
        .select(*TABLE, "column_name")
        .distinct()
    )


def foreign_keys(constraints: DataFrame, usage: DataFrame, references: DataFrame) -> DataFrame:
    """Referencing columns with their ``fk_ref`` ("table.column").

    Composite keys are paired position by position. A column in several
    foreign keys keeps the reference that sorts first.
    """
    return (
        _keys_of_type(constraints, usage, "FOREIGN KEY")
        .join(references, [*CONSTRAINT, "ordinal_position"])
        .groupBy(*TABLE, "column_name")
        .agg(F.min(F.concat_ws(".", "ref_table", "ref_column")).alias("fk_ref"))
    )


def key_facts(constraints: DataFrame, usage: DataFrame, references: DataFrame) -> DataFrame:
    """Primary-key, unique and reference facts per column, from one pass over
    the key usage: one join per side and one aggregation, whatever the number
    of kinds of keys."""
    whole = W.partitionBy(*CONSTRAINT)
    kind = F.col("constraint_type")
    return (
        usage.join(constraints.select(*CONSTRAINT, "constraint_type"), CONSTRAINT)
        .withColumn("parts", F.count(F.lit(1)).over(whole))
        .join(references, [*CONSTRAINT, "ordinal_position"], "left")
        .groupBy(*TABLE, "column_name")
        .agg(
            F.max(kind == "PRIMARY KEY").alias("is_pk"),
            F.max((kind == "UNIQUE") & (F.col("parts") == 1)).alias("is_unique"),
            F.min(
                F.when(
                    (kind == "FOREIGN KEY") & F.col("ref_table").isNotNull(),
                    F.concat_ws(".", "ref_table", "ref_column"),
                )
            ).alias("fk_ref"),
        )
    )


def introspect(columns: DataFrame, facts: DataFrame) -> DataFrame:
    """The columns catalog: declared columns with their key facts."""
    return columns.join(facts, [*TABLE, "column_name"], "left").select(
        *TABLE,
        F.col("ordinal_position").cast("int").alias("ordinal"),
        F.col("column_name").alias("name"),
        base_type(F.col("data_type")).alias("type"),
        (F.upper("is_nullable") == "YES").alias("nullable"),
        F.coalesce("is_pk", F.lit(False)).alias("is_pk"),
        F.coalesce("is_unique", F.lit(False)).alias("is_unique"),
        F.coalesce("fk_ref", F.lit("")).alias("fk_ref"),
        F.lower("column_type").contains("unsigned").alias("unsigned"),
        known_int(F.col("character_maximum_length")).alias("length"),
        known_int(F.col("numeric_precision")).alias("precision"),
        known_int(F.col("numeric_scale")).alias("scale"),
        enum_domain(F.col("column_type")).alias("values"),
    )


def check_constraints(
    definitions: DataFrame, columns: DataFrame, dialect: str = "postgres"
) -> DataFrame:
    """CHECKs with normalized text and the columns they mention, in table order.

    ``columns`` is the columns catalog. Empty definitions are dropped; a CHECK
    without known columns keeps an empty list.
    """
    checks = definitions.select(
        *TABLE, "name", normalized_check(F.col("definition")).alias("expr")
    ).filter(F.col("expr") != "")
    mentioned = checks.select(
        *TABLE, "name", F.explode(check_names(F.col("expr"), dialect)).alias("lower_name")
    )
    in_order = (
        mentioned.join(
            columns.select(*TABLE, F.lower("name").alias("lower_name"), "ordinal", F.col("name").alias("column")),
            [*TABLE, "lower_name"],
        )
        .groupBy(*TABLE, "name")
        .agg(F.sort_array(F.collect_list(F.struct("ordinal", "column"))).alias("found"))
        .select(*TABLE, "name", F.col("found.column").alias("cols"))
    )
    return checks.join(in_order, [*TABLE, "name"], "left").withColumn(
        "cols", F.coalesce("cols", F.array().cast("array<string>"))
    )


def select_tables(requests: DataFrame, tables: DataFrame) -> DataFrame:
    """Resolve comma-separated table lists, one request per row.

    ``requests`` has ``database, request_id, wanted``; an empty ``wanted``
    selects every table of the database. Names are trimmed and keep their
    first position; order a selection by ``position, table_name``. Result:
    ``request_id, database, table_name, position, found``; a request with a
    row that was not ``found`` is to be refused.
    """
    known = list_tables(tables)
    listed = requests.filter(F.coalesce("wanted", F.lit("")) != "").select(
        "database",
        "request_id",
        F.posexplode(F.split("wanted", ",")).alias("position", "table_name"),
    )
    named = (
        listed.withColumn("table_name", strip_space(F.col("table_name")))
        .filter(F.col("table_name") != "")
        .groupBy("database", "request_id", "table_name")
        .agg(F.min("position").alias("position"))
        .join(known.withColumn("found", F.lit(True)), TABLE, "left")
        .withColumn("found", F.coalesce("found", F.lit(False)))
    )
    everything = (
        requests.filter(F.coalesce("wanted", F.lit("")) == "")
        .select("database", "request_id")
        .join(known.withColumn("position", F.lit(0)), "database")
        .withColumn("found", F.lit(True))
    )
    shape = ["request_id", "database", "table_name", "position", "found"]
    return named.select(shape).unionByName(everything.select(shape))


def selected_tables(
    available: list[str], single: str = "", several: str = ""
) -> list[str]:
    """The same for one request on the driver, raising what has to be refused."""
    if single and several:
        raise ValueError("a single table and a table list exclude each other")
    if not single and not several:
        return list(available)
    wanted = [single] if single else [t.strip() for t in several.split(",")]
    chosen = list(dict.fromkeys(t for t in wanted if t))
    unknown = [t for t in chosen if t not in set(available)]
    if unknown or not chosen:
        problem = f"table {unknown[0]!r} not found" if unknown else "no tables selected"
        raise LookupError(f"{problem} (available: {', '.join(available)})")
    return chosen


def lake_columns(df: DataFrame, database: str, table: str) -> DataFrame:
    """Columns rows of a lake table, from its Spark schema."""
    names = {
        "string": "text", "long": "bigint", "integer": "integer", "short": "smallint",
        "byte": "tinyint", "double": "double precision", "float": "real", "boolean": "boolean",
        "timestamp": "timestamptz", "timestamp_ntz": "timestamp", "date": "date",
    }
    rows = []
    for i, f in enumerate(df.schema.fields, start=1):
        kind = f.dataType.typeName()
        declared = names.get(kind, "json")
        precision = scale = None
        if kind == "decimal":
            declared, precision, scale = "numeric", f.dataType.precision, f.dataType.scale
        rows.append(
            (database, table, f.name, i, declared, declared, "YES" if f.nullable else "NO", None, precision, scale)
        )
    return df.sparkSession.createDataFrame(
        rows,
        "database string, table_name string, column_name string, ordinal_position int, "
        "data_type string, column_type string, is_nullable string, "
        "character_maximum_length bigint, numeric_precision bigint, numeric_scale bigint",
    )
