"""Catalog-shaped inputs derived from the sample tables.

Every order becomes one column of some table, eight columns to a table and
eight tables to a database, so catalogs and manifests grow with the data and
the catalog operators are exercised over all tables of all databases at once.
Priorities say which kind of key a column belongs to, statuses and prices vary
the rest. Each frame has the SQL text of the same derivation beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsluice.plans.registry import Tables

# Declared types as databases spell them.
RAW_TYPES = (
    "INTEGER", "character varying", "VARCHAR(40)", "double precision", " Numeric(10,2) ",
    "enum('a','it''s')", "SET('x','y')", "timestamp without time zone",
    "timestamp with time zone", "bigint", "tinyint(1)", "jsonb", "uuid", "character(8)",
    "longtext", "boolean",
)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


RAW_TYPES_SQL = "[" + ", ".join(sql_text(x) for x in RAW_TYPES) + "]"


def div(left: Column, right: int) -> Column:
    return F.call_function("div", left, F.lit(right).cast("bigint"))


def raw_type(number: Column) -> Column:
    types = F.array(*[F.lit(x) for x in RAW_TYPES])
    return F.element_at(types, (number % len(RAW_TYPES)).cast("int") + 1)


BASE_SQL = f"""
SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS p, o_orderstatus AS s,
       o_totalprice AS price, o_orderkey // 64 AS db, o_orderkey // 8 AS tab,
       'db' || (o_orderkey // 64) AS "database", 't' || (o_orderkey // 8) AS table_name,
       CAST(o_orderkey % 8 + 1 AS INT) AS ordinal,
       (CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'c' END) || (o_orderkey % 8 + 1) AS name,
       {RAW_TYPES_SQL}[o_custkey % {len(RAW_TYPES)} + 1] AS raw_type
FROM orders
"""


def base(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    ordinal = (key % 8 + 1).cast("int")
    return t.orders.select(
        key.alias("k"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderpriority").alias("p"),
        F.col("o_orderstatus").alias("s"),
        F.col("o_totalprice").alias("price"),
        div(key, 64).alias("db"),
        div(key, 8).alias("tab"),
        F.concat(F.lit("db"), div(key, 64).cast("string")).alias("database"),
        F.concat(F.lit("t"), div(key, 8).cast("string")).alias("table_name"),
        ordinal.alias("ordinal"),
        F.concat(
            F.when(F.col("o_orderstatus") == "F", "C").otherwise("c"), ordinal.cast("string")
        ).alias("name"),
        raw_type(F.col("o_custkey")).alias("raw_type"),
    )


# ---- tables of a schema ---------------------------------------------------

TABLES_SQL = f"""
SELECT "database", table_name,
       CASE WHEN max(price) > 480000 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
       CAST(any_value(tab) % 8 * 5 + 3 AS INT) % 8 AS position,
       CAST(floor(sum(price)) AS BIGINT) AS rows,
       CASE arg_min(s, k) WHEN 'F' THEN 'ready' WHEN 'O' THEN '' ELSE 'pending' END AS status
FROM ({BASE_SQL}) GROUP BY "database", table_name
"""


def tables(t: Tables) -> DataFrame:
    first_status = F.min_by("s", "k")
    return (
        base(t)
        .groupBy("database", "table_name")
        .agg(
            F.when(F.max("price") > 480000, "VIEW").otherwise("BASE TABLE").alias("table_type"),
            ((F.max("tab") % 8 * 5 + 3) % 8).cast("int").alias("position"),
            F.floor(F.sum("price")).alias("rows"),
            F.when(first_status == "F", "ready").when(first_status == "O", "").otherwise("pending").alias("status"),
        )
    )


# ---- columns catalog ------------------------------------------------------

FK_REF_SQL = """
CASE WHEN p <> '3-MEDIUM' THEN ''
     WHEN s = 'P' THEN CASE WHEN c % 2 = 0 THEN 'broken' ELSE 'ext' || c || '.id' END
     WHEN s = 'O' AND price > 400000 THEN 't' || (db * 8 + c % 8) || '.c2'
     ELSE 't' || (db * 8 + c % (tab % 8 + 1)) || '.c1' END
"""
BASE_TYPE_SQL = """
CASE trim(split_part(lower(trim({0})), '(', 1)) WHEN 'character varying' THEN 'varchar'
     WHEN 'character' THEN 'char' WHEN 'double precision' THEN 'float8'
     WHEN 'timestamp without time zone' THEN 'timestamp'
     WHEN 'timestamp with time zone' THEN 'timestamp'
     ELSE trim(split_part(lower(trim({0})), '(', 1)) END
"""
ENUM_SQL = """
CASE WHEN lower(trim({0})) LIKE 'enum(%' THEN ['a', 'it''s']
     WHEN lower(trim({0})) LIKE 'set(%' THEN ['x', 'y'] END
"""
COLUMNS_SQL = f"""
SELECT "database", table_name, ordinal, name, {BASE_TYPE_SQL.format("raw_type")} AS type,
       price > 100000 AS nullable, p = '1-URGENT' AS is_pk, p = '2-HIGH' AS is_unique,
       {FK_REF_SQL} AS fk_ref, s = 'P' AS unsigned,
       CASE WHEN price < 60000 THEN 0 ELSE CAST(c % 300 AS INT) END AS length,
       CAST(c % 11 AS INT) AS precision, CAST(c % 3 AS INT) AS scale,
       {ENUM_SQL.format("raw_type")} AS domain, c, k, tab
FROM ({BASE_SQL})
"""


def fk_ref() -> Column:
    def reference(table: Column, column: str) -> Column:
        return F.concat(F.lit("t"), (F.col("db") * 8 + table).cast("string"), F.lit(column))

    c = F.col("c")
    return (
        F.when(F.col("p") != "3-MEDIUM", "")
        .when(
            F.col("s") == "P",
            F.when(c % 2 == 0, "broken").otherwise(F.concat(F.lit("ext"), c.cast("string"), F.lit(".id"))),
        )
        .when((F.col("s") == "O") & (F.col("price") > 400000), reference(c % 8, ".c2"))
        .otherwise(reference(c % (F.col("tab") % 8 + 1), ".c1"))
    )


def columns(t: Tables) -> DataFrame:
    from rowsluice.functions.text import base_type, enum_domain

    return base(t).select(
        "database",
        "table_name",
        "ordinal",
        "name",
        base_type(F.col("raw_type")).alias("type"),
        (F.col("price") > 100000).alias("nullable"),
        (F.col("p") == "1-URGENT").alias("is_pk"),
        (F.col("p") == "2-HIGH").alias("is_unique"),
        fk_ref().alias("fk_ref"),
        (F.col("s") == "P").alias("unsigned"),
        F.when(F.col("price") < 60000, 0).otherwise((F.col("c") % 300).cast("int")).alias("length"),
        (F.col("c") % 11).cast("int").alias("precision"),
        (F.col("c") % 3).cast("int").alias("scale"),
        enum_domain(F.col("raw_type")).alias("values"),
    )


# ---- information schema ---------------------------------------------------

INFO_COLUMNS_SQL = f"""
SELECT "database", table_name, name AS column_name, ordinal AS ordinal_position,
       raw_type AS data_type,
       CASE WHEN s = 'P' THEN raw_type || ' UNSIGNED' ELSE raw_type END AS column_type,
       CASE WHEN price > 100000 THEN 'YES' ELSE 'no' END AS is_nullable,
       CASE WHEN price < 60000 THEN NULL WHEN price < 120000 THEN -1 ELSE c % 300 END AS character_maximum_length,
       CASE WHEN s = 'O' THEN c % 11 END AS numeric_precision,
       CASE WHEN s = 'O' THEN c % 3 END AS numeric_scale
FROM ({BASE_SQL})
"""


def info_columns(t: Tables) -> DataFrame:
    price, c, s = F.col("price"), F.col("c"), F.col("s")
    return base(t).select(
        "database",
        "table_name",
        F.col("name").alias("column_name"),
        F.col("ordinal").alias("ordinal_position"),
        F.col("raw_type").alias("data_type"),
        F.when(s == "P", F.concat("raw_type", F.lit(" UNSIGNED"))).otherwise(F.col("raw_type")).alias("column_type"),
        F.when(price > 100000, "YES").otherwise("no").alias("is_nullable"),
        F.when(price < 60000, None).when(price < 120000, -1).otherwise(c % 300).alias("character_maximum_length"),
        F.when(s == "O", c % 11).alias("numeric_precision"),
        F.when(s == "O", c % 3).alias("numeric_scale"),
    )


USAGE_SQL = f"""
SELECT "database", table_name, constraint_name, column_name, constraint_type,
       row_number() OVER (PARTITION BY table_name, constraint_name ORDER BY ordinal) AS ordinal_position,
       db, tab, c
FROM (SELECT *, name AS column_name,
             CASE p WHEN '1-URGENT' THEN 'pk' WHEN '2-HIGH' THEN 'uq_' || s WHEN '3-MEDIUM' THEN 'fk_' || s END AS constraint_name,
             CASE p WHEN '1-URGENT' THEN 'PRIMARY KEY' WHEN '2-HIGH' THEN 'UNIQUE' WHEN '3-MEDIUM' THEN 'FOREIGN KEY' END AS constraint_type
      FROM ({BASE_SQL})) WHERE constraint_name IS NOT NULL
"""


def _keyed(t: Tables) -> DataFrame:
    from pyspark.sql import Window as W

    p, s = F.col("p"), F.col("s")
    place = W.partitionBy("database", "table_name", "constraint_name").orderBy("ordinal")
    return (
        base(t)
        .withColumn(
            "constraint_name",
            F.when(p == "1-URGENT", "pk")
            .when(p == "2-HIGH", F.concat(F.lit("uq_"), s))
            .when(p == "3-MEDIUM", F.concat(F.lit("fk_"), s)),
        )
        .withColumn(
            "constraint_type",
            F.when(p == "1-URGENT", "PRIMARY KEY").when(p == "2-HIGH", "UNIQUE").when(p == "3-MEDIUM", "FOREIGN KEY"),
        )
        .filter(F.col("constraint_name").isNotNull())
        .withColumn("ordinal_position", F.row_number().over(place))
        .withColumnRenamed("name", "column_name")
    )


def usage(t: Tables) -> DataFrame:
    return _keyed(t).select("database", "table_name", "constraint_name", "column_name", "ordinal_position")


def constraints(t: Tables) -> DataFrame:
    return _keyed(t).select("database", "table_name", "constraint_name", "constraint_type").distinct()


def references(t: Tables) -> DataFrame:
    fk = _keyed(t).filter(F.col("constraint_type") == "FOREIGN KEY")
    parent = F.col("db") * 8 + F.col("c") % (F.col("tab") % 8 + 1)
    return fk.select(
        "database",
        "table_name",
        "constraint_name",
        "ordinal_position",
        F.concat(F.lit("t"), parent.cast("string")).alias("ref_table"),
        F.concat(F.lit("c"), F.col("ordinal_position").cast("string")).alias("ref_column"),
    )


# ---- CHECK definitions ----------------------------------------------------

# Text per number, the columns it mentions beside the {c} it is made for, and
# whether it can be evaluated.
CHECK_TEXTS = (
    ("CHECK (({c} >= 7))", ("{c}",), True),
    ("(`{c}` in (_utf8mb4'north',_utf8mb4'south'))", ("{c}",), True),
    ("CHECK ((octet_length({c}) < 40)) NOT VALID", ("{c}",), False),
    ("(\"{c}\" like 'x%')", ("{c}",), False),
    ("CHECK ((c1 <> c2)) NOT VALID", ("c1", "c2"), True),
    ("(c1 = (c2 + c3))", ("c1", "c2", "c3"), False),
    ("CHECK", (), True),
    ("({c} ~ 'y')", (), False),
    ("((c1 IS NOT NULL) OR ({c} > 'o''clock c2'))", ("c1", "{c}"), True),
    ("CHECK ((grade = ANY ((ARRAY['u'::text, 'v'::text])::text[])))", (), True),
)


def bare_check(text: str) -> str:
    body = text.removeprefix("CHECK").strip()
    return body.removesuffix("NOT VALID").strip()


def _per_check(render) -> str:
    cases = " ".join(f"WHEN {i} THEN {render(*x)}" for i, x in enumerate(CHECK_TEXTS))
    return f"CASE c % {len(CHECK_TEXTS)} {cases} END"


def _filled_sql(text: str) -> str:
    return "'" + text.replace("'", "''").replace("{c}", "' || name || '") + "'"


CHECKS_SQL = f"""
SELECT "database", table_name, 'ck' || k AS check_name, c,
       {_per_check(lambda text, cols, ok: _filled_sql(bare_check(text)))} AS expr,
       {_per_check(lambda text, cols, ok: "[" + ", ".join("lower(name)" if x == "{c}" else f"'{x}'" for x in cols) + "]")} AS mentioned,
       {_per_check(lambda text, cols, ok: "true" if ok else "false")} AS evaluable
FROM ({BASE_SQL}) WHERE p = '4-NOT SPECIFIED'
"""


def check_definitions(t: Tables) -> DataFrame:
    """Columns of one priority carry a CHECK; its text depends on the customer."""
    number = F.col("c") % len(CHECK_TEXTS)
    definition = F.lit(None).cast("string")
    for i, (text, _, _) in enumerate(CHECK_TEXTS):
        definition = F.when(number == i, F.replace(F.lit(text), F.lit("{c}"), F.col("name"))).otherwise(definition)
    return (
        base(t)
        .filter(F.col("p") == "4-NOT SPECIFIED")
        .select(
            "database",
            "table_name",
            F.concat(F.lit("ck"), F.col("k").cast("string")).alias("name"),
            definition.alias("definition"),
        )
    )


# ---- manifests ------------------------------------------------------------

MANIFEST_SQL = """
SELECT 's' || o_custkey AS schema_id, c_name AS name, lower(o_orderpriority) AS table_name,
       count(*) AS rows,
       CASE max(o_orderstatus) WHEN 'P' THEN 'pending' WHEN 'O' THEN '' ELSE 'ready' END AS status,
       strftime(min(o_orderdate), '%Y-%m-%d') AS created_at
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey, c_name, o_orderpriority
"""


def manifest(t: Tables) -> DataFrame:
    """A schema per customer with a table per order priority. Orders are
    aggregated before the join, so a busy customer costs few rows."""
    last = F.max("o_orderstatus")
    per_table = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("rows"),
        F.when(last == "P", "pending").when(last == "O", "").otherwise("ready").alias("status"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("created_at"),
    )
    return per_table.join(t.customer.select("c_custkey", "c_name"), "c_custkey").select(
        F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("schema_id"),
        F.col("c_name").alias("name"),
        F.lower("o_orderpriority").alias("table_name"),
        "rows",
        "status",
        "created_at",
    )
