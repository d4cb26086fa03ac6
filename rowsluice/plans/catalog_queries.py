"""Catalog queries: introspection, matching, ordering and descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsluice.functions.families import ACCEPTED_BY, FAMILIES, types_fit
from rowsluice.functions.text import base_type, ddl_type, display_type, enum_domain
from rowsluice.operators import describe, match, order
from rowsluice.operators.checks import skipped_checks
from rowsluice.plans import derived
from rowsluice.plans.derived import (
    BASE_SQL,
    BASE_TYPE_SQL,
    CHECKS_SQL,
    COLUMNS_SQL,
    ENUM_SQL,
    INFO_COLUMNS_SQL,
    RAW_TYPES_SQL,
    TABLES_SQL,
    USAGE_SQL,
)
from rowsluice.plans.registry import Tables, query
from rowsluice.sources import catalog

# ---- tables and keys ------------------------------------------------------


@query(
    "catalog_list_tables",
    f"SELECT \"database\", table_name FROM ({TABLES_SQL}) WHERE table_type = 'BASE TABLE'",
)
def catalog_list_tables(t: Tables) -> DataFrame:
    return catalog.list_tables(derived.tables(t))


@query(
    "catalog_table_exists",
    f"""
SELECT w.*, t.table_name IS NOT NULL AS found
FROM (SELECT c_custkey, 'db' || (c_custkey // 8) AS "database",
             't' || (c_custkey // 8 * 8 + c_nationkey % 10) AS table_name FROM customer) w
LEFT JOIN (SELECT "database", table_name FROM ({TABLES_SQL})) t
  ON t."database" = w."database" AND t.table_name = w.table_name
""",
)
def catalog_table_exists(t: Tables) -> DataFrame:
    db = derived.div(F.col("c_custkey"), 8)
    wanted = t.customer.select(
        "c_custkey",
        F.concat(F.lit("db"), db.cast("string")).alias("database"),
        F.concat(F.lit("t"), (db * 8 + F.col("c_nationkey") % 10).cast("string")).alias("table_name"),
    )
    return catalog.table_exists(wanted, derived.tables(t))


@query(
    "catalog_pk",
    f"SELECT \"database\", table_name, column_name FROM ({USAGE_SQL}) WHERE constraint_type = 'PRIMARY KEY'",
)
def catalog_pk(t: Tables) -> DataFrame:
    return catalog.primary_keys(derived.constraints(t), derived.usage(t))


UNIQUE_SQL = f"""
SELECT "database", table_name, min(column_name) AS column_name FROM ({USAGE_SQL})
WHERE constraint_type = 'UNIQUE'
GROUP BY "database", table_name, constraint_name HAVING count(*) = 1
"""
FK_SQL = f"""
SELECT "database", table_name, column_name,
       't' || (db * 8 + c % (tab % 8 + 1)) || '.c' || ordinal_position AS fk_ref
FROM ({USAGE_SQL}) WHERE constraint_type = 'FOREIGN KEY'
"""


@query("catalog_unique_single", UNIQUE_SQL)
def catalog_unique_single(t: Tables) -> DataFrame:
    return catalog.single_column_uniques(derived.constraints(t), derived.usage(t))


@query("catalog_fk", FK_SQL)
def catalog_fk(t: Tables) -> DataFrame:
    return catalog.foreign_keys(derived.constraints(t), derived.usage(t), derived.references(t))


@query(
    "catalog_columns",
    f"""
SELECT i."database", i.table_name, ordinal_position AS ordinal, i.column_name AS name,
       {BASE_TYPE_SQL.format("data_type")} AS type, is_nullable = 'YES' AS nullable,
       p.column_name IS NOT NULL AS is_pk, u.column_name IS NOT NULL AS is_unique,
       coalesce(fk_ref, '') AS fk_ref, column_type LIKE '%UNSIGNED' AS unsigned,
       CAST(greatest(coalesce(character_maximum_length, 0), 0) AS INT) AS length,
       CAST(coalesce(numeric_precision, 0) AS INT) AS precision,
       CAST(coalesce(numeric_scale, 0) AS INT) AS scale,
       array_to_string({ENUM_SQL.format("column_type")}, '|') AS domain
FROM ({INFO_COLUMNS_SQL}) i
LEFT JOIN (SELECT table_name, column_name FROM ({USAGE_SQL}) WHERE constraint_type = 'PRIMARY KEY') p
  ON p.table_name = i.table_name AND p.column_name = i.column_name
LEFT JOIN ({UNIQUE_SQL}) u ON u.table_name = i.table_name AND u.column_name = i.column_name
LEFT JOIN ({FK_SQL}) f ON f.table_name = i.table_name AND f.column_name = i.column_name
""",
)
def catalog_columns(t: Tables) -> DataFrame:
    facts = catalog.key_facts(derived.constraints(t), derived.usage(t), derived.references(t))
    found = catalog.introspect(derived.info_columns(t), facts)
    return found.withColumn("domain", F.array_join("values", "|")).drop("values")


# ---- CHECKs ---------------------------------------------------------------

CHECK_COLUMNS_SQL = f"""
SELECT k."database", k.table_name, check_name AS name, any_value(expr) AS expr,
       coalesce(string_agg(c.name, ',' ORDER BY c.ordinal) FILTER (c.name IS NOT NULL), '') AS cols
FROM ({CHECKS_SQL}) k
LEFT JOIN ({COLUMNS_SQL}) c ON c.table_name = k.table_name AND list_contains(mentioned, lower(c.name))
WHERE expr <> '' GROUP BY ALL
"""


def _checks(t: Tables) -> DataFrame:
    return catalog.check_constraints(derived.check_definitions(t), derived.columns(t), "mysql")


@query(
    "catalog_checks",
    f'SELECT "database", table_name, check_name AS name, expr FROM ({CHECKS_SQL}) WHERE expr <> \'\'',
)
def catalog_checks(t: Tables) -> DataFrame:
    return (
        _checks(t).select("database", "table_name", "name", "expr").orderBy("database", "table_name", "name")
    )


@query("check_columns", CHECK_COLUMNS_SQL)
def check_columns(t: Tables) -> DataFrame:
    return _checks(t).withColumn("cols", F.array_join("cols", ","))


@query(
    "check_skipped",
    f"""
SELECT "database", table_name, check_name AS name, expr FROM ({CHECKS_SQL})
WHERE expr <> '' AND NOT evaluable
""",
)
def check_skipped(t: Tables) -> DataFrame:
    return skipped_checks(_checks(t), "mysql").select("database", "table_name", "name", "expr")


# ---- types ----------------------------------------------------------------


@query("normalize_type", f"SELECT k, raw_type, {BASE_TYPE_SQL.format('raw_type')} AS type FROM ({BASE_SQL})")
def normalize_type(t: Tables) -> DataFrame:
    return derived.base(t).select("k", "raw_type", base_type(F.col("raw_type")).alias("type"))


@query("enum_domain", f"SELECT k, raw_type, array_to_string({ENUM_SQL.format('raw_type')}, '|') AS domain FROM ({BASE_SQL})")
def enum_domains(t: Tables) -> DataFrame:
    domain = F.array_join(enum_domain(F.col("raw_type")), "|")
    return derived.base(t).select("k", "raw_type", domain.alias("domain"))


def _listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


FITS_SQL = "({0} = {1}" + "".join(
    " OR ({0} IN " + _listed(m) + " AND {1} IN " + _listed(m) + ")" for m in FAMILIES.values()
) + "".join(" OR ({0} = '" + s + "' AND {1} IN " + _listed(m) + ")" for s, m in ACCEPTED_BY.items()) + ")"

TARGET_TYPE_SQL = f"{RAW_TYPES_SQL}[(c + CASE WHEN price > 300000 THEN k ELSE 0 END) % 16 + 1]"


def _target_type():
    shift = F.when(F.col("price") > 300000, F.col("k")).otherwise(0)
    return derived.raw_type(F.col("c") + shift)


@query(
    "type_compat",
    f"""
SELECT k, source, target, {FITS_SQL.format("source", "target")} AS fits
FROM (SELECT k, {BASE_TYPE_SQL.format("raw_type")} AS source, {BASE_TYPE_SQL.format("target_type")} AS target
      FROM (SELECT *, {TARGET_TYPE_SQL} AS target_type FROM ({BASE_SQL})))
""",
)
def type_compat(t: Tables) -> DataFrame:
    pairs = derived.base(t).select(
        "k", base_type(F.col("raw_type")).alias("source"), base_type(_target_type()).alias("target")
    )
    return pairs.withColumn("fits", types_fit(F.col("source"), F.col("target")))


DDL_TYPE_SQL = """
CASE WHEN type IN ('enum', 'set') THEN upper(type) || '(' || array_to_string(
            ['''' || replace(x, '''', '''''') || '''' FOR x IN domain], ',') || ')'
     WHEN type IN ('varchar', 'char') AND length > 0 THEN type || '(' || length || ')'
     WHEN type IN ('decimal', 'numeric', 'float', 'double') AND precision > 0 AND scale > 0
       THEN type || '(' || precision || ',' || scale || ')'
     WHEN type IN ('decimal', 'numeric', 'float', 'double') AND precision > 0 THEN type || '(' || precision || ')'
     WHEN unsigned THEN type || ' unsigned' ELSE type END
"""


@query(
    "ddl_type",
    f"""
SELECT "database", table_name, ordinal, ddl,
       CASE WHEN ddl LIKE 'ENUM(%' THEN 'enum' || substr(ddl, 5)
            WHEN ddl LIKE 'SET(%' THEN 'set' || substr(ddl, 4) ELSE ddl END AS shown
FROM (SELECT *, {DDL_TYPE_SQL} AS ddl FROM ({COLUMNS_SQL}))
""",
)
def ddl_types(t: Tables) -> DataFrame:
    rendered = ddl_type(*[F.col(c) for c in ("type", "length", "unsigned", "precision", "scale", "values")])
    return (
        derived.columns(t)
        .select("database", "table_name", "ordinal", rendered.alias("ddl"))
        .withColumn("shown", display_type(F.col("ddl")))
    )


# ---- selection and matching -----------------------------------------------

REQUESTS_SQL = """
SELECT 'db' || d AS "database", c_custkey AS request_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN ''
         WHEN 'MACHINERY' THEN 't' || (d * 8) || ', t' || (d * 8 + 1) || ',t' || (d * 8) || ', '
         WHEN 'FURNITURE' THEN 't' || (d * 8 + 7) || ',nope'
         WHEN 'AUTOMOBILE' THEN ' , ' ELSE 't' || (d * 8 + c_nationkey % 8) END AS wanted
FROM (SELECT *, c_custkey // 8 AS d FROM customer)
"""


@query(
    "select_tables",
    f"""
WITH base_tables AS (SELECT "database", table_name FROM ({TABLES_SQL}) WHERE table_type = 'BASE TABLE'),
named AS (
  SELECT "database", request_id, trim(part) AS table_name, min(position) - 1 AS position
  FROM (SELECT "database", request_id, unnest(string_split(wanted, ',')) AS part,
               unnest(range(1, len(string_split(wanted, ',')) + 1)) AS position
        FROM ({REQUESTS_SQL}) WHERE wanted <> '')
  WHERE trim(part) <> '' GROUP BY ALL)
SELECT n.request_id, n."database", n.table_name, CAST(n.position AS INT) AS position, b.table_name IS NOT NULL AS found
FROM named n LEFT JOIN base_tables b ON b."database" = n."database" AND b.table_name = n.table_name
UNION ALL
SELECT request_id, r."database", table_name, 0, true
FROM ({REQUESTS_SQL}) r JOIN base_tables b ON b."database" = r."database" WHERE wanted = ''
""",
)
def select_tables(t: Tables) -> DataFrame:
    d = derived.div(F.col("c_custkey"), 8)

    def table(number):
        return F.concat(F.lit("t"), (d * 8 + number).cast("string"))

    segment = F.col("c_mktsegment")
    wanted = (
        F.when(segment == "BUILDING", "")
        .when(segment == "MACHINERY", F.concat(table(0), F.lit(", "), table(1), F.lit(","), table(0), F.lit(", ")))
        .when(segment == "FURNITURE", F.concat(table(7), F.lit(",nope")))
        .when(segment == "AUTOMOBILE", " , ")
        .otherwise(table(F.col("c_nationkey") % 8))
    )
    requests = t.customer.select(
        F.concat(F.lit("db"), d.cast("string")).alias("database"),
        F.col("c_custkey").alias("request_id"),
        wanted.alias("wanted"),
    )
    return catalog.select_tables(requests, derived.tables(t))


@query(
    "schema_subset",
    f"""
SELECT "database", table_name, coalesce(string_agg(problem, chr(10) ORDER BY ordinal), '') AS problems,
       count(problem) = 0 AS ok
FROM (SELECT "database", table_name, ordinal,
             CASE WHEN p = '5-LOW' THEN 'no target column "' || name || '"'
                  WHEN NOT {FITS_SQL.format("source", "target")}
                    THEN '"' || name || '": ' || raw_type || ' does not go into ' || target_type
             END AS problem
      FROM (SELECT *, {BASE_TYPE_SQL.format("raw_type")} AS source, {BASE_TYPE_SQL.format("target_type")} AS target
            FROM (SELECT *, {TARGET_TYPE_SQL} AS target_type FROM ({BASE_SQL}))))
GROUP BY "database", table_name
""",
)
def schema_subset(t: Tables) -> DataFrame:
    base = derived.base(t)
    source = base.select("database", "table_name", "ordinal", "name", F.col("raw_type").alias("type"))
    target = base.filter(F.col("p") != "5-LOW").select(
        "database", "table_name", F.upper("name").alias("name"), _target_type().alias("type")
    )
    return match.schema_subset(source, target)


EDGES_SQL = f"""
SELECT "database", table_name AS child, split_part(fk_ref, '.', 1) AS parent, min(ordinal) AS ordinal
FROM ({COLUMNS_SQL}) WHERE fk_ref LIKE '_%.%' GROUP BY ALL
"""
READY_SQL = f"SELECT * FROM ({TABLES_SQL}) WHERE status IN ('', 'ready')"


@query(
    "fk_edges",
    f"""
SELECT "database", child, parent, ordinal FROM ({EDGES_SQL})
WHERE parent IN (SELECT table_name FROM ({TABLES_SQL}))
""",
)
def fk_edges(t: Tables) -> DataFrame:
    return match.fk_edges(derived.columns(t), derived.tables(t))


@query(
    "fk_pruned",
    f"""
SELECT "database", table_name, ordinal, name, split_part(fk_ref, '.', 1) AS ref_table,
       split_part(fk_ref, '.', 2) AS ref_column
FROM ({COLUMNS_SQL})
WHERE split_part(fk_ref, '.', 1) IN (SELECT table_name FROM ({READY_SQL})) AND fk_ref LIKE '_%._%'
""",
)
def fk_pruned(t: Tables) -> DataFrame:
    from rowsluice.sources.manifest import ready_tables

    return match.fk_pruned(derived.columns(t), ready_tables(derived.tables(t)))


# ---- load order -----------------------------------------------------------


def walk_sql(tables: str) -> str:
    """Longest walks from every table; eight steps within eight tables repeat one."""
    return f"""
WITH RECURSIVE nodes AS (SELECT * FROM ({tables})),
edges AS (SELECT e."database", child, parent, CAST(pp.position > cp.position AS INT) AS later
          FROM ({EDGES_SQL}) e
          JOIN nodes cp ON cp.table_name = child JOIN nodes pp ON pp.table_name = parent
          WHERE child <> parent),
walk(table_name, pass, steps) AS (
  SELECT table_name, 0, 0 FROM nodes
  UNION
  SELECT child, pass + later, steps + 1 FROM walk JOIN edges ON parent = table_name WHERE steps < 8),
passes AS (SELECT table_name, max(pass) AS pass, max(steps) >= 8 AS stuck FROM walk GROUP BY table_name)
"""


def _passes(t: Tables) -> DataFrame:
    tables = derived.tables(t).select("database", "table_name", "position")
    return order.load_passes(tables, match.fk_edges(derived.columns(t)))


@query(
    "load_order",
    walk_sql(TABLES_SQL)
    + """
SELECT n."database", n.table_name, n.position, CAST(p.pass AS INT) AS pass
FROM nodes n JOIN passes p ON p.table_name = n.table_name
WHERE n."database" NOT IN (SELECT "database" FROM nodes JOIN passes USING (table_name) WHERE stuck)
""",
)
def load_order(t: Tables) -> DataFrame:
    return order.load_order(_passes(t))


@query(
    "load_cycle",
    walk_sql(TABLES_SQL)
    + """
SELECT n."database", n.table_name FROM nodes n JOIN passes p ON p.table_name = n.table_name WHERE stuck
""",
)
def load_cycle(t: Tables) -> DataFrame:
    return order.stuck_tables(_passes(t))


# ---- descriptions ---------------------------------------------------------

PARSED_SQL = f"""
WITH cat AS (
  SELECT * EXCLUDE (length), CASE WHEN type IN ('varchar', 'char', 'binary', 'varbinary') THEN length ELSE 0 END AS length,
         '"' || name || '"' AS q
  FROM ({COLUMNS_SQL}) WHERE table_name IN (SELECT table_name FROM ({READY_SQL}))),
idx AS (
  SELECT table_name, 1 AS grp, 0 AS pos, '' AS sort_name, 'PRIMARY(' || string_agg(name, ',' ORDER BY ordinal) || ')' AS shown,
         '  PRIMARY KEY (' || string_agg(q, ', ' ORDER BY ordinal) || ')' AS line
  FROM cat WHERE is_pk GROUP BY table_name
  UNION ALL
  SELECT table_name, 2, ordinal, '', 'UNIQUE(' || name || ')', '  UNIQUE (' || q || ')' FROM cat WHERE is_unique AND NOT is_pk
  UNION ALL
  SELECT table_name, 3, ordinal, '', 'FOREIGN(' || name || ')',
         '  FOREIGN KEY (' || q || ') REFERENCES "' || split_part(fk_ref, '.', 1) || '" ("' || split_part(fk_ref, '.', 2) || '")'
  FROM cat WHERE fk_ref LIKE '_%._%' AND split_part(fk_ref, '.', 1) IN (SELECT table_name FROM ({READY_SQL}))
  UNION ALL
  SELECT table_name, 4, 0, name, 'CHECK(' || cols || ')', '  CHECK (' || expr || ')'
  FROM ({CHECK_COLUMNS_SQL}) WHERE cols <> '' AND table_name IN (SELECT table_name FROM cat)),
fields AS (
  SELECT "database", table_name,
         string_agg(name || ':' || type || ':' || nullable || ':' || length, '|' ORDER BY ordinal) AS fields,
         string_agg('  ' || q || ' ' || {DDL_TYPE_SQL} || CASE WHEN nullable THEN ' NULL' ELSE ' NOT NULL' END,
                    ',' || chr(10) ORDER BY ordinal) AS lines
  FROM cat GROUP BY ALL),
indexes AS (
  SELECT table_name, string_agg(shown, '|' ORDER BY grp, pos, sort_name) AS indexes,
         string_agg(line, ',' || chr(10) ORDER BY grp, pos, sort_name) AS lines
  FROM idx GROUP BY table_name)
SELECT f."database", f.table_name, fields, coalesce(indexes, '') AS indexes,
       'CREATE TABLE "' || f.table_name || '" (' || chr(10) || f.lines
       || coalesce(',' || chr(10) || i.lines, '') || chr(10) || ');' || chr(10) AS sql
FROM fields f LEFT JOIN indexes i ON i.table_name = f.table_name
"""


def _parsed(t: Tables) -> DataFrame:
    from rowsluice.sources.manifest import ready_tables

    return describe.parsed_tables(derived.columns(t), _checks(t), ready_tables(derived.tables(t)))


@query("parsed_tables", f'SELECT "database", table_name, fields, indexes FROM ({PARSED_SQL})')
def parsed_tables(t: Tables) -> DataFrame:
    fields = F.transform(
        "fields",
        lambda f: F.concat_ws(":", f["name"], f["type"], f["null"].cast("string"), f["length"].cast("string")),
    )
    indexes = F.transform(
        "indexes", lambda i: F.concat(i["type"], F.lit("("), F.array_join(i["cols"], ","), F.lit(")"))
    )
    return _parsed(t).select(
        "database", "table_name",
        F.array_join(fields, "|").alias("fields"), F.array_join(indexes, "|").alias("indexes"),
    )


@query("ddl_synth", f'SELECT "database", table_name, sql FROM ({PARSED_SQL})')
def ddl_synth(t: Tables) -> DataFrame:
    return _parsed(t).select("database", "table_name", "sql")


FINGERPRINT_SQL = f"""
SELECT "database", sha256('postgres|localhost|5432|' || "database" || '|'
                        || string_agg(table_name, ',' ORDER BY table_name)) AS fingerprint
FROM ({READY_SQL}) GROUP BY "database"
"""


def _fingerprints(t: Tables) -> DataFrame:
    from rowsluice.sources.manifest import ready_tables

    found = describe.fingerprints(
        ready_tables(derived.tables(t)), F.lit("postgres"), F.lit("localhost"), F.lit(5432)
    )
    return found.select("database", "fingerprint")


@query("fingerprint", FINGERPRINT_SQL)
def fingerprint(t: Tables) -> DataFrame:
    return _fingerprints(t)


# Databases whose tables hold few rows in all are the ones pulled before.
KNOWN_SQL = f"""
SELECT f.fingerprint, 'schema-' || f."database" AS schema_id FROM ({FINGERPRINT_SQL}) f
JOIN (SELECT "database", sum(rows) AS rows FROM ({TABLES_SQL}) GROUP BY "database") d ON d."database" = f."database"
WHERE d.rows < 16500000
"""


@query(
    "pull_action",
    f"""
SELECT r."database", r.c_custkey, r.fingerprint, k.schema_id,
       CASE WHEN k.schema_id IS NULL THEN 'create' WHEN r.force THEN 'recreate'
            WHEN r.regenerate THEN 'regenerate' ELSE 'reuse' END AS action
FROM (SELECT f."database", c_custkey, fingerprint, c_acctbal < 1000 AS force, c_mktsegment = 'BUILDING' AS regenerate
      FROM customer JOIN ({FINGERPRINT_SQL}) f ON f."database" = 'db' || (c_custkey // 8)) r
LEFT JOIN ({KNOWN_SQL}) k ON k.fingerprint = r.fingerprint
""",
)
def pull_action(t: Tables) -> DataFrame:
    prints = _fingerprints(t)
    sizes = derived.tables(t).groupBy("database").agg(F.sum("rows").alias("rows"))
    known = prints.join(sizes.filter(F.col("rows") < 16500000), "database").select(
        "fingerprint", F.concat(F.lit("schema-"), "database").alias("schema_id")
    )
    requests = t.customer.select(
        F.concat(F.lit("db"), derived.div(F.col("c_custkey"), 8).cast("string")).alias("database"),
        "c_custkey",
        (F.col("c_acctbal") < 1000).alias("force"),
        (F.col("c_mktsegment") == "BUILDING").alias("regenerate"),
    ).join(prints, "database")
    return describe.pull_actions(requests, known).drop("force", "regenerate")
