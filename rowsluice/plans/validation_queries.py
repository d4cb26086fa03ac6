"""Validation queries: declared constraints over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsluice.operators.keys import duplicate_keys, orphan_rows, repeated_rows
from rowsluice.operators.spec import CheckSpec, ColumnSpec, TableSpec
from rowsluice.operators.validate import Validator
from rowsluice.plans.registry import Tables, query
from rowsluice.sources.jsonl import rows_from_lines

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")  # one left out

ORDERS = TableSpec(
    "orders",
    (
        ColumnSpec("o_orderkey", "smallint", nullable=False, is_pk=True),
        ColumnSpec("o_custkey", "tinyint", unsigned=True, fk_ref="customer.c_custkey"),
        ColumnSpec("o_orderstatus", "enum", values=("F", "O")),
        ColumnSpec("o_totalprice", "decimal", precision=12, scale=2),
        ColumnSpec("o_orderpriority", "varchar", length=10),
    ),
    (
        CheckSpec("price_floor", "CHECK ((o_totalprice >= (20000)::numeric))"),
        CheckSpec("urgent_price", "((o_orderpriority <> '1-URGENT') OR (o_totalprice < 400000))"),
        CheckSpec("priority_text", "(char_length(o_orderpriority) > 3)"),
    ),
    composite_unique=(("o_custkey", "o_orderpriority"),),
)
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def report(violations: DataFrame, *rows: str) -> DataFrame:
    """Violations as compared: row, table, column, rule and value."""
    return violations.select(*rows, "table_name", "column_name", "rule", "value")


def column_report(df: DataFrame, table: str, row: list[str], *columns: ColumnSpec) -> DataFrame:
    spec = TableSpec(table, columns)
    slim = df.select(*row, *[c.name for c in columns if c.name not in row])
    return report(Validator(spec, tuple(row)).violations(slim, unique=False), *row)


def check_report(df: DataFrame, table: str, row: list[str], name: str, expr: str, dialect="postgres"):
    """Rows that violate one CHECK; only the columns it needs are read."""
    columns = tuple(ColumnSpec(f, "text") for f in df.columns if f not in row)
    spec = TableSpec(table, columns, (CheckSpec(name, expr),), dialect=dialect)
    return report(Validator(spec, tuple(row)).violations(df, unique=False), *row)


# ---- rules on single values -----------------------------------------------


@query(
    "validate_not_null",
    """
SELECT o_orderkey, 'orders' AS table_name, 'o_orderpriority' AS column_name,
       'not_null' AS rule, CAST(NULL AS VARCHAR) AS value
FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NULL
""",
)
def validate_not_null(t: Tables) -> DataFrame:
    df = t.orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return column_report(
        df, "orders", ["o_orderkey"], ColumnSpec("o_orderpriority", "varchar", nullable=False)
    )


@query(
    "validate_enum",
    """
SELECT o_orderkey AS row_id, 'orders' AS table_name, 'o_orderpriority' AS column_name,
       'enum' AS rule, o_orderpriority AS value
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
UNION ALL
SELECT event_id, 'events', 'event_type', 'enum', event_type
FROM events WHERE event_type NOT IN ('click', 'purchase', 'signup', 'view')
""",
)
def validate_enum(t: Tables) -> DataFrame:
    orders = column_report(
        t.orders.withColumnRenamed("o_orderkey", "row_id"), "orders", ["row_id"],
        ColumnSpec("o_orderpriority", "enum", values=PRIORITIES),
    )
    events = column_report(
        t.events.withColumnRenamed("event_id", "row_id"), "events", ["row_id"],
        ColumnSpec("event_type", "enum", values=("click", "purchase", "signup", "view")),
    )
    return orders.unionByName(events)


@query(
    "validate_set",
    """
SELECT l_orderkey, l_linenumber, 'lineitem' AS table_name, 'l_flags' AS column_name,
       'set' AS rule, l_returnflag || ', ' || l_linestatus AS value
FROM lineitem
WHERE NOT list_has_all(['A', 'N', 'O'], string_split(l_returnflag || ',' || l_linestatus, ','))
""",
)
def validate_set(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("l_flags", F.concat_ws(", ", "l_returnflag", "l_linestatus"))
    return column_report(
        df, "lineitem", ["l_orderkey", "l_linenumber"],
        ColumnSpec("l_flags", "set", values=("A", "N", "O")),
    )


@query(
    "validate_int_range",
    """
SELECT o_orderkey AS row_id, 'orders' AS table_name, 'o_orderkey' AS column_name,
       'range' AS rule, CAST(o_orderkey AS VARCHAR) AS value
FROM orders WHERE o_orderkey NOT BETWEEN 0 AND 255
UNION ALL
SELECT c_custkey, 'customer', 'c_custkey', 'range', CAST(c_custkey AS VARCHAR)
FROM customer WHERE c_custkey NOT BETWEEN -128 AND 127
""",
)
def validate_int_range(t: Tables) -> DataFrame:
    orders = column_report(
        t.orders, "orders", ["o_orderkey"], ColumnSpec("o_orderkey", "tinyint", unsigned=True)
    )
    customers = column_report(
        t.customer, "customer", ["c_custkey"], ColumnSpec("c_custkey", "tinyint")
    )
    return orders.withColumnRenamed("o_orderkey", "row_id").unionByName(
        customers.withColumnRenamed("c_custkey", "row_id")
    )


@query(
    "validate_length",
    """
SELECT doc_id AS row_id, 'documents' AS table_name, 'length' AS rule,
       '"text": length ' || length(text) || ' is above 2000' AS message
FROM documents WHERE length(text) > 2000
UNION ALL
SELECT p_partkey, 'part', 'length',
       '"p_name": length ' || length(p_name) || ' is above 11'
FROM part WHERE length(p_name) > 11
""",
)
def validate_length(t: Tables) -> DataFrame:
    found = []
    for df, table, key, column, length in (
        (t.documents, "documents", "doc_id", "text", 2000),
        (t.part, "part", "p_partkey", "p_name", 11),
    ):
        spec = TableSpec(table, (ColumnSpec(column, "varchar", length=length),))
        rows = df.select(F.col(key).alias("row_id"), column)
        violations = Validator(spec, ("row_id",)).violations(rows, unique=False)
        found.append(violations.select("row_id", "table_name", "rule", "message"))
    return found[0].unionByName(found[1])


@query(
    "validate_unknown_column",
    """
SELECT event_id, 'events' AS table_name, 'unknown_column' AS rule, 'value' AS value
FROM events WHERE event_type = 'click'
""",
)
def validate_unknown_column(t: Tables) -> DataFrame:
    """Rows as JSON, where a click carries a key the target does not have."""
    line = F.to_json(
        F.struct(
            F.col("event_id").alias("Event_ID"),
            "event_type",
            F.when(F.col("event_type") == "click", F.col("value")).alias("Value"),
        )
    )
    rows = rows_from_lines(t.events.select("event_id", line.alias("value")))
    spec = TableSpec("events", (ColumnSpec("event_id", "bigint"), ColumnSpec("event_type", "text")))
    found = Validator(spec, ("event_id",), row="row").violations(rows, unique=False)
    return found.select("event_id", "table_name", "rule", "value")


@query(
    "validate_raw_rows",
    """
SELECT event_id, 'value' AS column_name, 'range' AS rule,
       CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS value
FROM events WHERE floor(value) NOT BETWEEN -128 AND 127
UNION ALL
SELECT event_id, 'event_type', 'enum', CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'view'
UNION ALL
SELECT event_id, 'event_type', 'enum', event_type FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id, 'user_id', 'not_null', NULL FROM events WHERE event_type = 'signup'
UNION ALL
SELECT event_id, 'small_user', 'check', CAST(user_id AS VARCHAR)
FROM events WHERE event_type NOT IN ('signup', 'purchase') AND user_id >= 90
""",
)
def validate_raw_rows(t: Tables) -> DataFrame:
    """Rules on JSON values: kinds decide, null given differs from key missing."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    line = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"),
        F.lit(',"value":'), F.floor("value").cast("string"),
        F.lit(',"event_type":'),
        F.when(kind == "view", user).otherwise(F.concat(F.lit('"'), kind, F.lit('"'))),
        F.when(kind == "purchase", "")
        .when(kind == "signup", ',"user_id":null')
        .otherwise(F.concat(F.lit(',"user_id":"'), user, F.lit('"'))),
        F.lit("}"),
    )
    rows = rows_from_lines(t.events.select("event_id", line.alias("value")))
    spec = TableSpec(
        "events",
        (
            ColumnSpec("event_id", "bigint", nullable=False),
            ColumnSpec("value", "tinyint"),
            ColumnSpec("event_type", "enum", values=("click", "purchase", "signup", "view")),
            ColumnSpec("user_id", "bigint", nullable=False),
        ),
        (CheckSpec("small_user", "(user_id < 90)"),),
    )
    found = Validator(spec, ("event_id",), row="row").violations(rows, unique=False)
    return found.select("event_id", "column_name", "rule", "value")


# ---- CHECK constraints ----------------------------------------------------


@query(
    "check_comparison",
    """
SELECT c_custkey, 'customer' AS table_name, 'balance' AS column_name, 'check' AS rule,
       CAST(c_acctbal AS VARCHAR) AS value
FROM customer WHERE NOT (c_acctbal > 0)
""",
)
def check_comparison(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", "c_acctbal")
    return check_report(df, "customer", ["c_custkey"], "balance", "(`c_acctbal` > 0)", "mysql")


@query(
    "check_between",
    """
SELECT l_orderkey, l_linenumber, 'lineitem' AS table_name, 'quantity' AS column_name,
       'check' AS rule, CAST(l_quantity AS VARCHAR) AS value
FROM lineitem WHERE NOT (l_quantity BETWEEN 1 AND 40)
""",
)
def check_between(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return check_report(
        df, "lineitem", ["l_orderkey", "l_linenumber"], "quantity",
        "(`l_quantity` between 1 and 40)", "mysql",
    )


@query(
    "check_not_between",
    """
SELECT o_orderkey, 'orders' AS table_name, 'price' AS column_name, 'check' AS rule,
       CAST(o_totalprice AS VARCHAR) AS value
FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000.5
""",
)
def check_not_between(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_totalprice")
    return check_report(
        df, "orders", ["o_orderkey"], "price",
        "CHECK ((o_totalprice NOT BETWEEN (100000)::numeric AND 200000.5)) NOT VALID",
    )


@query(
    "check_in",
    """
SELECT c_custkey, 'customer' AS table_name, 'segment' AS column_name, 'check' AS rule,
       c_mktsegment AS value
FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')
""",
)
def check_in(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", "c_mktsegment")
    return check_report(
        df, "customer", ["c_custkey"], "segment",
        "(`c_mktsegment` in (_utf8mb4'BUILDING',_utf8mb4'HOUSEHOLD',_utf8mb4'MACHINERY'))", "mysql",
    )


@query(
    "check_not_in",
    """
SELECT c_custkey, 'customer' AS table_name, 'nation' AS column_name, 'check' AS rule,
       CAST(c_nationkey AS VARCHAR) AS value
FROM customer WHERE c_nationkey IN (3, 7, 11)
""",
)
def check_not_in(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", "c_nationkey")
    return check_report(
        df, "customer", ["c_custkey"], "nation", "(`c_nationkey` not in (3,7,11))", "mysql"
    )


@query(
    "check_any_array",
    """
SELECT c_custkey, 'customer' AS table_name, 'segment' AS column_name, 'check' AS rule,
       c_mktsegment AS value
FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE')
""",
)
def check_any_array(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", "c_mktsegment")
    return check_report(
        df, "customer", ["c_custkey"], "segment",
        "CHECK (((c_mktsegment)::text = ANY ((ARRAY['BUILDING'::character varying, "
        "'FURNITURE'::character varying])::text[])))",
    )


@query(
    "check_column_vs_column",
    """
SELECT l_orderkey, l_linenumber, 'lineitem' AS table_name, 'shipped' AS column_name,
       'check' AS rule
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE NOT (l_shipdate > o_orderdate)
""",
)
def check_column_vs_column(t: Tables) -> DataFrame:
    """A CHECK over two tables: the join shuffles three columns per side."""
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey"
    )
    found = check_report(
        df, "lineitem", ["l_orderkey", "l_linenumber"], "shipped", "(`l_shipdate` > `o_orderdate`)", "mysql"
    )
    return found.drop("value")


@query(
    "check_null_or",
    """
SELECT l_orderkey, l_linenumber, 'lineitem' AS table_name, 'discount' AS column_name,
       'check' AS rule
FROM lineitem
WHERE NOT coalesce(nullif(l_discount, 0.05) IS NULL OR nullif(l_discount, 0.05) < 0.04, true)
""",
)
def check_null_or(t: Tables) -> DataFrame:
    df = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.05)).alias("l_discount")
    )
    return check_report(
        df, "lineitem", ["l_orderkey", "l_linenumber"], "discount",
        "((l_discount IS NULL) OR (l_discount < 0.04))",
    ).drop("value")


@query(
    "check_unknown_passes",
    """
SELECT o_orderkey, 'orders' AS table_name, 'priority' AS column_name, 'check' AS rule,
       o_orderpriority AS value
FROM orders
WHERE NOT coalesce(nullif(o_orderpriority, '1-URGENT') > '3', true)
""",
)
def check_unknown_passes(t: Tables) -> DataFrame:
    df = t.orders.select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority")
    )
    return check_report(df, "orders", ["o_orderkey"], "priority", "(o_orderpriority > '3'::text)")


@query(
    "check_case_only",
    """
SELECT o_orderkey, 'orders' AS table_name, 'status' AS column_name, 'check' AS rule,
       o_orderstatus AS value
FROM orders
WHERE CASE WHEN o_orderstatus IN ('f', 'O') THEN true
           WHEN lower(o_orderstatus) IN ('f', 'o') THEN NULL ELSE false END = false
UNION ALL
SELECT o_orderkey, 'orders', 'not_p', 'check', o_orderstatus
FROM orders
WHERE CASE WHEN o_orderstatus = 'p' THEN false
           WHEN lower(o_orderstatus) = 'p' THEN NULL ELSE o_orderstatus > 'p' END = false
""",
)
def check_case_only(t: Tables) -> DataFrame:
    """Texts that differ by case only are left to the collation: UNKNOWN."""
    df = t.orders.select("o_orderkey", "o_orderstatus")
    spec = TableSpec(
        "orders",
        (ColumnSpec("o_orderstatus", "text"),),
        (
            CheckSpec("status", "(`o_orderstatus` in ('f','O'))"),
            CheckSpec("not_p", "(`o_orderstatus` > 'p')"),
        ),
        dialect="mysql",
    )
    return report(Validator(spec, ("o_orderkey",)).violations(df), "o_orderkey")


@query(
    "check_text_number",
    """
SELECT o_orderkey, 'orders' AS table_name, 'level' AS column_name, 'check' AS rule, level AS value
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE ' ' || left(o_orderpriority, 1) || '.0' END AS level
      FROM orders)
WHERE try_cast(trim(level) AS DOUBLE) > 3
""",
)
def check_text_number(t: Tables) -> DataFrame:
    """Text against a number compares by value; text that is no number passes."""
    level = F.when(F.col("o_orderstatus") == "P", "x").otherwise(
        F.concat(F.lit(" "), F.substring("o_orderpriority", 1, 1), F.lit(".0"))
    )
    df = t.orders.select("o_orderkey", level.alias("level"))
    return check_report(df, "orders", ["o_orderkey"], "level", "CHECK ((level <= (3)::numeric))")


@query(
    "check_boolean_logic",
    """
SELECT l_orderkey, l_linenumber, 'lineitem' AS table_name, 'mixed' AS column_name, 'check' AS rule
FROM (SELECT *, nullif(l_tax, 0.02) AS tax FROM lineitem)
WHERE NOT coalesce(
  (NOT (l_quantity >= 10 AND tax <= 0.03) OR l_returnflag = 'A') AND l_discount <> -1, true)
""",
)
def check_boolean_logic(t: Tables) -> DataFrame:
    df = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_discount",
        F.nullif("l_tax", F.lit(0.02)).alias("tax"),
    )
    return check_report(
        df, "lineitem", ["l_orderkey", "l_linenumber"], "mixed",
        "((NOT ((l_quantity >= 10) AND (tax <= 0.03)) OR (l_returnflag = 'A')) AND (l_discount <> -1))",
    ).drop("value")


# ---- keys -----------------------------------------------------------------


@query(
    "validate_unique",
    """
SELECT 'part' AS table_name, sha256(p_name) AS key_digest, count(*) AS n, min(p_partkey) AS first_row
FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(*) > 1
UNION ALL
SELECT 'documents', sha256(text), count(*), min(doc_id)
FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1
""",
)
def validate_unique(t: Tables) -> DataFrame:
    """Duplicated values with their count and first row. Long texts are keyed
    by digest in the scan, so the texts themselves are never shuffled."""

    def found(df, table, key, column):
        slim = df.select(F.col(key).alias("row_id"), F.sha2(column, 256).alias("key_digest"))
        return duplicate_keys(slim, ["key_digest"], ["row_id"]).select(
            F.lit(table).alias("table_name"), "key_digest", "n", "first_row"
        )

    return found(t.part, "part", "p_partkey", "p_name").unionByName(
        found(t.documents, "documents", "doc_id", "text")
    )


@query(
    "validate_unique_first_seen",
    """
SELECT 'part' AS table_name, p_partkey AS row_id, first_row
FROM (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_name) AS first_row,
             row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS nth
      FROM part WHERE p_name IS NOT NULL)
WHERE nth > 1
UNION ALL
SELECT 'documents', doc_id, first_row
FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_row,
             row_number() OVER (PARTITION BY text ORDER BY doc_id) AS nth
      FROM documents WHERE text IS NOT NULL)
WHERE nth > 1
""",
)
def validate_unique_first_seen(t: Tables) -> DataFrame:
    def found(df, table, key, column):
        slim = df.select(F.col(key).alias("row_id"), F.sha2(column, 256).alias("digest"))
        return repeated_rows(slim, ["digest"], ["row_id"]).select(
            F.lit(table).alias("table_name"), "row_id", "first_row"
        )

    return found(t.part, "part", "p_partkey", "p_name").unionByName(
        found(t.documents, "documents", "doc_id", "text")
    )


@query(
    "validate_unique_same_order",
    """
SELECT 'report' AS way, l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS nth FROM lineitem)
WHERE nth > 1
UNION ALL
SELECT 'split', l_orderkey, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS nth FROM lineitem)
WHERE nth > 1
""",
)
def validate_unique_same_order(t: Tables) -> DataFrame:
    """Duplicates of a key that is the row order too: all rows of a key but one."""
    keys = ["l_orderkey", "l_linenumber"]
    spec = TableSpec(
        "lineitem", tuple(ColumnSpec(k, "bigint") for k in keys), composite_unique=(tuple(keys),)
    )
    validator, df = Validator(spec, tuple(keys)), t.lineitem.select(*keys)
    shown = lambda found, way: found.select(F.lit(way).alias("way"), *keys)
    return shown(validator.violations(df), "report").unionByName(shown(validator.split(df)[1], "split"))


@query(
    "composite_key_duplicates",
    """
SELECT l_orderkey, l_linenumber, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
)
def composite_key_duplicates(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return duplicate_keys(t.lineitem.select(*keys), keys)


@query(
    "fk_orphans",
    """
SELECT o_orderkey, o_custkey FROM orders o
WHERE o_custkey IS NOT NULL AND NOT EXISTS
  (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_nationkey < 20)
""",
)
def fk_orphans(t: Tables) -> DataFrame:
    parents = t.customer.filter(F.col("c_nationkey") < 20)
    return orphan_rows(
        t.orders.select("o_orderkey", "o_custkey"), ["o_custkey"], parents, ["c_custkey"], ["o_orderkey"]
    ).select("o_orderkey", "o_custkey")


# ---- whole tables ---------------------------------------------------------

ORDERS_BAD = """
  coalesce(o_orderkey NOT BETWEEN -32768 AND 32767 OR o_custkey NOT BETWEEN 0 AND 255
   OR o_orderstatus NOT IN ('F', 'O') OR length(o_orderpriority) > 10
   OR o_totalprice < 20000 OR (o_orderpriority = '1-URGENT' AND o_totalprice >= 400000), false)
"""
# Keys compete among the rows that break no other rule.
ORDERS_KEPT = f"""
  SELECT * FROM (SELECT * FROM orders WHERE NOT {ORDERS_BAD})
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderkey) = 1
    AND (o_custkey IS NULL OR o_orderpriority IS NULL
         OR row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) = 1)
"""
ORDERS_VIOLATIONS = """
  SELECT o_orderkey, 1 AS ordinal, 'o_orderkey' AS column_name, 'range' AS rule,
         CAST(o_orderkey AS VARCHAR) AS value
  FROM orders WHERE o_orderkey NOT BETWEEN -32768 AND 32767
  UNION ALL
  SELECT o_orderkey, 2, 'o_custkey', 'range', CAST(o_custkey AS VARCHAR)
  FROM orders WHERE o_custkey NOT BETWEEN 0 AND 255
  UNION ALL
  SELECT o_orderkey, 3, 'o_orderstatus', 'enum', o_orderstatus
  FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
  UNION ALL
  SELECT o_orderkey, 5, 'o_orderpriority', 'length', o_orderpriority
  FROM orders WHERE length(o_orderpriority) > 10
  UNION ALL
  SELECT o_orderkey, 1000000, 'price_floor', 'check', CAST(o_totalprice AS VARCHAR)
  FROM orders WHERE o_totalprice < 20000
  UNION ALL
  SELECT o_orderkey, 1000000, 'urgent_price', 'check', CAST(o_totalprice AS VARCHAR) || ', ' || o_orderpriority
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 400000
  UNION ALL
  SELECT o_orderkey, 2, 'o_custkey,o_orderpriority', 'unique', CAST(o_custkey AS VARCHAR) || ',' || o_orderpriority
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS nth FROM orders)
  WHERE nth > 1 AND o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL
  UNION ALL
  SELECT o_orderkey, 1, 'o_orderkey', 'unique', CAST(o_orderkey AS VARCHAR)
  FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey) AS nth FROM orders) WHERE nth > 1
"""


def _orders(t: Tables) -> tuple[Validator, DataFrame]:
    return Validator(ORDERS, ("o_orderkey",)), t.orders.select(*ORDER_COLUMNS)


@query(
    "violations_report",
    f"SELECT o_orderkey, column_name, rule, value FROM ({ORDERS_VIOLATIONS})",
)
def violations_report(t: Tables) -> DataFrame:
    validator, df = _orders(t)
    return validator.violations(df).select("o_orderkey", "column_name", "rule", "value")


@query(
    "violation_summary",
    f"""
SELECT 'orders' AS table_name, r.column_name, r.rule, count(v.o_orderkey) AS violations
FROM (VALUES ('o_orderkey', 'not_null'), ('o_orderkey', 'range'), ('o_custkey', 'range'),
             ('o_orderstatus', 'enum'), ('o_orderpriority', 'length'), ('price_floor', 'check'),
             ('urgent_price', 'check'), ('o_orderkey', 'unique'),
             ('o_custkey,o_orderpriority', 'unique')) AS r(column_name, rule)
LEFT JOIN ({ORDERS_VIOLATIONS}) AS v ON v.column_name = r.column_name AND v.rule = r.rule
GROUP BY r.column_name, r.rule
""",
)
def violation_summary(t: Tables) -> DataFrame:
    validator, df = _orders(t)
    return validator.summary(df)


@query(
    "first_violation",
    f"""
SELECT o_orderkey, column_name, rule, value FROM ({ORDERS_VIOLATIONS})
ORDER BY o_orderkey, ordinal, rule, column_name LIMIT 1
""",
)
def first_violation(t: Tables) -> DataFrame:
    validator, df = _orders(t)
    return validator.first_violation(df).select("o_orderkey", "column_name", "rule", "value")


@query(
    "quarantine_good",
    f"SELECT {', '.join(ORDER_COLUMNS)} FROM ({ORDERS_KEPT})",
)
def quarantine_good(t: Tables) -> DataFrame:
    validator, df = _orders(t)
    return validator.split(df)[0]


@query(
    "quarantine_bad",
    f"""
SELECT {', '.join(ORDER_COLUMNS)} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({ORDERS_KEPT}))
""",
)
def quarantine_bad(t: Tables) -> DataFrame:
    validator, df = _orders(t)
    return validator.split(df)[1]
