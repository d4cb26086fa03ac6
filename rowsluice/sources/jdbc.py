"""Relational databases over Spark's JDBC source: tables and their catalog."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default ports and JDBC driver classes.
DEFAULT_PORTS = {"postgres": 5432, "mysql": 3306}
DRIVER_CLASSES = {"postgres": "org.postgresql.Driver", "mysql": "com.mysql.cj.jdbc.Driver"}
URL_SCHEMES = {"postgres": "postgresql", "mysql": "mysql"}


@dataclass(frozen=True)
class Connection:
    """Where a database is; credentials are passed as Spark options."""

    driver: str
    host: str = "localhost"
    port: int = 0
    database: str = ""
    options: dict[str, str] = field(default_factory=dict)
    url: str = ""

    def __post_init__(self):
        if not self.url and self.driver not in DEFAULT_PORTS:
            raise ValueError(f"unsupported driver {self.driver!r} (postgres or mysql)")

    @property
    def effective_port(self) -> int:
        return self.port or DEFAULT_PORTS.get(self.driver, 0)

    @property
    def jdbc_url(self) -> str:
        if self.url:
            return self.url
        scheme = URL_SCHEMES[self.driver]
        return f"jdbc:{scheme}://{self.host}:{self.effective_port}/{self.database}"

    @property
    def jdbc_options(self) -> dict[str, str]:
        found = {"url": self.jdbc_url, **self.options}
        if "driver" not in found and self.driver in DRIVER_CLASSES:
            found["driver"] = DRIVER_CLASSES[self.driver]
        return found


def read_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    partition_column: str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table, read in parallel ranges of ``partition_column`` where one is given.

    Bounds come from one min/max query; they only place the range borders, rows
    outside (or null) still land in the first or last partition.
    """
    reader = spark.read.format("jdbc").options(**connection.jdbc_options).option(
        "fetchsize", fetch_size
    )
    if partition_column is None:
        return reader.option("dbtable", table).load()
    bounds = (
        reader.option("query", f"SELECT min({partition_column}) AS lo, max({partition_column}) AS hi FROM {table}")
        .load()
        .first()
    )
    reader = spark.read.format("jdbc").options(**connection.jdbc_options).option(
        "fetchsize", fetch_size
    )
    if bounds is None or bounds[0] is None or bounds[0] == bounds[1]:
        return reader.option("dbtable", table).load()
    return (
        reader.option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", str(partitions or spark.sparkContext.defaultParallelism))
        .load()
    )


def run_statements(spark: SparkSession, connection: Connection, statements: list[str]) -> list[int]:
    """Run statements in one transaction, from the driver; rows changed by each.

    Spark's JDBC source only reads and writes tables. If one statement fails, none has an effect (but for
    databases that commit DDL at once).
    """
    options = dict(connection.jdbc_options)
    url, driver = options.pop("url"), options.pop("driver", None)
    jvm = spark._jvm
    if driver:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        properties.setProperty(key, str(value))
    session = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        session.setAutoCommit(False)
        changed, statement = [], session.createStatement()
        try:
            for text in statements:
                changed.append(statement.executeUpdate(text))
            session.commit()
        except Exception:
            session.rollback()
            raise
        return changed
    finally:
        session.close()


# Catalog queries, shaped as rowsluice.sources.catalog expects them. They run in
# the database; only catalog rows travel.
TABLES_QUERY = """
SELECT {database} AS "database", table_name AS "table_name", table_type AS "table_type"
FROM information_schema.tables WHERE table_schema = {schema}
"""
COLUMNS_QUERY = """
SELECT {database} AS "database", table_name AS "table_name", column_name AS "column_name",
       ordinal_position AS "ordinal_position", data_type AS "data_type",
       {column_type} AS "column_type", is_nullable AS "is_nullable",
       character_maximum_length AS "character_maximum_length",
       numeric_precision AS "numeric_precision", numeric_scale AS "numeric_scale"
FROM information_schema.columns WHERE table_schema = {schema}
"""
CONSTRAINTS_QUERY = """
SELECT {database} AS "database", table_name AS "table_name",
       constraint_name AS "constraint_name", constraint_type AS "constraint_type"
FROM information_schema.table_constraints WHERE table_schema = {schema}
"""
USAGE_QUERY = """
SELECT {database} AS "database", table_name AS "table_name",
       constraint_name AS "constraint_name", column_name AS "column_name",
       ordinal_position AS "ordinal_position"
FROM information_schema.key_column_usage WHERE table_schema = {schema}
"""
REFERENCES_QUERIES = {
    "postgres": """
SELECT {database} AS "database", u.table_name AS "table_name",
       u.constraint_name AS "constraint_name", u.ordinal_position AS "ordinal_position",
       p.table_name AS "ref_table", p.column_name AS "ref_column"
FROM information_schema.referential_constraints r
JOIN information_schema.key_column_usage u
  ON u.constraint_schema = r.constraint_schema AND u.constraint_name = r.constraint_name
JOIN information_schema.key_column_usage p
  ON p.constraint_schema = r.unique_constraint_schema
 AND p.constraint_name = r.unique_constraint_name
 AND p.ordinal_position = u.position_in_unique_constraint
WHERE u.table_schema = {schema}
""",
    "mysql": """
SELECT {database} AS "database", table_name AS "table_name",
       constraint_name AS "constraint_name", ordinal_position AS "ordinal_position",
       referenced_table_name AS "ref_table", referenced_column_name AS "ref_column"
FROM information_schema.key_column_usage
WHERE table_schema = {schema} AND referenced_table_name IS NOT NULL
""",
}
CHECKS_QUERIES = {
    # Only real CHECKs: the standard view lists NOT NULL columns among them.
    "postgres": """
SELECT {database} AS "database",
       (SELECT relname FROM pg_class WHERE pg_class.oid = k.conrelid) AS "table_name",
       k.conname AS "name", pg_get_constraintdef(k.oid) AS "definition"
FROM pg_constraint k
WHERE k.contype = 'c' AND k.connamespace = {schema}::regnamespace
""",
    "mysql": """
SELECT {database} AS "database", t.table_name AS "table_name",
       t.constraint_name AS "name", c.check_clause AS "definition"
FROM information_schema.check_constraints c
JOIN information_schema.table_constraints t USING (constraint_schema, constraint_name)
WHERE t.constraint_type = 'CHECK' AND t.table_schema = {schema}
""",
}


def catalog_queries(connection: Connection) -> dict[str, str]:
    """SQL text per catalog frame for the connection's dialect."""
    mysql = connection.driver == "mysql"
    fill = {
        "database": "'" + connection.database.replace("'", "''") + "'",
        "schema": "DATABASE()" if mysql else "'public'",
        "column_type": "column_type" if mysql else "data_type",
    }
    texts = {
        "tables": TABLES_QUERY,
        "columns": COLUMNS_QUERY,
        "constraints": CONSTRAINTS_QUERY,
        "usage": USAGE_QUERY,
        "references": REFERENCES_QUERIES["mysql" if mysql else "postgres"],
        "checks": CHECKS_QUERIES["mysql" if mysql else "postgres"],
    }
    mark = "`" if mysql else '"'
    return {name: q.format(**fill).replace('"', mark).strip() for name, q in texts.items()}


def read_catalog(spark: SparkSession, connection: Connection) -> dict[str, DataFrame]:
    """Live catalog frames. Older MySQL servers have no CHECK catalog: none then."""
    frames = {}
    for name, query in catalog_queries(connection).items():
        reader = spark.read.format("jdbc").options(**connection.jdbc_options).option("query", query)
        try:
            frames[name] = reader.load()
        except Exception as problem:
            if name != "checks" or "check_constraints" not in str(problem).lower():
                raise
            frames[name] = spark.createDataFrame(
                [], "database string, table_name string, name string, definition string"
            )
    for name, frame in frames.items():
        if "ordinal_position" in frame.columns:
            frames[name] = frame.withColumn("ordinal_position", F.col("ordinal_position").cast("int"))
    return frames
