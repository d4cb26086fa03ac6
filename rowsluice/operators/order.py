"""Parents-first load order of tables from their foreign-key graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowsluice.session import shared_dir

ROUNDS_PER_JOB = 4


def load_passes(tables: DataFrame, edges: DataFrame) -> DataFrame:
    """The pass over the listed tables in which each table can be loaded.

    ``tables`` has ``database, table_name, position`` (the listed order) and
    ``edges`` has ``database, child, parent``, each pair once; edges that leave
    the set of tables do not count. A table is loadable once all its parents
    are; a parent listed before its child is ready within the same pass, one
    listed after it only in the next. Self references do not count. Tables on
    a cycle, and those below one, never get loadable: their ``pass`` stays NULL.

    Every round settles one more level of the graph for all databases at once;
    a few rounds form one job, whose result is checkpointed to the shared
    folder so that plans do not grow with the depth of the graph.
    """
    shared_dir(tables.sparkSession)
    links = _links(tables, edges).checkpoint()
    roots = tables.select("database", "table_name").join(
        links.select("database", F.col("child").alias("table_name")),
        ["database", "table_name"],
        "left_anti",
    )
    settled = roots.withColumn("pass", F.lit(0)).checkpoint()
    first, known, wanted = settled, settled.count(), tables.count()
    while known < wanted:
        for _ in range(ROUNDS_PER_JOB):
            settled = first.unionByName(_ready(links, settled))
        settled = settled.checkpoint()
        now = settled.count()
        if now == known:
            break
        known = now
    return tables.select("database", "table_name", "position").join(
        settled, ["database", "table_name"], "left"
    )


def _links(tables: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with what every round needs: the child's number of parents and
    whether the parent is listed after the child. Joining both ends with the
    listed tables also drops edges that leave the set."""
    at = tables.select("database", "table_name", "position")
    parents = W.partitionBy("database", "child")
    return (
        edges.filter(F.col("child") != F.col("parent"))
        .select("database", "child", "parent")
        .join(at.toDF("database", "parent", "parent_at"), ["database", "parent"])
        .join(at.toDF("database", "child", "child_at"), ["database", "child"])
        .select(
            "database",
            "child",
            "parent",
            F.count(F.lit(1)).over(parents).alias("needed"),
            (F.col("parent_at") > F.col("child_at")).cast("int").alias("later"),
        )
    )


def _ready(links: DataFrame, settled: DataFrame) -> DataFrame:
    """Tables with parents, all of which are settled."""
    return (
        links.join(settled.withColumnRenamed("table_name", "parent"), ["database", "parent"])
        .groupBy("database", F.col("child").alias("table_name"), "needed")
        .agg(
            F.count(F.lit(1)).alias("ready"),
            F.max(F.col("pass") + F.col("later")).alias("pass"),
        )
        .filter(F.col("ready") == F.col("needed"))
        .select("database", "table_name", "pass")
    )


def load_order(passes: DataFrame) -> DataFrame:
    """Tables in load order for databases that can be ordered as a whole.

    Sort by ``pass, position`` within a database. A database with stuck tables
    is refused: it has no order, see ``stuck_tables``.
    """
    stuck = passes.filter(F.col("pass").isNull()).select("database").distinct()
    return passes.join(stuck, "database", "left_anti")


def stuck_tables(passes: DataFrame) -> DataFrame:
    """Tables that sit on a foreign-key cycle or depend on one."""
    return passes.filter(F.col("pass").isNull()).select("database", "table_name")


class CircularReferences(ValueError):
    """The tables of one load cannot be ordered."""


def ordered_names(tables: DataFrame, edges: DataFrame) -> list[str]:
    """Load order of the tables of one load, for the driver loop that loads them."""
    rows = load_passes(tables, edges).orderBy("pass", "position").collect()
    stuck = sorted(r["table_name"] for r in rows if r["pass"] is None)
    if stuck:
        raise CircularReferences(f"no load order: references go round in {', '.join(stuck)}")
    return [r["table_name"] for r in rows]
