"""Manifests of schemas: what tables a schema has, their rows, status, samples.

A manifest has one row per schema and table: ``schema_id, name, table_name,
rows, status, created_at``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE_ROWS = 5


def list_schemas(manifest: DataFrame, containing: str = "") -> DataFrame:
    """One row per schema with its number of tables.

    ``containing`` keeps schemas that have this table; the test rides along
    with the aggregation instead of a second pass and a join.
    """
    schemas = manifest.groupBy("schema_id").agg(
        F.min("name").alias("name"),
        F.count(F.lit(1)).alias("tables"),
        F.min("created_at").alias("created_at"),
        F.max(F.col("table_name") == containing).alias("contains"),
    )
    if containing:
        schemas = schemas.filter(F.col("contains"))
    return schemas.drop("contains")


def show_schema(manifest: DataFrame, schema_id: str | None = None) -> DataFrame:
    """Tables of one schema (or of all) with rows and status."""
    picked = manifest if schema_id is None else manifest.filter(F.col("schema_id") == schema_id)
    return picked.select("schema_id", "name", "table_name", "rows", "status", "created_at")


def sample_rows(
    rows: DataFrame, order: list[str], by: list[str] | None = None, limit: int = SAMPLE_ROWS
) -> DataFrame:
    """The first rows as JSON text, of the whole frame or of each group ``by``.

    Both forms keep at most ``limit`` rows per task and group before anything
    is shuffled (top-k, or the group limit pushed below the window).
    """
    kept = [c for c in rows.columns if c not in (by or [])]
    as_json = F.to_json(F.struct(*kept)).alias("sample")
    if not by:
        return rows.orderBy(*order).limit(limit).select(*order, as_json)
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return (
        rows.withColumn("position", rank)
        .filter(F.col("position") <= limit)
        .select(*by, "position", as_json)
    )


def is_ready(status: Column) -> Column:
    """A table may be loaded when its status is empty or ``ready``."""
    return F.coalesce(status, F.lit("")).isin("", "ready")


def ready_tables(manifest: DataFrame) -> DataFrame:
    return manifest.filter(is_ready(F.col("status")))


def unready_tables(manifest: DataFrame) -> DataFrame:
    return manifest.filter(~is_ready(F.col("status")))


def as_json(listing: DataFrame, name: str = "json") -> DataFrame:
    """A listing as JSON text, one object per row."""
    return listing.select(F.to_json(F.struct("*")).alias(name))
