"""Progress and load tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def progress_totals(tables: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Generated and requested rows, in total or per group."""
    return tables.groupBy(*(by or [])).agg(
        F.coalesce(F.sum("generated"), F.lit(0)).alias("generated"),
        F.coalesce(F.sum("requested"), F.lit(0)).alias("requested"),
    )


def progress_percent(
    generated: Column, requested: Column, reported: Column, overall: Column
) -> Column:
    """Whole percent from 0 to 100.

    A reported percentage counts when it is positive or the state is ready;
    otherwise it is generated over requested, rounded down, and 0 while
    nothing was requested.
    """
    from_totals = F.when(requested <= 0, F.lit(0)).otherwise(
        F.least(
            F.lit(100), F.call_function("div", generated * 100, F.nullif(requested, F.lit(0)))
        )
    )
    trusted = (F.coalesce(reported, F.lit(0)) > 0) | (overall == "ready")
    clamped = F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce(reported, F.lit(0))))
    return F.when(trusted, clamped).otherwise(from_totals).cast("int")


def load_tally(loaded: DataFrame, table: str = "table_name") -> DataFrame:
    """Rows per loaded table plus one row, with a NULL table, for all of them."""
    return loaded.rollup(table).agg(F.count(F.lit(1)).alias("rows"))
