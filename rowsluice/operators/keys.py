"""Keys over whole tables: duplicates, first-seen rows, orphans.

All of these first reduce a table to one row per key (partial aggregation
absorbs repeated keys before the shuffle) and only then, where rows are asked
for, join the per-key result back with hot keys split over many tasks.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key repeated more often than this is split over several join tasks.
ROWS_PER_SPLIT = 1_000_000
# The list of such keys is broadcast as 20 bytes each. This many of the heaviest fit; a key past
# them has less than a millionth of all rows, so that it needs no split of its own.
LISTED_KEYS = 1_000_000


def _listed(columns: list[str]) -> list[Column]:
    """A 128-bit digest of a key, however wide the key is."""
    return [F.xxhash64(*columns).alias("_listed0"), F.xxhash64(F.lit(1), *columns).alias("_listed1")]


def join_by_key(
    rows: DataFrame,
    keyed: DataFrame,
    on: list[str],
    weight: str,
    spread: list[str],
    how: str = "inner",
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Join ``rows`` to ``keyed``, which has one row per key, safely under skew.

    ``weight`` is the column of ``keyed`` with the number of rows behind a key
    and ``spread`` names columns of ``rows`` that tell rows of one key apart.
    Heavy keys get as many splits as their weight calls for: their ``rows``
    pick a split by hash and their single ``keyed`` row is repeated once per
    split. Rows without a key are spread too instead of meeting in one partition.
    """
    # Heavy keys read every column of ``keyed``: both uses then have the same
    # plan below, and Spark runs the aggregation behind it only once.
    payload = [F.col(c).cast("string") for c in keyed.columns if c not in (*on, weight)]
    used = F.concat_ws("", *payload) != "\x00" if payload else F.lit(True)
    splits = _splits(weight, rows_per_split)
    hot = F.broadcast(
        keyed.filter((F.col(weight) > rows_per_split) & used)
        .orderBy(F.col(weight).desc())
        .limit(LISTED_KEYS)
        .select(*_listed(on), splits.alias("_splits"))
    )
    position = F.abs(F.xxhash64(*spread))
    left = rows.select("*", *_listed(on)).join(hot, ["_listed0", "_listed1"], "left").withColumn(
        "_split",
        F.when(~has_all(on), (position % 4096).cast("int")).otherwise(
            (position % F.coalesce("_splits", F.lit(1))).cast("int")
        ),
    )
    # Keys past the list are repeated as well; the repeats match nothing.
    right = keyed.withColumn("_split", F.explode(F.sequence(F.lit(0), splits - 1)))
    dropped = ["_splits", "_listed0", "_listed1"]
    return left.drop(*dropped).join(right, [*on, "_split"], how).drop("_split")


def _splits(weight: str, rows_per_split: int) -> Column:
    return F.ceil(F.col(weight) / rows_per_split).cast("int")


def has_all(columns: list[str]) -> Column:
    return reduce(operator.and_, [F.col(c).isNotNull() for c in columns])


def _row_order(order: list[str]) -> Column:
    return F.struct(*order) if len(order) > 1 else F.col(order[0])


def _key_parts(df: DataFrame, keys: list[str], alive: Column | None) -> list[Column]:
    """Key expressions: texts are keyed by digest, and rows that are not alive have no key."""
    out = []
    for key in keys:
        is_text = isinstance(df.schema[key].dataType, T.StringType)
        part = F.sha2(F.col(key), 256) if is_text else F.col(key)
        out.append(part if alive is None else F.when(alive, part))
    return out


def row_digest(df: DataFrame) -> Column:
    """A hash of a row's whole content, to break ties of row order."""
    parts = []
    for field in df.schema.fields:
        plain = "map" not in field.dataType.simpleString() and "variant" not in field.dataType.simpleString()
        parts.append(F.col(f"`{field.name}`") if plain else F.to_json(F.struct(F.col(f"`{field.name}`"))))
    return F.xxhash64(*parts)


def duplicate_keys(
    df: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
    count: str = "n",
    first: str = "first_row",
) -> DataFrame:
    """Keys that occur more than once, with their count and first row.

    Keys with a null part are exempt. Result: keys, the count, and the first
    row where ``order`` names the columns that define row order.
    """
    aggregates = [F.count(F.lit(1)).alias(count)]
    if order:
        aggregates.append(F.min(_row_order(order)).alias(first))
    return df.filter(has_all(keys)).groupBy(*keys).agg(*aggregates).filter(F.col(count) > 1)


def _seen(
    df: DataFrame, keys: list[str], order: list[str], alive: Column | None, how: str
) -> DataFrame:
    """Rows with ``_first``, the order and digest of the first row of their key, where the key is
    duplicated, and their own ``_place`` to compare it with."""
    internal = [f"_key{i}" for i in range(len(keys))]
    parts = [e.alias(k) for e, k in zip(_key_parts(df, keys, alive), internal, strict=True)]
    place = F.struct(*order, row_digest(df).alias("_digest")).alias("_place")
    keyed = df.select("*", *parts, place)
    firsts = (
        df.select(*parts, place)
        .filter(has_all(internal))
        .groupBy(*internal)
        .agg(F.count(F.lit(1)).alias("_count"), F.min("_place").alias("_first"))
        .filter("_count > 1")
    )
    return join_by_key(keyed, firsts, internal, "_count", ["_place"], how).drop(*internal, "_count")


def flag_repeats(df: DataFrame, keys: list[list[str]], order: list[str], name: str = "rejected") -> DataFrame:
    """``df`` with its boolean ``name`` also TRUE for rows whose key an earlier row has.

    Keys compete in turn and only among rows that are not rejected so far, so a
    rejected row owns nothing. Of rows with equal order the one with the
    smallest content digest is first; of identical rows exactly one is kept.
    """
    rest = [c for c in df.columns if c != name]
    out = df.withColumn("_owner", F.lit(False))
    for key in keys:
        seen = _seen(out, key, order, ~F.col(name), "left")
        first = F.col("_first").eqNullSafe(F.col("_place"))
        repeat = F.col("_first").isNotNull() & ~first
        out = seen.select(*rest, (F.col(name) | repeat).alias(name), (F.col("_owner") | first).alias("_owner"))
    # Only first rows of duplicated keys can have identical rows beside them.
    owner = F.col("_owner") & ~F.col(name)
    same = Window.partitionBy(*order, "_digest").orderBy("_digest")
    among = out.filter(owner).withColumn("_digest", row_digest(df)).withColumn(name, F.row_number().over(same) > 1)
    return out.filter(~owner).select(*rest, name).unionByName(among.select(*rest, name))


def repeated_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows whose key an earlier row has, with the order of the row that had it first.

    Of identical rows all but one are repeats.
    """
    hits = _seen(df, keys, order, None, "inner")
    first = F.col("_first").eqNullSafe(F.col("_place"))
    same = Window.partitionBy("_place").orderBy("_place")
    ties = hits.filter(first).withColumn("_nth", F.row_number().over(same)).filter("_nth > 1").drop("_nth")
    shown = F.struct(*[F.col(f"_first.{o}") for o in order]) if len(order) > 1 else F.col(f"_first.{order[0]}")
    found = hits.filter(~first).unionByName(ties)
    return found.withColumn("first_row", shown).drop("_first", "_place")


def orphan_keys(
    child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str], count: str = "n"
) -> DataFrame:
    """Foreign-key values without a parent row, with their number of child rows.

    Children shrink to distinct keys before they meet the parent, so a parent
    key that a third of all rows point to costs one row per input task.
    """
    used = child.filter(has_all(fk)).groupBy(*fk).agg(F.count(F.lit(1)).alias(count))
    parents = parent.select(*[F.col(p).alias(f) for p, f in zip(pk, fk, strict=True)])
    return used.join(parents, fk, "left_anti")


def orphan_rows(
    child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str], order: list[str]
) -> DataFrame:
    """Child rows whose (non-null) foreign key has no parent row."""
    orphans = orphan_keys(child, fk, parent, pk, "_count")
    return join_by_key(child, orphans, fk, "_count", order).drop("_count")
