"""Merkle manifest of a table: one hash tree per part, and one over the parts' roots.

Slot pivot: ``FANOUT`` conditional aggregates spread the children of a node into as many
columns, a node is the hash of all of them side by side, and what is left without a child's own
column are its siblings. Leaves are hashed in the scan, so texts never travel. Places come from a
range sort and one count per sorted partition and part; no part is ever in one task. Levels are
written as tables, eight times smaller from one to the next; proofs are then dealt out from the
root to the leaves, each level joined once.

Defined cases: a null column hashes as ``-``; a null key sorts first and is never changed by a
query; rows of equal key are ordered by their leaf, equal leaves are repeated; a null part is a part
of its own, before all others; a part of one row has its leaf as subroot; an empty table has no
rows and no root; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowsluice.llm.common import stored

FANOUT = 8
SLOTS = [f"s{k}" for k in range(FANOUT)]
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*texts: Column) -> Column:
    """Lowercase hex SHA-256 of the texts side by side; absent ones count as empty."""
    return F.sha2(F.concat_ws("", *texts), 256)


def spelled(value: Column) -> Column:
    """A value with its length in bytes, so that neighbours cannot be confused; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with ``part``) and their place ``pos`` in their part of ``n`` rows, by ``order``.

    A range sort deals rows out by part and order; a place is the row's place in its sorted
    partition plus the part's rows in earlier ones.
    """
    by = [F.asc_nulls_first(c) for c in ("part", *order)]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(placed.withColumn("at", F.monotonically_increasing_id()), "merkle-leaves")
    placed = placed.withColumn("run", F.shiftright("at", 33))
    runs = placed.groupBy("part", "run").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    whole = Window.partitionBy("part")  # a row per sorted partition
    earlier = whole.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "part", "run", F.sum("size").over(whole).alias("n"),
        (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
    )
    return placed.join(runs, ["part", "run"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "run", "shift")


def raised(nodes: DataFrame) -> DataFrame:
    """The parents of all nodes of parts that still have several: their slots and their hash."""
    slot = F.pmod("pos", F.lit(FANOUT))
    return (
        nodes.filter("n > 1")
        .groupBy("part", "n", F.floor(F.col("pos") / FANOUT).alias("up"))
        .agg(*(F.max(F.when(slot == k, F.col("node"))).alias(name) for k, name in enumerate(SLOTS)))
        .select(
            "part", F.col("up").alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"), *SLOTS,
            digest(*map(F.col, SLOTS)).alias("node"),
        )
    )


def sides(k: int) -> Column:
    """The siblings left and right of slot ``k``."""
    return F.struct(
        F.concat_ws("", *SLOTS[:k]).alias("left") if k else F.lit("").alias("left"),
        F.concat_ws("", *SLOTS[k + 1 :]).alias("right") if k < FANOUT - 1 else F.lit("").alias("right"),
    )


def longer(step: Column, path: Column) -> Column:
    return F.concat(F.array(step), path)


def proof(path: Column) -> Column:
    """Hash of all siblings on the way to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


@dataclass
class Tree:
    """Levels of the hash trees of all parts, leaves first, each a stored table."""

    leaves: DataFrame
    levels: list[DataFrame] = field(default_factory=list)

    @classmethod
    def grown(cls, leaves: DataFrame) -> Tree:
        """``leaves`` need part, pos, n and node."""
        tree = cls(leaves)
        most = leaves.agg(F.max("n")).first()[0] or 0
        nodes = leaves
        while most > 1:
            nodes = stored(raised(nodes), "merkle-level")
            tree.levels.append(nodes)
            most = -(-most // FANOUT)
        return tree

    def tops(self) -> DataFrame:
        """part, height and node of what remains of each part."""
        tops = None
        for height, nodes in enumerate([self.leaves, *self.levels]):
            some = nodes.filter("n = 1").select("part", F.lit(height).alias("height"), "node")
            tops = some if tops is None else tops.unionAll(some)
        return tops

    def dealt(self, tops: DataFrame) -> DataFrame:
        """All leaves with the siblings on their way up.

        ``tops`` has part, height, what the leaves are to carry, and the path above the part.
        """
        carried = [c for c in tops.columns if c not in ("part", "height", "path")]
        level_of = lambda h: tops.filter(F.col("height") == h).select("part", F.lit(0).cast("long").alias("pos"), "path", *carried)
        paths = level_of(len(self.levels))
        for height in range(len(self.levels) - 1, -1, -1):
            known = self.levels[height].drop("n", "node").join(paths, ["part", "pos"])
            if height:
                child = [F.when(F.col(s).isNotNull(), F.struct(F.lit(k).alias("k"), sides(k).alias("step"))) for k, s in enumerate(SLOTS)]
                paths = known.withColumn("child", F.explode(F.filter(F.array(*child), lambda c: c.isNotNull()))).select(
                    "part", (F.col("pos") * FANOUT + F.col("child.k")).alias("pos"),
                    longer(F.col("child.step"), F.col("path")).alias("path"), *carried,
                )
                paths = paths.unionByName(level_of(height))
        alone = self.leaves.filter("n = 1").join(level_of(0), ["part", "pos"]).drop("pos", "n")
        if not self.levels:
            return alone
        slot = F.pmod("pos", F.lit(FANOUT))
        step = F.coalesce(*(F.when(F.col("slot") == k, sides(k)) for k in range(FANOUT)))
        rows = self.leaves.filter("n > 1").withColumn("slot", slot).withColumn("pos", F.floor(F.col("pos") / FANOUT))
        rows = rows.join(known, ["part", "pos"]).withColumn("path", longer(step, F.col("path")))
        return rows.drop("pos", "n", "slot", *SLOTS).unionByName(alone)


@dataclass(frozen=True)
class MerkleManifest:
    """``columns`` are hashed in this order; leaves ascend by ``key`` within each ``part``."""

    columns: tuple[str, ...] = COLUMNS
    key: str = "doc_id"
    part: str = "lang"

    def leaf(self, **changed: Column) -> Column:
        """The hash of a row, with other values for the columns named."""
        return digest(*(spelled(changed.get(c, F.col(c))) for c in self.columns))

    def proved(self, rows: DataFrame, **also: Column) -> DataFrame:
        """key, leaf, the columns of ``also``, subroot, root and path (siblings leaf to root) of each row."""
        # '-' < '=', so that null is first and the rest in byte order, in plain equi-joins
        part = F.coalesce(F.concat(F.lit("="), F.col(self.part).cast("string")), F.lit("-"))
        leaves = rows.select(
            F.col(self.key).alias("key"), part.alias("part"), self.leaf().alias("node"),
            *(c.alias(f"also_{name}") for name, c in also.items()),
        )
        tree = Tree.grown(numbered(leaves, ["key", "node"]))
        tops = stored(tree.tops(), "merkle-subroots")
        over = Tree.grown(numbered(tops.select(F.lit("").alias("part"), F.col("part").alias("key"), "node"), ["key"]))
        root = over.tops().select("part", "height", F.col("node").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
        paths = over.dealt(root).select(F.col("key").alias("part"), F.col("node").alias("subroot"), "root", "path")
        return tree.dealt(tops.drop("node").join(paths, "part")).select(
            F.col("key").alias(self.key), F.col("node").alias("leaf"),
            *(F.col(f"also_{name}").alias(name) for name in also), "subroot", "root", "path",
        )

    def manifest(self, rows: DataFrame) -> DataFrame:
        """key, leaf, subroot, root and the hash of the proof of each row."""
        return self.proved(rows).select(self.key, "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"))

    def check(self, rows: DataFrame, proofs: DataFrame) -> DataFrame:
        """Rows tested against ``proofs`` (of ``proved``), by key: is the row the one that was proved?

        A key that several rows share is good if one of its proofs fits.
        """
        now = rows.select(F.col(self.key).alias("key"), self.leaf().alias("now"))
        proofs = proofs.select(F.col(self.key).alias("key"), "path", "root")
        fits = folded(F.col("now"), F.col("path")) == F.col("root")
        return (
            now.join(proofs, now["key"].eqNullSafe(proofs["key"]), "left")
            .groupBy(now["key"].alias(self.key), "now").agg(F.coalesce(F.bool_or(fits), F.lit(False)).alias("verified"))
        )
