"""N-gram Jaccard join with count-vector R-trees.

A document is its set of word shingles. Shingles are hashed into groups, and a document's point
holds its number of shingles in each group, so that the sum of coordinate minima of two points
bounds their sets' overlap from above. Equal sets are one class with one point.

Classes that can link share a shingle among the first quarter of each in one global order
(frequent shingles last), so points are compared within the groups of those shingles only. A
group's points are bulk-loaded into an R-tree: leaves of similar points keep the maximum of each
coordinate, and pairs of leaves, then pairs of points, are dropped by their bound. Surviving
pairs are verified on the texts. Small groups are a single leaf. Large groups are split into
tiles; classes are first compared with the smallest id of their group, then with all points of their tile that are in
other components by then. A tile gives no pairs for these, but a forest over the points that may link, and so at most a row for
each of its points. What such forests connect is dealt to tiles anew, with texts, and verified there, each two of like size
once; these tiles give forests too. So no link between components is lost, and no group emits all of its pairs.

That gives components (``connecting``, ``joined``, ``representatives``), not every link. ``pairs`` gives all links
between classes: both ends of a link are in one component, so each component's classes are dealt to
tiles in which every two of like size meet once, and all that the tile's tree allows are verified
there. ``members`` counts the links of each document.

Defined cases: null and empty texts have empty sets and link with nothing; a text with fewer
words than a shingle is one shingle; repeated rows get equal rows, and rows of one id with different
texts are judged each by its own; a null id is the smallest and comes back as null; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsluice.llm import common as c
from rowsluice.llm.anchors import LEAST_ID, Listed, blobs, ids_of, longer_prefixes, runs, spread, whole_groups
from rowsluice.llm.components import components

LEAF = 16
TILE = 2_000
TILE_SHINGLES = 2_000_000
#: Pairs of texts whose sets are held at once.
PAIRS = 256
#: Bits of the list by which rows are chosen before their texts are shuffled: for each id that is looked for, and in all.
BITS, MOST_BITS = 16, 1 << 24
ROWS = "id long, tag int, n long, c1 long, c2 long, point binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle) of each distinct shingle, sorted."""
    low = c.LOWER[data]
    starts, ends, doc = c.words(low, offsets, c.separators("spaces"))
    h = c.word_hash(low, starts, ends)
    grams = c.rolled(h, k)
    at = np.flatnonzero(doc[: len(grams)] == doc[k - 1 : k - 1 + len(grams)])
    first = c.word_bounds(doc, len(offsets) - 1)
    size = np.diff(first)
    few = np.flatnonzero((size > 0) & (size < k))
    short = [c.rolled(h[first[d] : first[d + 1]], int(size[d]))[0] for d in few]
    docs = np.concatenate((doc[at], few))
    grams = np.concatenate((grams[at], np.array(short, c.U)))
    order = np.lexsort((grams, docs))
    order = order[runs(docs[order], grams[order])]
    return docs[order], grams[order]


def n_groups(n: int) -> int:
    """Coordinates of a set of n shingles: a power of two, one for two to four shingles."""
    return 1 << max(4, int(n - 1).bit_length() - 2)


def point(grams: np.ndarray) -> np.ndarray:
    g = n_groups(len(grams))
    return np.minimum(np.bincount((grams & c.U(g - 1)).astype(np.int64), minlength=g), 255).astype(np.uint8)


def folded(p: np.ndarray, g: int) -> np.ndarray:
    """The point over g groups, of which p has a multiple."""
    return p if len(p) == g else np.minimum(p.reshape(-1, g).sum(axis=0), 255).astype(np.uint8)


def may_link(overlap, n, m, share: int):
    """Whether 100 * overlap >= share * union can hold, given at most that overlap."""
    return overlap * (100 + share) >= share * (n + m)


def _profile(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"], c.HALF):
            doc, grams = shingle_sets(data, offsets, k)
            cut = np.searchsorted(doc, np.arange(end - first + 1))
            total = lambda x: np.diff(np.concatenate((np.zeros(1, c.U), np.cumsum(x, dtype=c.U)))[cut])
            n = np.diff(cut)
            points = [point(grams[a:z]).tobytes() if z > a else None for a, z in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids_of(b["id"].slice(first, end - first))), b["tag"].slice(first, end - first), pa.array(n),
                    pa.array(c.mix(total(c.mix(grams)) + n.astype(c.U)).view(np.int64)),
                    pa.array(c.mix(total(c.mix(grams ^ c.U(0x9E3779B97F4A7C15)))).view(np.int64)),
                    pa.array(points, pa.binary()),
                ],
                names=["id", "tag", "n", "c1", "c2", "point"],
            )


def _frequent(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[np.ndarray]:
    for b in batches:
        for _, _, data, offsets in c.chunks(b["text"], c.HALF):
            yield shingle_sets(data, offsets, k)[1]


def _prefixes(batches: Iterator[pa.RecordBatch], k: int, share: int, frequent: Listed) -> Iterator[pa.RecordBatch]:
    """A row for each class of a chunk and shingle of its prefix."""
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"], c.HALF):
            doc, grams = shingle_sets(data, offsets, k)
            often = frequent.known(grams)
            order = np.lexsort((grams, often, doc))
            cut = np.searchsorted(doc, np.arange(end - first + 1))
            n = np.diff(cut)
            rank = np.arange(len(doc)) - cut[doc]
            total = np.diff(np.concatenate((np.zeros(1, c.U), np.cumsum(c.mix(grams), dtype=c.U)))[cut])
            c1 = c.mix(total + n.astype(c.U))
            one = np.zeros(end - first, bool)
            one[np.unique(c1, return_index=True)[1]] = True
            # 100 overlap >= share union needs overlap >= share * n / 100
            keep = n - -(-share * n // 100) + 1
            chosen = (rank < keep[doc]) & one[doc]
            at, d = order[chosen], doc[chosen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[at].view(np.int64)), pa.array(c1[d].view(np.int64)), pa.array(n[d]), pa.array(often[at])],
                names=["gram", "c1", "n", "often"],
            )


def _pairs(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Pairs of classes of small groups; rows of larger groups as they are, with b null."""
    for b in whole_groups(batches, "gram"):
        gram, c1, n = (b[x].to_numpy() for x in ("gram", "c1", "n"))
        order = np.lexsort((c1, gram))
        order = order[runs(gram[order], c1[order])]
        gram, c1, n = gram[order], c1[order], n[order]
        first = runs(gram)
        size = np.diff(np.append(first, len(gram)))
        out_a, out_b, big = [], [], []
        for m in np.unique(size).tolist():
            f = first[size == m]
            if m == 1:
                continue
            if m > LEAF:
                big.append((f[:, None] + np.arange(m)).ravel())
                continue
            i, j = np.triu_indices(m, 1)
            x, y = (f[:, None] + i).ravel(), (f[:, None] + j).ravel()
            ok = np.minimum(n[x], n[y]) * 100 >= share * np.maximum(n[x], n[y])
            out_a.append(c1[x[ok]])
            out_b.append(c1[y[ok]])
        none = [np.zeros(0, np.int64)]
        pairs = np.unique(np.stack((np.concatenate(out_a + none), np.concatenate(out_b + none))), axis=1)
        big = np.concatenate(big + none)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((pairs[0], c1[big]))),
                pa.array(np.concatenate((pairs[1], np.zeros(len(big), np.int64))), mask=np.arange(pairs.shape[1] + len(big)) >= pairs.shape[1]),
                pa.array(np.concatenate((np.zeros(pairs.shape[1], np.int64), gram[big]))),
            ],
            names=["a", "b", "gram"],
        )


def _bounded(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose points allow a link."""
    for b in batches:
        keep = []
        for n, m, p, q in zip(*(b[x].to_pylist() for x in ("n_a", "n_b", "point_a", "point_b"))):
            g = min(len(p), len(q))
            p, q = folded(np.frombuffer(p, np.uint8), g), folded(np.frombuffer(q, np.uint8), g)
            keep.append(may_link(int(np.minimum(p, q).sum(dtype=np.int64)), n, m, share))
        yield b.filter(pa.array(keep, pa.bool_())).select(["id_a", "tag_a", "id_b", "tag_b"])


class RTree:
    """Points of one group, sorted and packed into leaves that keep each coordinate's maximum."""

    def __init__(self, n: np.ndarray, points: list[np.ndarray]):
        g = min(len(p) for p in points)
        coordinates = np.stack([folded(p, g) for p in points])
        # sort-tile packing: by size, then by the load of the first half of the groups
        slices = max(1, int(np.sqrt(len(n) / LEAF)))
        place = np.argsort(np.argsort(n, kind="stable"), kind="stable") * slices // len(n)
        self.order = np.lexsort((coordinates[:, : g // 2].sum(axis=1), place))
        self.points, self.n = coordinates[self.order], n[self.order]
        self.first = np.arange(0, len(n), LEAF)
        self.upper = np.maximum.reduceat(self.points, self.first, axis=0)
        self.least = np.minimum.reduceat(self.n, self.first)

    def candidates(self, x: int, share: int) -> np.ndarray:
        """Points (in tree order) that may link with point x of the tree."""
        p, n = self.points[x], self.n[x]
        leaf = np.flatnonzero(may_link(np.minimum(self.upper, p).sum(axis=1, dtype=np.int64), n, self.least, share))
        at = (leaf[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = at[at < len(self.n)]
        return at[may_link(np.minimum(self.points[at], p).sum(axis=1, dtype=np.int64), n, self.n[at], share)]



def _joined_to(x: int, met: np.ndarray, others: np.ndarray) -> np.ndarray:
    """One of the others for each tree of a forest that x is not in yet; these trees become one with that of x."""
    trees, at = np.unique(met[others], return_index=True)
    new = trees != met[x]
    if new.any():
        met[np.isin(met, trees[new])] = met[x]
    return others[at[new]]


def _trees(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """For tiles of large groups, a forest over the points that may link with some of another component.

    Two such points are in one tree, though not joined directly, so a tile has fewer rows than points.
    """
    for b in whole_groups(batches, "tile"):
        key = b["tile"].to_numpy()
        first = runs(key)
        ids, tags, n, root = (b[x].to_numpy(zero_copy_only=False) for x in ("id", "tag", "n", "root"))
        data, cuts = blobs(b["point"])
        out_a, out_b = [], []
        for f, l in zip(first, np.append(first[1:], len(key))):
            order = np.lexsort((tags[f:l], ids[f:l]))  # classes of one id have different tags
            at = f + order[runs(ids[f:l][order], tags[f:l][order])]
            if len(at) < 2 or (root[at] == root[at[0]]).all():
                continue
            tree = RTree(n[at], [data[cuts[i] : cuts[i + 1]] for i in at])
            rows = at[tree.order]
            part, met = np.unique(root[rows], return_inverse=True)[1], np.arange(len(rows))
            # all but the largest component of the group look for others
            for x in np.flatnonzero(part != np.argmax(np.bincount(part))).tolist():
                others = tree.candidates(x, share)
                others = _joined_to(x, met, others[part[others] != part[x]])
                out_a.append(np.full(len(others), ids[rows[x]]))
                out_b.append(ids[rows[others]])
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])


class Sets:
    """The shingle sets of one tile's texts, in the order of the tree of their points."""

    def __init__(self, texts: pa.Array, k: int):
        sets = []
        for start, end, data, offsets in c.chunks(texts, c.HALF):
            doc, grams = shingle_sets(data, offsets, k)
            cut = np.searchsorted(doc, np.arange(end - start + 1))
            sets += [grams[a:z] for a, z in zip(cut[:-1], cut[1:])]
        self.tree = RTree(np.array([len(s) for s in sets]), [point(s) for s in sets])
        self.gram = np.unique(np.concatenate([sets[i] for i in self.tree.order]), return_inverse=True)[1]
        self.cut = np.concatenate(([0], np.cumsum(self.tree.n)))
        self.mark = np.zeros(len(self.gram), bool)

    def linked(self, x: int, near: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of the near sets that link with set x, and their common shingles."""
        if not len(near):
            return near, near
        size = self.tree.n[near]
        begin = np.cumsum(size) - size
        at = np.repeat(self.cut[near] - begin, size) + np.arange(size.sum())
        own = self.gram[self.cut[x] : self.cut[x + 1]]
        self.mark[own] = True
        common = np.add.reduceat(self.mark[self.gram[at]].astype(np.int64), begin)
        self.mark[own] = False
        links = (common > 0) & may_link(common, self.tree.n[x], size, share)
        return near[links], common[links]


def _tiles_of_texts(batches: Iterator[pa.RecordBatch], k: int):
    """For each tile its batch, the rows in the order of its sets, the sets, and which of some sets meet set x here only."""
    for b in whole_groups(batches, "tile"):
        key = b["tile"].to_numpy()
        first = runs(key)
        own, other, band, low = (b[x].to_numpy() for x in ("own", "other", "band", "low"))
        for f, l in zip(first.tolist(), np.append(first[1:], len(key)).tolist()):
            sets = Sets(b["text"].slice(f, l - f), k)
            rows = f + sets.tree.order

            def once(x: int, near: np.ndarray, rows=rows) -> np.ndarray:
                row, to = rows[x], rows[near]
                # the band of the larger of both, and the diagonal tile for classes of one bucket
                return near[(np.maximum(low[to], low[row]) == band[row]) & ((own[to] != own[row]) | (own[row] == other[row]))]

            yield b, rows, sets, once


def _linked(batches: Iterator[pa.RecordBatch], k: int, share: int) -> Iterator[pa.RecordBatch]:
    """All links of tiles of a component's classes, each pair in one tile only."""
    for b, rows, sets, once in _tiles_of_texts(batches, k):
        out_a, out_b, out_n = [], [], []
        for x, row in enumerate(rows.tolist()):
            near = sets.tree.candidates(x, share)
            near, common = sets.linked(x, once(x, near[near > x]), share)
            out_a.append(np.full(len(near), row))
            out_b.append(rows[near])
            out_n.append(common)
        x, y = pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))
        ends = [b[name].take(at) for at in (x, y) for name in ("id", "c1", "n")]
        yield pa.RecordBatch.from_arrays(
            [*ends, pa.array(np.concatenate(out_n))],
            names=["id_a", "class_a", "n_a", "id_b", "class_b", "n_b", "n_common"],
        )


def _connected(batches: Iterator[pa.RecordBatch], k: int, share: int) -> Iterator[pa.RecordBatch]:
    """Links that connect all components (``part``) of a tile that links between its classes connect."""
    for b, rows, sets, once in _tiles_of_texts(batches, k):
        ids, met = b["id"].to_numpy(), np.unique(b["part"].to_numpy()[rows], return_inverse=True)[1]
        out_a, out_b = [], []
        for x in np.flatnonzero(met != np.argmax(np.bincount(met))).tolist():
            near = sets.tree.candidates(x, share)
            near = sets.linked(x, once(x, near[met[near] != met[x]]), share)[0]
            near = _joined_to(x, met, near)
            out_a.append(np.full(len(near), ids[rows[x]]))
            out_b.append(ids[rows[near]])
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch], k: int, share: int) -> Iterator[pa.RecordBatch]:
    """Pairs of texts that link."""
    for b in (whole.slice(at, PAIRS) for whole in batches for at in range(0, len(whole), PAIRS)):
        sets: dict[int, list[np.ndarray]] = {0: [], 1: []}
        for side, name in enumerate(("text_a", "text_b")):
            for first, end, data, offsets in c.chunks(b[name], c.HALF):
                doc, grams = shingle_sets(data, offsets, k)
                cut = np.searchsorted(doc, np.arange(end - first + 1))
                sets[side] += [grams[a:z] for a, z in zip(cut[:-1], cut[1:])]
        keep = []
        for x, y in zip(sets[0], sets[1]):
            common = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
            keep.append(common > 0 and 100 * common >= share * (len(x) + len(y) - common))
        yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


@dataclass(frozen=True)
class JaccardJoin:
    """``k``: words of a shingle; ``share``: percent of the union that must be common."""

    k: int = 5
    share: int = 75

    def _rows(self, docs: DataFrame) -> DataFrame:
        return docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
            "tag", F.hash("text")
        )

    def _texts(self, rows: DataFrame, ends: DataFrame, n: int) -> DataFrame:
        """A row with its text for each of some n ends (id, tag).

        Only rows whose id may be among them are shuffled: ids set bits of a list, which is broadcast and has 2 MB at most.
        """
        bits = 1 << max(10, int(BITS * n).bit_length())
        bits = min(bits, MOST_BITS)
        place = F.pmod(F.xxhash64("id"), F.lit(bits))
        bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {bits}) % 64 as int))")
        listed = ends.select(F.shiftright(place, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("set"))
        rows = rows.withColumn("id", F.coalesce("id", F.lit(LEAST_ID)))
        some = rows.join(F.broadcast(listed), F.shiftright(place, 6) == F.col("word")).filter(bit.bitwiseAND(F.col("set")) != 0)
        return some.select("id", "tag", "text").join(ends, ["id", "tag"]).dropDuplicates(["id", "tag"])

    def _dealt_texts(self, rows: DataFrame, classes: DataFrame) -> DataFrame:
        """The classes (id, tag, n, root and others) with their texts, in tiles where every two of one root and like size meet.

        A pair is counted in the band of the larger and, of one bucket, in the diagonal tile.
        """
        low = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100.1 / self.share))).cast("int")
        spread_out = classes.withColumn("low", low).withColumn("band", F.explode(F.array(F.col("low"), F.col("low") + 1)))
        tiles = F.ceil(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_SHINGLES)).cast("int")
        sized = spread_out.groupBy("root", "band").agg(F.count("*").alias("size"), tiles.alias("tiles")).filter("size > 1")
        placed = spread_out.join(sized, ["root", "band"]).withColumn(
            "own", F.pmod(F.xxhash64("id", "tag"), F.col("tiles")).cast("int")
        )
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        tile = F.xxhash64("root", "band", F.least("own", "other"), F.greatest("own", "other")).alias("tile")
        placed = c.stored(placed.select(tile, *classes.drop("root").columns, "low", "band", "own", "other"), "link-tiles")
        texts = self._texts(rows, placed.select("id", "tag").distinct(), placed.count())
        return placed.join(texts, ["id", "tag"]).repartition("tile").sortWithinPartitions("tile")

    def _verify(self, rows: DataFrame, pairs: DataFrame) -> DataFrame:
        """The pairs (id_a, tag_a, id_b, tag_b) whose texts link, as a, b."""
        pairs = c.stored(pairs.distinct(), "pairs")
        if pairs.isEmpty():
            return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
        ends = pairs.select(F.col("id_a").alias("id"), F.col("tag_a").alias("tag")).union(pairs.select("id_b", "tag_b")).distinct()
        texts = c.stored(self._texts(rows, ends, 2 * pairs.count()), "texts")
        side = lambda x: texts.select(F.col("id").alias(f"id_{x}"), F.col("tag").alias(f"tag_{x}"), F.col("text").alias(f"text_{x}"))
        joined = pairs.join(side("a"), ["id_a", "tag_a"]).join(side("b"), ["id_b", "tag_b"])
        joined = joined.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "text_a", "text_b")
        return c.stored(c.in_arrow(joined, partial(_verified, k=self.k, share=self.share), "a long, b long"), "links")

    def profiled(self, docs: DataFrame) -> DataFrame:
        """id, tag, n, class digest and point of each document, stored."""
        return c.stored(c.in_arrow(self._rows(docs), partial(_profile, k=self.k), ROWS), "sets")

    def classes(self, profile: DataFrame) -> DataFrame:
        """A row per different set: its smallest id, with tag and point."""
        least = F.min_by(F.struct("tag", "point"), F.struct("id", "tag"))
        one = profile.filter("n > 0").groupBy("c1", "c2", "n").agg(F.min("id").alias("id"), least.alias("x"))
        return c.stored(one.select("c1", "n", "id", "x.tag", "x.point"), "classes")

    def connecting(self, docs: DataFrame, profile: DataFrame | None = None) -> DataFrame:
        """a, b: verified links that connect all classes that links connect; not all links."""
        rows = self._rows(docs)
        profile = self.profiled(docs) if profile is None else profile
        classes = self.classes(profile)
        frequent = longer_prefixes(rows, partial(_frequent, k=self.k), most=64, least=8)
        prefixes = c.in_arrow(
            rows, partial(_prefixes, k=self.k, share=self.share, frequent=frequent), "gram long, c1 long, n long, often boolean"
        )
        prefixes = prefixes.select(
            "c1", "n", "gram", "often",
            # frequent shingles are not gathered here: their rows are spread
            F.when(F.col("often"), F.xxhash64("gram", "c1")).otherwise(F.col("gram")).alias("at"),
        )
        dealt = prefixes.repartition("at").sortWithinPartitions("gram")
        met = c.stored(c.in_arrow(dealt, partial(_dealt, share=self.share), "a long, b long, gram long"), "prefixes")
        # small groups: pairs bounded by their points
        side = lambda x: classes.select(F.col("c1").alias(x), *(F.col(n).alias(f"{n}_{x}") for n in ("id", "tag", "n", "point")))
        pairs = met.filter("b IS NOT NULL").select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
        bounded = c.in_arrow(pairs, partial(_bounded, share=self.share), "id_a long, tag_a int, id_b long, tag_b int")
        # large groups: tiles of points of like sizes, as sets that link differ by a third at most
        large = met.filter("b IS NULL").select("gram", F.col("a").alias("c1")).distinct()
        band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100.1 / self.share))).cast("int")
        large = large.join(classes.select("c1", "id", band.alias("least")), "c1")
        large = large.select("gram", "c1", "id", F.explode(F.array(F.col("least"), F.col("least") + 1)).alias("band"))
        large = c.stored(large, "large")
        tiles = F.ceil(F.col("size") / TILE).cast("int")
        sized = large.groupBy("gram", "band").agg(F.count("*").alias("size")).filter("size > 1")
        placed = large.join(sized, ["gram", "band"]).withColumn("own", F.pmod(F.xxhash64("id"), tiles).cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        tile = F.xxhash64("gram", "band", F.least("own", "other"), F.greatest("own", "other")).alias("tile")
        placed = c.stored(placed.select(tile, "id"), "tiles")
        schema = "id_a long, tag_a int, id_b long, tag_b int"
        # first each class of a large group with the group's smallest id, which its copies are likely to follow
        leaders = large.groupBy("gram", "band").agg(F.min("id").alias("leader"))
        stars = large.join(leaders, ["gram", "band"]).filter("id <> leader").select("id", "leader").distinct()
        end = lambda x, on: classes.select(F.col("id").alias(on), *(F.col(n).alias(f"{n}_{x}") for n in ("id", "tag", "n", "point")))
        stars = stars.join(end("a", "id"), "id").join(end("b", "leader"), "leader")
        followed = c.in_arrow(stars, partial(_bounded, share=self.share), schema)
        links = self._verify(rows, bounded.unionByName(followed))
        # then all that may link, but only between components of a tile
        roots = components(links)
        labelled = placed.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        mixed = labelled.groupBy("tile").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
        points = labelled.join(mixed.select("tile"), "tile").join(classes.select("id", "tag", "n", "point"), "id")
        dealt = points.repartition("tile").sortWithinPartitions("tile")
        near = components(c.in_arrow(dealt, partial(_trees, share=self.share), "a long, b long"))
        near = near.union(near.select(F.col("root").alias("id"), "root").distinct())
        parts = roots.withColumnRenamed("root", "part")
        left = classes.select("id", "tag", "n").join(near, "id").join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
        found = c.in_arrow(self._dealt_texts(rows, left), partial(_connected, k=self.k, share=self.share), "a long, b long")
        return links.unionByName(c.stored(found.distinct(), "found"))

    def _links(self, docs: DataFrame, profile: DataFrame) -> DataFrame:
        """id, class and size of both ends and the common shingles of all links between classes, stored."""
        roots = components(self.connecting(docs, profile))
        # a root has no row of its own; classes without links meet nothing, but for those that share an id
        classes = self.classes(profile).join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        dealt = self._dealt_texts(self._rows(docs), classes.select("id", "tag", "c1", "n", "root"))
        schema = "id_a long, class_a long, n_a long, id_b long, class_b long, n_b long, n_common long"
        return c.stored(c.in_arrow(dealt, partial(_linked, k=self.k, share=self.share), schema), "all-links")

    def pairs(self, docs: DataFrame) -> DataFrame:
        """All links between different sets, each once: a, class_a, n_a, b, class_b, n_b, n_common.

        ``a`` and ``b`` are the smallest ids of their classes; ``members`` lists a class's documents, which all link
        with each other too. The rows are as many as there are links, in a near-copy group up to the square of its classes.
        """
        links = self._links(docs, self.profiled(docs))
        end = lambda x: F.struct(F.col(f"id_{x}").alias("id"), F.col(f"class_{x}").alias("class"), F.col(f"n_{x}").alias("n"))
        ordered = links.select(F.least(end("a"), end("b")).alias("x"), F.greatest(end("a"), end("b")).alias("y"), "n_common")
        shown = lambda x: F.when(F.col(x) != LEAST_ID, F.col(x))
        return ordered.select(
            shown("x.id").alias("a"), F.col("x.class").alias("class_a"), F.col("x.n").alias("n_a"),
            shown("y.id").alias("b"), F.col("y.class").alias("class_b"), F.col("y.n").alias("n_b"), "n_common",
        )

    def members(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_shingles, class, its representative and the number of other rows that link: a row per document."""
        profile = self.profiled(docs)
        sizes = c.stored(
            profile.filter("n > 0").groupBy("c1", "c2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("size")), "sizes"
        )
        links = self._links(docs, profile)
        ends = links.select(F.col("id_a").alias("rep"), F.col("class_a").alias("c1"), F.col("id_b").alias("to"), F.col("class_b").alias("c")).union(
            links.select("id_b", "class_b", "id_a", "class_a")
        )
        partners = sizes.select(F.col("rep").alias("to"), F.col("c1").alias("c"), F.col("size").alias("others"))
        counted = ends.join(partners, ["to", "c"]).groupBy("rep", "c1").agg(F.sum("others").alias("others"))
        each = sizes.join(counted, ["rep", "c1"], "left").withColumn("links", F.col("size") - 1 + F.coalesce("others", F.lit(0)))
        shown = lambda x: F.when(F.col(x) != LEAST_ID, F.col(x))
        rows = profile.select("id", "c1", "c2", "n").join(each.select("c1", "c2", "n", "rep", "links"), ["c1", "c2", "n"], "left")
        return rows.select(
            shown("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("c1").alias("class"),
            shown("rep").alias("representative"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        )

    def labelled(self, docs: DataFrame) -> DataFrame:
        """id, tag, n and root: the smallest id of each row's component."""
        profile = self.profiled(docs)
        by_class = profile.filter("n > 0").groupBy("c1", "c2", "n").agg(F.min("id").alias("least"))
        roots = components(self.connecting(docs, profile)).withColumnRenamed("id", "least")
        classes = by_class.join(roots, "least", "left").select("c1", "c2", "n", F.coalesce("root", "least").alias("root"))
        return profile.select("id", "tag", "c1", "c2", "n").join(classes, ["c1", "c2", "n"], "left").select(
            "id", "tag", "n", F.coalesce("root", "id").alias("root")
        )

    def joined(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_shingles, component_id: a row per document."""
        shown = lambda x: F.when(F.col(x) != LEAST_ID, F.col(x))
        return self.labelled(docs).select(
            shown("id").alias("doc_id"), F.col("n").alias("n_shingles"), shown("root").alias("component_id")
        )

    def representatives(self, docs: DataFrame) -> DataFrame:
        """The document with the smallest id of each component, once, with all of its columns."""
        others = self.labelled(docs).filter("id <> root").select(F.col("id").alias("__id"), F.col("tag").alias("__tag"))
        tag = F.hash(F.coalesce("text", F.lit("")))
        match = (F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)) == F.col("__id")) & (tag == F.col("__tag"))
        kept = docs.join(others.distinct(), match, "left_anti").withColumn("__tag", tag)
        return kept.dropDuplicates(["doc_id", "__tag"]).drop("__tag")


def _dealt(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Rows of frequent shingles pass; the others give pairs, or pass if their group is large."""
    def seldom():
        for b in batches:
            often = b["often"].to_numpy(zero_copy_only=False)
            passed.append(b.filter(pa.array(often)))
            yield b.filter(pa.array(~often))

    passed: list[pa.RecordBatch] = []
    names = ["a", "b", "gram"]
    for out in _pairs(seldom(), share):
        yield out
        while passed:
            b = passed.pop()
            yield pa.RecordBatch.from_arrays([b["c1"], pa.nulls(len(b), pa.int64()), b["gram"]], names=names)
    while passed:
        b = passed.pop()
        yield pa.RecordBatch.from_arrays([b["c1"], pa.nulls(len(b), pa.int64()), b["gram"]], names=names)
