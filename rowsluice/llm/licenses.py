"""Licence scans: a trained paragraph classifier, confirmed by templates.

Paragraphs are lines. Their words (ASCII lower case, letters and digits) and word pairs are binary
features of a sparse multinomial logistic regression over licence families and an unknown class.
It is trained on the templates below, each also with any one word left out, and on unknown
paragraphs: the fixed ones below and all lines of the corpus but a quarter kept aside, by hash. Lines
with the same features are one weighted row. A threshold is calibrated on the lines kept aside: the
probability of any licence that one unknown line in a thousand exceeds. A prediction above it is confirmed if the paragraph has most of the
weighted grams of one of the family's templates.

Everything runs as DataFrame operations; the fitted weights, a few hundred rows at most, are
broadcast.

Defined cases: a null or empty text has no paragraphs and no licence; ties of families go to the
first by name; repeated rows get equal rows; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, functions as F

from rowsluice.llm import common as c

# Notices by which works name their licence, and sentences that do not.
TEMPLATES = {
    "agpl": (
        "licensed under the GNU Affero General Public License",
        "this program is free software under the terms of the GNU Affero General Public License version 3",
    ),
    "apache": (
        "licensed under the Apache License version 2.0",
        "released under the Apache License 2.0",
        "you may not use this file except in compliance with the License you may obtain a copy of the License at apache.org",
    ),
    "bsd": (
        "released under the BSD 3-clause license",
        "licensed under the BSD license",
        "redistribution and use in source and binary forms with or without modification are permitted",
    ),
    "cc-by": (
        "licensed under CC BY 4.0",
        "this work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "cc-by-nc": (
        "licensed under CC BY-NC 4.0",
        "this work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc-by-sa": (
        "licensed under CC BY-SA 4.0",
        "this work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc0": (
        "released under CC0 1.0 universal public domain dedication",
        "this work is dedicated to the public domain",
    ),
    "gpl": (
        "this work is licensed under the GNU General Public License version 3",
        "licensed under the GNU General Public License",
        "released under the GPL version 2",
        "you can redistribute it and or modify it under the terms of the GNU General Public License",
    ),
    "lgpl": (
        "licensed under the GNU Lesser General Public License",
        "released under the LGPL version 2.1",
    ),
    "mit": (
        "released under the MIT License",
        "licensed under the MIT license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ),
    "mpl": (
        "this source code form is subject to the terms of the Mozilla Public License version 2.0",
        "licensed under the MPL 2.0",
    ),
    "reserved": (
        "all rights reserved",
        "copyright all rights reserved",
        "no part of this publication may be reproduced without prior written permission",
    ),
}
OTHERS = (
    "the driver showed a license to the officer",
    "she has a permit and a license for the boat",
    "the general public was invited to the opening",
    "this version of the story is free of errors",
    "the terms of the contract were read out under oath",
    "all rooms were reserved for the guests",
    "the foundation released the report in two volumes",
    "you may obtain a copy at the desk free of charge",
    "the right to use the road was granted to any person",
    "the source of the river is in the public forest",
    "he studied at MIT and worked under a famous engineer",
    "an attribution of the painting to the school of the master",
)
#: Words typical of licences: lines that have one are no examples of unknown paragraphs.
ABOUT = ("license", "licensed", "licence", "copyright", "reserved", "permission", "cc0", "redistribution")
UNKNOWN = "unknown"
FAMILIES = (*sorted(TEMPLATES), UNKNOWN)


def tokens(paragraph: Column) -> Column:
    """Words of a paragraph; separators at its ends leave empty ones, which no feature has."""
    low = F.translate(paragraph, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def exploded(rows: DataFrame, *keys: str) -> DataFrame:
    """The keys and each word (w) and pair (w and the next word) of ``words``, as gram."""
    after = F.slice("words", F.lit(2), F.size("words"))
    pairs = rows.select(*keys, F.explode(F.arrays_zip(F.col("words").alias("w"), after.alias("next"))).alias("p"))
    both = F.explode(F.array(F.col("p.w"), F.concat(F.col("p.w"), F.lit(" "), F.col("p.next"))))
    return pairs.select(*keys, both.alias("gram")).filter("gram <> ''")


def grams(words: Column) -> Column:
    """The distinct words and pairs, for the small tables of training rows."""
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda w, n: F.concat(w, F.lit(" "), n))
    return F.array_distinct(F.filter(F.concat(words, pairs), lambda g: g.isNotNull() & (g != "")))


@dataclass(frozen=True)
class LicenseScanner:
    """``max_unknown``: what the lines of the corpus weigh together at most, a template row being 1; ``overlap``:
    share of a template's grams to confirm."""

    max_unknown: int = 4_000
    regularisation: float = 0.002
    overlap: float = 0.6

    def templates(self, spark) -> DataFrame:
        rows = [(f, t) for f in sorted(TEMPLATES) for t in TEMPLATES[f]]
        return spark.createDataFrame(rows, "family string, template string").select(
            "family", tokens(F.col("template")).alias("words")
        )

    def vocabulary(self, spark) -> tuple[DataFrame, CountVectorizerModel]:
        """Training rows of the licence families (family, words, grams), and the grams that can tell these apart."""
        templates = self.templates(spark)
        shorter = templates.select("family", F.posexplode("words").alias("i", "w"), "words").select(
            "family", F.filter("words", lambda w, i: i != F.col("i")).alias("words")
        )
        known = templates.unionByName(shorter).filter(F.size("words") > 1).withColumn("grams", grams(F.col("words")))
        known = c.stored(known, "licence-rows").coalesce(2)
        # only grams of templates can tell families apart; two occurrences at least
        return known, CountVectorizer(inputCol="grams", outputCol="x", binary=True, minDF=2.0, vocabSize=1 << 16).fit(known)

    def lines(self, docs: DataFrame, vocabulary: list[str]) -> DataFrame:
        """doc_id, key, line, aside, about and the listed grams of each line that has one, stored.

        ``about``: the line has a word that is typical of licences, so it is not known to be unknown.
        """
        spark = docs.sparkSession
        listed = dict.fromkeys(vocabulary, False) | dict.fromkeys(ABOUT, True)
        words = spark.createDataFrame([(g, a, g in vocabulary) for g, a in listed.items()], "gram string, typical boolean, feature boolean")
        rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("key"), "text")
        split = rows.select("doc_id", "key", F.posexplode(F.split("text", "\n")).alias("line", "paragraph"))
        aside = (F.pmod(F.xxhash64(F.xxhash64("paragraph")), F.lit(4)) == 0).alias("aside")
        keys = ["doc_id", "key", "line", "aside"]
        hits = exploded(split.select(*keys[:3], aside, tokens(F.col("paragraph")).alias("words")), *keys).join(F.broadcast(words), "gram")
        found = F.sort_array(F.collect_set(F.when(F.col("feature"), F.col("gram")))).alias("grams")
        return c.stored(hits.groupBy(*keys).agg(found, F.bool_or("typical").alias("about")), "licence-lines")

    def unknown(self, docs: DataFrame, lines: DataFrame) -> DataFrame:
        """grams, aside and n, the number of such lines of the corpus; lines without a gram are shared out by four."""
        rows = lines.filter("NOT about").groupBy("grams", "aside").agg(F.count("*").alias("n"))
        every = docs.agg(F.sum(F.regexp_count("text", F.lit(r"[^\n]+"))).alias("every"))
        others = every.crossJoin(lines.agg(F.count("*").alias("seen"))).select((F.coalesce("every", F.lit(0)) - F.col("seen")).alias("n"))
        quarter = F.floor(F.col("n") / 4)
        share = F.explode(F.array(F.struct(F.lit(False).alias("aside"), (F.col("n") - quarter).alias("n")), F.struct(F.lit(True).alias("aside"), quarter.alias("n"))))
        others = others.select(share.alias("x")).select(F.array().cast("array<string>").alias("grams"), "x.aside", "x.n").filter("n > 0")
        return c.stored(rows.unionByName(others), "licence-unknown")

    def fit(self, docs: DataFrame, lines: DataFrame, known: DataFrame, counts: CountVectorizerModel) -> tuple[DataFrame, dict[str, float], float]:
        """Weights (gram, w_0 ...), intercepts by family and the calibrated threshold, from all lines."""
        spark = docs.sparkSession
        fixed = spark.createDataFrame([(t,) for t in OTHERS], "t string").select(
            F.lit(UNKNOWN).alias("family"), grams(tokens(F.col("t"))).alias("grams")
        )
        unknown = self.unknown(docs, lines)
        total = unknown.filter("NOT aside").agg(F.sum("n")).first()[0] or 0
        each = min(1.0, 0.75 * self.max_unknown / total) if total else 1.0
        corpus = unknown.filter("NOT aside").select(F.lit(UNKNOWN).alias("family"), "grams", (F.col("n") * each).alias("weight"))
        rows = known.select("family", "grams").unionByName(fixed).withColumn("weight", F.lit(1.0)).unionByName(corpus)
        label = F.array_position(F.array(*(F.lit(f) for f in FAMILIES)), F.col("family")) - 1
        training = rows.select(label.cast("double").alias("label"), "grams", "weight")
        model = LogisticRegression(
            featuresCol="x", family="multinomial", regParam=self.regularisation, elasticNetParam=1.0, maxIter=60, weightCol="weight"
        ).fit(counts.transform(training))
        matrix = model.coefficientMatrix.toArray()
        found = [
            (gram, *(float(v) for v in matrix[:, j]))
            for j, gram in enumerate(counts.vocabulary) if abs(matrix[:, j]).max() > 1e-9
        ]
        names = ", ".join(f"w_{i} double" for i in range(len(FAMILIES)))
        weights = spark.createDataFrame(found, f"gram string, {names}")
        intercepts = dict(zip(FAMILIES, (float(v) for v in model.interceptVector.toArray())))
        aside = unknown.filter("aside").withColumn("id", F.monotonically_increasing_id())
        scored = self._scored(aside.select("id", "n", F.explode("grams").alias("gram")), weights, intercepts, ["id", "n"])
        # scores to six digits, so that there are a million at most
        counted = scored.groupBy((F.floor(F.col("score") * 1_000_000) / 1_000_000).alias("score")).agg(F.sum("n").alias("n"))
        quantile = counted.agg(F.percentile("score", 0.999, F.col("n"))).first()[0]
        return weights, intercepts, max(0.5, float(quantile or 0.0))

    def _scored(self, rows: DataFrame, weights: DataFrame, intercepts: dict[str, float], keys: list[str]) -> DataFrame:
        """For the keys with a known gram: these grams, the likeliest family and the probability of any."""
        sums = [F.sum(f"w_{i}").alias(f"w_{i}") for i in range(len(FAMILIES))]
        totals = rows.join(F.broadcast(weights), "gram").groupBy(*keys).agg(*sums, F.collect_set("gram").alias("grams"))
        logits = [F.col(f"w_{i}") + F.lit(intercepts[f]) for i, f in enumerate(FAMILIES)]
        top = F.greatest(*logits)
        shares = [F.exp(x - top) for x in logits]
        total = sum(shares[1:], shares[0])
        best = F.greatest(*logits[:-1])
        family = F.coalesce(*(F.when(x == best, F.lit(f)) for f, x in zip(FAMILIES[:-1], logits)))
        return totals.select(*keys, "grams", family.alias("family"), (1 - shares[-1] / total).alias("score"))

    def predicted(self, docs: DataFrame) -> DataFrame:
        """doc_id, key, line, family, score and confirmed, for each paragraph above the threshold.

        A template is compared by those of its grams that have a weight.
        """
        rows, counts = self.vocabulary(docs.sparkSession)
        lines = self.lines(docs, counts.vocabulary)
        weights, intercepts, threshold = self.fit(docs, lines, rows, counts)
        keys = ["doc_id", "key", "line"]
        known = F.broadcast(weights.select("gram"))
        hits = lines.select(*keys, F.explode("grams").alias("gram"))
        scored = self._scored(hits, weights, intercepts, keys).filter(F.col("score") >= threshold)
        templates = self.templates(docs.sparkSession).select("family", F.monotonically_increasing_id().alias("t"), F.explode(grams(F.col("words"))).alias("gram"))
        templates = templates.join(known, "gram").groupBy("family", "t").agg(F.collect_set("gram").alias("template"))
        common = F.size(F.array_intersect("grams", "template")) / F.size("template")
        return (
            scored.join(F.broadcast(templates), "family")
            .groupBy(*keys, "family", "score")
            .agg((F.max(common) >= self.overlap).alias("confirmed"))
        )

    def scanned(self, docs: DataFrame) -> DataFrame:
        """A row per document: its licence paragraphs, and its likeliest family or ``unknown``."""
        found = self.predicted(docs).groupBy("doc_id", "key").agg(
            F.count_if("confirmed").alias("n_confirmed"), F.count("*").alias("n_predicted"),
            F.max(F.when(F.col("confirmed"), F.struct("score", "family"))).alias("best"),
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
        )
        rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("key"))
        match = (F.col("d.key") == F.col("f.key")) & F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
        return rows.alias("d").join(found.alias("f"), match, "left").select(
            F.col("d.doc_id").alias("doc_id"),
            F.coalesce("best.family", F.lit(UNKNOWN)).alias("family"),
            F.coalesce("families", F.lit("")).alias("families"),
            F.coalesce(F.round("best.score", 6), F.lit(0.0)).alias("score"),
            F.coalesce("n_predicted", F.lit(0)).alias("n_predicted"),
            F.coalesce("n_confirmed", F.lit(0)).alias("n_confirmed"),
        )
