"""What streaming loads share: one pass that stages rows, and the writing of a judged batch.

A staged row has the target's columns in their types, its row-local violations, its place (row order, a
digest of its content, and a number that tells identical rows apart) and a digest of each unique key. Parsing
and validation are done once; everything after works on staged rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsluice.operators.keys import has_all, row_digest
from rowsluice.operators.project import write_projection
from rowsluice.operators.spec import TableSpec
from rowsluice.operators.validate import ValidationFailed, Validator
from rowsluice.sources.jsonl import LINE
from rowsluice.streaming.progress import OBSERVED

LOADED, REJECTED, MALFORMED = "loaded", "rejected", "malformed"
#: A row that breaks no rule by itself.
SOUND = "size(_hits) = 0"


def key_digests(validator: Validator, rows: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """``rows`` with a digest of each unique key, null where a part is missing; their names and the keys' labels."""
    keyed, keys = validator.keyed(rows)
    labels = [",".join(key) for _, key in keys]
    digests = {}
    for i, (names, _) in enumerate(keys):
        parts = F.struct(F.lit(labels[i]).alias("key"), *[F.col(n).alias(f"p{j}") for j, n in enumerate(names)])
        digests[f"_digest{i}"] = F.when(has_all(names), F.unhex(F.sha2(F.to_json(parts), 256)))
    return keyed.withColumns(digests) if digests else keyed, list(digests), labels


@dataclass(frozen=True)
class StagedLoad:
    """A streaming load of one table into the folders ``loaded`` (target rows) and ``rejected`` (violations)
    below ``root``.

    Each batch overwrites its own ``batch_id=`` folder, so a replay leaves no duplicates. ``policy`` is
    ``quarantine`` or ``abort``; the latter fails the query at the first bad batch and keeps the
    batches before it.
    """

    spec: TableSpec
    root: str
    order: tuple[str, ...]
    row: str | None = "row"
    strict: bool = False
    policy: str = "quarantine"

    def path(self, part: str, batch_id: int | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{part}"
        return base if batch_id is None else f"{base}/batch_id={batch_id}"

    @property
    def validator(self) -> Validator:
        return Validator(self.spec, self.order, self.row, self.strict, convertible=True)

    def staged(self, rows: DataFrame) -> tuple[DataFrame, list[str]]:
        """Staged rows, of a stream or a batch, and the labels of the unique keys."""
        validator = self.validator
        prepared = validator.prepared(rows)
        judged = prepared.select(*rows.columns, validator.hits(prepared).alias("_hits"))
        keyed, digests, labels = key_digests(validator, judged)
        place = F.struct(*self.order, row_digest(rows).alias("_content")).alias("_place")
        keyed = keyed.select(*rows.columns, "_hits", place, *digests)
        carried = ("_hits", "_place", *digests, *([LINE] if LINE in rows.columns else []))
        typed = write_projection(keyed, self.spec, self.row, carried)
        if rows.isStreaming:
            read = F.count(F.lit(1)).alias("read")
            typed = typed.observe(f"{OBSERVED}{self.spec.name}", read, F.count_if(F.expr(SOUND)).alias("sound"))
        return typed.withColumn("_repeats", F.array().cast("array<int>")), labels

    def kept(self, frame: DataFrame, name: str) -> DataFrame:
        """``frame`` written to a folder that the next batch overwrites, and read again.

        What follows is planned over plain files, and a lost executor costs no second parsing.
        """
        path = self.path(f"_batch/{name}")
        frame.write.mode("overwrite").parquet(path)
        return frame.sparkSession.read.schema(frame.schema).parquet(path)

    def set_aside(self, staged: DataFrame, batch_id: int) -> DataFrame:
        """Kept rows without malformed lines, which go to the folder ``malformed``."""
        if LINE not in staged.columns:
            return staged
        lines = staged.filter(F.col(LINE).isNotNull()).select(*self.places(), F.col(LINE).alias("line"))
        lines.write.mode("overwrite").parquet(self.path(MALFORMED, batch_id))
        return staged.filter(F.col(LINE).isNull()).drop(LINE)

    def numbered(self, staged: DataFrame, batch_id: int) -> DataFrame:
        """The staged rows of a batch, kept and without malformed lines; a number in their place tells identical rows apart."""
        number = F.col("_place").withField("_number", F.monotonically_increasing_id())
        return self.set_aside(self.kept(staged.withColumn("_place", number), "staged"), batch_id)

    def repeated(self, rows: DataFrame, shared: DataFrame, number: int, again: Column) -> DataFrame:
        """``rows`` with ``number`` added to the repeats where ``again``; ``shared`` has only keys that repeat.

        A key of very many rows is left to AQE's skew join.
        """
        repeats = F.when(again, F.array_append("_repeats", F.lit(number))).otherwise(F.col("_repeats"))
        return rows.join(shared, f"_digest{number}", "left").withColumn("_repeats", repeats).select(rows.columns)

    def malformed(self, spark: SparkSession) -> DataFrame:
        """The lines of the stream that hold no row (of rows with ``_line``, see ``kept_lines``)."""
        return spark.read.parquet(self.path(MALFORMED)).drop("batch_id")

    def write_judged(self, batch: DataFrame, batch_id: int, labels: list[str]) -> None:
        """Write a kept batch whose ``_repeats`` have the numbers of the unique keys that an earlier row has."""
        violations = self.violations(batch, labels)
        if self.policy == "abort":
            first = violations.orderBy(*self.order, "ordinal", "rule").limit(1).collect()
            if first:
                raise ValidationFailed(first[0])
        good = batch.filter(f"{SOUND} AND size(_repeats) = 0")
        good.select(*[c.name for c in self.spec.columns]).write.mode("overwrite").parquet(self.path(LOADED, batch_id))
        violations.write.mode("overwrite").parquet(self.path(REJECTED, batch_id))

    def places(self) -> list[Column]:
        return [F.col(f"_place.{c}").alias(c) for c in self.order]

    def violations(self, batch: DataFrame, labels: list[str]) -> DataFrame:
        repeats = F.transform("_repeats", lambda i: self._repeat(i, labels)) if labels else F.slice("_hits", 1, 0)
        hits = batch.select(*self.places(), F.explode(F.concat("_hits", repeats)).alias("hit"))
        return hits.select(*self.order, "hit.*", F.lit(self.spec.name).alias("table_name"))

    def _repeat(self, number: Column, labels: list[str]) -> Column:
        pick = lambda values: F.get(F.array(*values), number)
        ordinals = [F.lit(self.spec.by_name[label.split(",")[0].lower()][0]) for label in labels]
        return F.struct(
            pick(ordinals).alias("ordinal"),
            pick([F.lit(label) for label in labels]).alias("column_name"),
            F.lit("unique").alias("rule"),
            F.lower(F.hex(pick([F.col(f"_digest{i}") for i in range(len(labels))]))).alias("value"),
            pick([F.lit(f'an earlier row has the same "{label}"') for label in labels]).alias("message"),
        )

    def loaded(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path(LOADED)).drop("batch_id")

    def rejected(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path(REJECTED)).drop("batch_id")
