"""JSON Lines as raw rows: one ``map<string,variant>`` per good line.

A raw row keeps what a typed read loses: a missing key is not the same as a
null, and every value keeps its JSON kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsluice.functions.cells import PIN, pinned, unpinned
from rowsluice.functions.text import strip_space
from rowsluice.session import scratch_path

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
RAW_ROW = "map<string,variant>"


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time per row.

    Expressions are otherwise repeated wherever they are mentioned, which for
    JSON parsing costs more than everything done with the result.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_row(line: Column) -> Column:
    """A line as a raw row, or NULL unless it is exactly one JSON object.

    Spark's parser stops after the first value and ignores what follows it. A
    line is therefore read inside two different wrappers: as a field with
    another one after it, which rejects trailing text, and as the only element
    of an array (kept as text, which is cheap), which rejects further values.
    """
    framed = F.from_json(
        F.concat(F.lit('{"r":'), line, F.lit(',"z":1}')), f"struct<r:{RAW_ROW},z:int>", STRICT
    )
    alone = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>", STRICT)
    return once(framed, lambda f: F.when((f["z"] == 1) & (F.size(alone) == 1) & ~too_large(line), f["r"]))


# Fixed patterns: JSON strings and numbers, and lines that could hold a number beyond a double.
JSON_STRING = r'"(?:[^"\\]|\\.)*"'
JSON_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
LARGE_NUMBER = r"[0-9][eE][+]?[0-9]{3}|[0-9]{309}"


def too_large(line: Column) -> Column:
    """A number of the line, outside its texts, is too large for a double: such a line is no good row.

    Numbers are only looked at where one of them could be; others cost one search.
    """
    numbers = F.regexp_extract_all(F.regexp_replace(line, JSON_STRING, '""'), F.lit(JSON_NUMBER), F.lit(0))
    beyond = F.exists(numbers, lambda x: F.abs(x.try_cast("double")) == float("inf"))
    return F.when(line.rlike(LARGE_NUMBER), beyond).otherwise(F.lit(False))


def lower_keys(row: Column) -> Column:
    """Keys in lower case; of keys that are the same then, the last is kept."""

    def rewritten(entries: Column) -> Column:
        keys = F.transform(entries, lambda e: F.lower(e["key"]))
        return F.map_from_entries(
            F.filter(
                F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"])),
                lambda e, i: F.array_position(keys, e["key"]) == i + 1,
            )
        )

    def checked(entries_row: Column) -> Column:
        keys = F.map_keys(entries_row)
        joined = F.array_join(keys, "\n")
        plain = (joined == F.lower(joined)) & (F.size(F.array_distinct(keys)) == F.size(keys))
        return F.when(plain, entries_row).otherwise(
            once(F.reverse(F.map_entries(entries_row)), rewritten)
        )

    return once(row, checked)


def classify_lines(lines: DataFrame, column: str = "value", row: str = "row") -> DataFrame:
    """Every line with its raw row and state: ``row``, ``blank`` or ``malformed``."""
    text = strip_space(F.col(column))
    parsed = lines.withColumn(row, lower_keys(parse_row(text)))
    state = (
        F.when(F.coalesce(text, F.lit("")) == "", "blank")
        .when(F.col(row).isNull(), "malformed")
        .otherwise("row")
    )
    return parsed.withColumn("line_state", state)


def rows_from_lines(lines: DataFrame, column: str = "value", row: str = "row") -> DataFrame:
    """Good lines as raw rows; blank and malformed lines are left out."""
    parsed = lower_keys(parse_row(strip_space(F.col(column))))
    rows = pinned(lines, [parsed.alias(row)])
    return rows.filter(unpinned(rows, F.col(row).isNotNull())).drop(column, PIN)


LINE = "_line"


def kept_lines(lines: DataFrame, column: str = "value", row: str = "row") -> DataFrame:
    """Good lines as raw rows, and malformed ones with their text in ``_line`` (null for good ones).

    The form in which ``Ingest`` takes a stream whose malformed lines are to be set aside.
    """
    classified = pinned(lines, [lower_keys(parse_row(strip_space(F.col(column)))).alias(row)])
    good = unpinned(classified, F.col(row).isNotNull())
    text = F.when(~good, F.col(column)).alias(LINE)
    kept = classified.select(*[c for c in classified.columns if c not in (column, PIN)], text)
    return kept.filter(F.col(LINE).isNull() | (strip_space(F.col(LINE)) != ""))


def split_lines(lines: DataFrame, column: str = "value", row: str = "row") -> tuple[DataFrame, DataFrame]:
    """(good lines as raw rows, malformed lines with their text), parsed once.

    The parsed lines are written to the shared scratch folder, dealt into the two; blank lines are left out.
    """
    kept = kept_lines(lines, column, row)
    path = scratch_path(lines.sparkSession, "lines")
    kept.withColumn("good", F.col(LINE).isNull()).write.partitionBy("good").parquet(path)
    again = lines.sparkSession.read.schema(kept.schema.add("good", "boolean")).parquet(path)
    good = again.filter("good").drop("good", LINE)
    return good, again.filter("NOT good").drop("good", row).withColumnRenamed(LINE, column)


def line_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """How many lines hold a row, are blank or are malformed."""
    state = F.col("line_state")
    return classify_lines(lines, column).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(state == "row").alias("rows"),
        F.count_if(state == "blank").alias("blank"),
        F.count_if(state == "malformed").alias("malformed"),
    )


def read_jsonl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw rows of JSONL files and the ``file`` each came from.

    Files have no global row order: pass validators the columns that define it.
    Lines end at a line feed only: a bare carriage return is white space in JSON.
    """
    lines = spark.read.option("lineSep", "\n").text(path).withColumn("file", F.col("_metadata.file_path"))
    return rows_from_lines(lines)


def stream_jsonl(spark: SparkSession, path: str, malformed: bool = False, **options) -> DataFrame:
    """The same over a growing directory, as a stream; ``malformed`` lines are passed on in ``_line`` if asked for."""
    lines = (
        spark.readStream.options(**options)
        .option("lineSep", "\n")
        .text(path)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    return kept_lines(lines) if malformed else rows_from_lines(lines)
