"""Quality rules with cross-document line frequency.

Lines are normalised (ASCII lower case, digits as 0, white space collapsed) and hashed.
For each host the distinct texts with a line are counted; a line in more than
``max_texts`` of them is boilerplate and is removed from all of the host's documents but
the first (smallest id) that has it. A document that keeps less than ``least_left`` of its
words is depleted and rejected, as is one that breaks the base rules. The first document is the
first that passes the base rules; with ``first_passing=False`` rejected ones can be it too.
``cleaned`` returns the accepted documents without the removed lines.

Defined cases: a null or empty text has no words and fails the base rules; a null host is
one host of its own; exact copies count as one text; repeated rows get equal rows; an empty
table gives no rows; further columns of ``docs`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsluice.llm import common as c

SALTS = 16
#: Rows whose texts are held as strings at once.
ROWS = 1_000
NORMAL = c.LOWER.copy()
NORMAL[0x30:0x3A] = 0x30
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
PROFILE = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.int64()), ("host", pa.string()), ("text_hash", pa.int64())]
    + [(n, pa.int64()) for n in COUNTS]
    + [("lines", pa.list_(pa.int64())), ("line_words", pa.list_(pa.int32()))]
)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[place] > 1


def _profile_chunk(data: np.ndarray, offsets: np.ndarray) -> dict:
    n_docs = len(offsets) - 1
    starts, ends, doc = c.words(data, offsets, c.separators("spaces"))
    first = c.word_bounds(doc, n_docs)
    per_doc = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])
    inside = ~c.separators("spaces")[data] & ((data & 0xC0) != 0x80)
    out = {"n_words": np.diff(first), "word_chars": per_doc(inside), "n_symbols": per_doc(SYMBOLS[data])}
    # lines with a word, by the line of each word
    breaks = np.concatenate(([0], np.cumsum(data == 0x0A)))
    line = breaks[starts] + doc
    new = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) if len(line) else line
    line_doc, line_first = doc[new], np.append(new, len(line))
    cuts = np.flatnonzero(data == 0x0A)
    bounds = np.concatenate(([-1], cuts, [len(data)]))
    at = breaks[starts[new]]
    begin = np.maximum(bounds[at] + 1, offsets[line_doc])
    end = np.minimum(bounds[at + 1], offsets[line_doc + 1])
    raw = c.range_hash(data, begin, end) ^ c.mix(line_doc.astype(c.U))
    copies = len(raw) and np.bincount(line_doc, minlength=n_docs) - np.bincount(
        line_doc[np.unique(raw, return_index=True)[1]], minlength=n_docs
    )
    out["n_dup_lines"] = copies if len(raw) else np.zeros(n_docs, np.int64)
    # words in windows of three that occur again in their text
    hashes = c.range_hash(data, starts, ends)
    windows = c.rolled(hashes, 3)
    inner = doc[: len(windows)] == doc[2 : 2 + len(windows)]
    at = np.flatnonzero(inner)
    again = at[_repeated(windows[at] ^ c.mix(doc[at].astype(c.U) + c.U(1)))] if len(at) else at
    covered = c.flags_from_ranges(len(doc), again, again + 3)
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n_docs)
    # normalised lines
    normal = c.range_hash(NORMAL[data], starts, ends)
    place = (np.arange(len(starts)) - np.repeat(line_first[:-1], np.diff(line_first))).astype(c.U)
    spread = c.mix(normal + place * c.U(0x9E3779B97F4A7C15))
    out["lines"] = c.mix(np.add.reduceat(spread, new)).view(np.int64) if len(new) else np.zeros(0, np.int64)
    out["line_begin"], out["line_end"] = begin, end
    out["line_words"] = np.diff(line_first).astype(np.int32)
    out["line_offsets"] = np.searchsorted(line_doc, np.arange(n_docs + 1)).astype(np.int32)
    out["text_hash"] = c.range_hash(data, offsets[:-1], offsets[1:]).view(np.int64)
    return out


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, end, data, offsets in c.chunks(b["text"], c.HALF):
            got = _profile_chunk(data, offsets)
            cuts = pa.array(got["line_offsets"])
            yield pa.RecordBatch.from_arrays(
                [
                    *(b[n].slice(first, end - first) for n in ("doc_id", "key", "host")),
                    pa.array(got["text_hash"]),
                    *(pa.array(got[n].astype(np.int64)) for n in COUNTS),
                    pa.ListArray.from_arrays(cuts, pa.array(got["lines"])),
                    pa.ListArray.from_arrays(cuts, pa.array(got["line_words"])),
                ],
                schema=PROFILE,
            )


def _shortened(texts: pa.Array, removed: pa.Array) -> Iterator[bytes]:
    """Each text without the lines whose hashes are listed for it."""
    for first, _, data, offsets in c.chunks(texts, c.HALF):
        got = _profile_chunk(data, offsets)
        cuts = got["line_offsets"]
        for i, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            lines = slice(cuts[i], cuts[i + 1])
            gone = np.isin(got["lines"][lines], removed[first + i].values.to_numpy())
            begins, ends = got["line_begin"][lines][gone], got["line_end"][lines][gone]
            drop = c.flags_from_ranges(z - a, begins - a, np.minimum(ends + 1, z) - a)
            text = data[a:z][~drop].tobytes()
            # no line follows the break before a removed last line
            yield text[:-1] if len(ends) and ends[-1] == z and text.endswith(b"\n") else text


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the lines listed in __lines removed from their text."""
    for b in (whole.slice(at, ROWS) for whole in batches for at in range(0, len(whole), ROWS)):
        lines, at = b["__lines"], b.schema.get_field_index("text")
        b = b.drop_columns(["__lines"])
        some = np.flatnonzero(lines.is_valid().to_numpy(zero_copy_only=False))
        if len(some):
            texts, rows = b["text"].to_pylist(), pa.array(some)
            for i, text in zip(some.tolist(), _shortened(b["text"].take(rows), lines.take(rows))):
                texts[i] = text.decode()
            b = b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))
        yield b


@dataclass(frozen=True)
class LineFrequency:
    """``max_texts``: distinct texts of a host that may share a line; ``least_left``: share of words to keep."""

    max_texts: int = 100
    least_left: float = 0.2
    min_words: int = 50
    host: str = "source"
    first_passing: bool = True

    def _failed(self):
        return (F.col("n_words") < self.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)

    def keyed(self, docs: DataFrame) -> DataFrame:
        """doc_id, text, host and a key of the row."""
        text, host = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col(f"`{self.host}`"), F.lit(""))
        return docs.select(
            F.col("doc_id").cast("long"), text.alias("text"), host.cast("string").alias("host")
        ).withColumn("key", F.xxhash64("doc_id", "text", "host"))

    def profile(self, docs: DataFrame) -> DataFrame:
        """Base counts and the hashed lines of each document, stored."""
        schema = (
            "doc_id long, key long, host string, text_hash long, "
            + ", ".join(f"{n} long" for n in COUNTS)
            + ", lines array<long>, line_words array<int>"
        )
        rows = c.in_arrow(self.keyed(docs), _profile, schema)
        return c.stored(rows.withColumn("row", F.monotonically_increasing_id()), "quality")

    def boilerplate(self, profile: DataFrame) -> DataFrame:
        """host, line, first_doc of the lines above the limit."""
        passes = F.lit(True) if not self.first_passing else ~self._failed()
        lines = profile.select(
            "host", "text_hash", "doc_id", passes.alias("passes"), F.explode(F.array_distinct("lines")).alias("line")
        )
        texts = lines.groupBy("host", "line", "text_hash").agg(F.min("doc_id").alias("doc_id"), F.max("passes").alias("passes"))
        first = F.coalesce(F.min(F.when(F.col("passes"), F.col("doc_id"))), F.min("doc_id"))
        return (
            texts.groupBy("host", "line")
            .agg(F.count("*").alias("n_texts"), first.alias("first_doc"))
            .filter(F.col("n_texts") > self.max_texts)
        )

    def judged(self, docs: DataFrame) -> DataFrame:
        """Base counts, words and hashes of removed lines and the verdict, a row per document."""
        profile = self.profile(docs)
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        common = self.boilerplate(profile).select("host", "line", "first_doc", salts.alias("salt"))
        salt = F.pmod("doc_id", F.lit(SALTS)).cast("int").alias("salt")
        removed = (
            profile.select("row", "doc_id", "host", salt, F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
            .select("row", "doc_id", "host", "salt", F.col("l.lines").alias("line"), F.col("l.line_words").alias("w"))
            .join(common, ["host", "line", "salt"])
            .filter(F.col("doc_id") != F.col("first_doc"))
            .groupBy("row").agg(F.sum("w").alias("n_removed"), F.collect_set("line").alias("removed"))
        )
        left = F.col("n_words") - F.col("n_removed")
        return (
            profile.drop("lines", "line_words")
            .join(removed, "row", "left")
            .withColumn("n_removed", F.coalesce("n_removed", F.lit(0)))
            .withColumn("base_failed", self._failed())
            .withColumn("depleted", (F.col("n_removed") > 0) & (left < F.col("n_words") * self.least_left))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        )

    def _with(self, docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
        """``docs`` joined with verdicts (key, doc_id and further columns), whose rows are distinct."""
        verdicts = verdicts.withColumnsRenamed({"key": "__key", "doc_id": "__id"})
        text, host = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col(f"`{self.host}`"), F.lit(""))
        key = F.xxhash64(F.col("doc_id").cast("long"), text, host.cast("string"))
        match = (key == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
        return docs.join(verdicts, match, how)

    def accepted(self, docs: DataFrame) -> DataFrame:
        """The accepted documents with all of their columns, texts as they are."""
        return self._with(docs, self.judged(docs).filter(~F.col("kept")).select("key", "doc_id").distinct(), "left_anti")

    def cleaned(self, docs: DataFrame) -> DataFrame:
        """The accepted documents with all of their columns, the removed lines cut from their texts."""
        told = self.judged(docs).filter(~F.col("kept") | (F.col("n_removed") > 0)).select(
            "key", "doc_id", F.col("kept").alias("__kept"), F.col("removed").alias("__lines")
        )
        joined = self._with(docs, told.dropDuplicates(["key", "doc_id"]), "left").filter(F.coalesce("__kept", F.lit(True)))
        columns = [F.col(f"`{n}`") for n in docs.columns]
        return c.in_arrow(joined.select(*columns, "__lines"), _without, docs.schema)
