"""Shared helpers: scratch tables, and vectorised words and hashes of Arrow text.

Texts stay in Arrow's UTF-8 buffers. Words are found by table lookups on bytes and
hashed with prefix sums of a polynomial, so no Python object is made per word. A null
text counts as empty everywhere.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowsluice.session import scratch_path

#: Bytes of text handled at once; one longer document is a chunk of its own. With the end, the places of a chunk
#: are a power of two, as are the tables of the hash. Operators that keep many numbers for each byte take half as much.
CHUNK, HALF = (1 << 21) - 1, (1 << 20) - 1
#: Bytes of input after which a task gives unused memory back, and tables that a worker keeps only as long as steps name them.
GIVEN_BACK, LARGE = 1 << 24, ("encoder ", "aligner ", "pieces ", "decimals ")
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
U = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    """The byte-level BPE's file, from the installed vocabulary package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    """The SentencePiece model's file, from the same package."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read again.

    It cuts the lineage, survives lost executors and lets Spark delete the shuffle
    files behind it at once.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    path = scratch_path(spark, label)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def separators(kept: str) -> np.ndarray:
    """True for the bytes that separate words: ``spaces`` or all but digits, letters and non-ASCII."""
    sep = np.zeros(256, bool)
    if kept == "spaces":
        sep[[0x20, *range(0x09, 0x0E)]] = True
    else:
        sep[:0x80] = True
        sep[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False
    return sep


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def _kept() -> dict:
    return vars(sys.modules.setdefault("_rowsluice_llm_kept", types.ModuleType("_rowsluice_llm_kept")))


def once(key: str, make: Callable):
    """``make()``, kept by this worker process for its later tasks too."""
    kept = _kept()
    if key not in kept:
        kept[key] = make()
    return kept[key]


def give_back() -> None:
    """Return to the system what Arrow and the C library hold unused; else a worker holds the most it ever took."""
    pa.default_memory_pool().release_unused()
    trim = once("malloc_trim", lambda: getattr(ctypes.CDLL(None), "malloc_trim", None))  # glibc has it
    if trim:
        trim(0)


def _lean(batches: Iterator[pa.RecordBatch], task: Callable, keeps: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for key in [k for k in _kept() if k.startswith(LARGE) and not k.startswith(keeps)]:
        del _kept()[key]

    def taken() -> Iterator[pa.RecordBatch]:
        read = 0
        for b in batches:
            read += b.nbytes
            yield b
            del b
            if read >= GIVEN_BACK:
                give_back()
                read = 0

    try:
        yield from task(taken())
    finally:
        give_back()


def in_arrow(df: DataFrame, task: Callable, schema: str, keeps: tuple[str, ...] = ()) -> DataFrame:
    """``df.mapInArrow(task, schema)`` by workers that give unused memory back as they go and when a task ends.

    Workers live on between tasks and steps, so what they hold idle adds to what other tasks of their executor take.
    Large tables of other steps (``LARGE``) are dropped, but for those whose keys start as ``keeps`` says.
    """
    return df.mapInArrow(partial(_lean, task=task, keeps=keeps), schema)


PRIME = (1 << 61) - 1
BASE = 0x0A3F59C7D12E8B65  # below PRIME; any value of large order does
#: Powers are kept in three pieces of 20 and 21 bits. With byte values of 16 bits, sums of their
#: products over 2^26 bytes stay below 2^63, so that prefix sums are exact and reduced only at the end.
PIECE = 20
PIECE_MASK = U((1 << PIECE) - 1)


def _table(seed: int) -> np.ndarray:
    """A value below 2^16 for each byte, all of them different and not 0."""
    return once(f"bytes{seed}", lambda: (np.random.default_rng(seed).permutation((1 << 16) - 1)[:256] + 1).astype(U))


def reduced(x: np.ndarray) -> np.ndarray:
    """Modulo PRIME, of any 64-bit values."""
    x = (x & U(PRIME)) + (x >> U(61))
    return np.where(x >= U(PRIME), x - U(PRIME), x)


def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of values below it."""
    low, high = U(0xFFFFFFFF), U(32)
    xl, xh, yl, yh = x & low, x >> high, y & low, y >> high
    middle = reduced(xl * yh) + reduced(xh * yl)  # below 2^62
    middle = reduced(middle)
    # 2^64 = 8 and 2^32 * (a * 2^29 + b) = a + b * 2^32 modulo PRIME
    shifted = (middle >> U(29)) + ((middle & U((1 << 29) - 1)) << high)
    return reduced(reduced(xl * yl) + reduced(shifted) + reduced((xh * yh) << U(3)))


def _grown(base: int, n: int) -> np.ndarray:
    """The first n powers of a base, by doubling."""
    out = np.ones(n, U)
    done, step = 1, base
    while done < n:
        some = min(done, n - done)
        out[done : done + some] = times(out[:some], np.full(some, step, U))
        done, step = done + some, step * step % PRIME
    return out


def _power_tables(bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    up = _grown(BASE, 1 << bits)
    pieces = [(up >> U(PIECE * k) & PIECE_MASK).astype(np.uint32) for k in (0, 1)] + [(up >> U(2 * PIECE)).astype(np.uint32)]
    return pieces, _grown(pow(BASE, -1, PRIME), 1 << bits)


def powers(n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Powers of the hash base in pieces, and of its inverse, for at least ``n`` places."""
    bits = max(20, int(n - 1).bit_length())
    return _power_tables(bits) if bits > 24 else once(f"powers{bits}", lambda: _power_tables(bits))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def range_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each pair of places: a polynomial modulo 2^61 - 1.

    (Modulo a power of two, texts like the Thue-Morse words have equal hashes whatever the base.)
    """
    pieces, down = powers(len(data) + 1)
    values, total = _table(seed)[data], np.zeros(len(starts), U)
    sums = np.zeros(len(data) + 1, U)
    for k, piece in enumerate(pieces):
        np.cumsum(values * piece[: len(data)], out=sums[1:])
        part = reduced(sums[ends] - sums[starts])
        total = reduced(total + (times(part, np.full(len(part), 1 << PIECE * k, U)) if k else part))
    h = times(total, down[starts])
    return mix(h + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def _joined_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in their order; for either of them fixed, different others give different results."""
    h = a * U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    h += b
    return mix(h)


def window_hash(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive bytes: eight bytes at first, then halves that are joined and mixed.

    (Mixing between the joins is no polynomial, so that Thue-Morse words do not collide.)
    """
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    if k < 8:
        at = np.arange(n)
        return range_hash(data, at, at + k)
    h, span = mix(np.array(np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,)))), 8
    while span * 2 <= k:
        h = _joined_hash(h[:-span], h[span:])
        span *= 2
    return _joined_hash(h[:n], h[k - span : k - span + n]) if span < k else h


#: Bytes that a word's hash takes in at once, and the longest words that it takes so.
LANE, LONGEST = 7, 448


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial modulo 2^61 - 1 of seven bytes at once; long words as in ``range_hash``."""
    n = ends - starts
    # the eight bytes from each place, little-endian; zeros follow the last ones
    lanes = np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(8, np.uint8))), 0, (1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(LANE + 1)], U)
    h = lanes[starts] & masks[np.minimum(n, LANE)]
    done, at = LANE, np.flatnonzero((n > LANE) & (n <= LONGEST))
    while len(at):
        lane = lanes[starts[at] + done] & masks[np.minimum(n[at] - done, LANE)]
        h[at] = reduced(times(h[at], np.full(len(at), BASE, U)) + lane)
        done += LANE
        at = at[n[at] > done]
    h = mix(h + n.astype(U) * U(0xD6E8FEB86659FD93))
    long = np.flatnonzero(n > LONGEST)
    if len(long):
        h[long] = range_hash(data, starts[long], ends[long])
    return h


def rolled(symbols: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive symbols."""
    n = len(symbols) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    h = symbols[:n].copy()
    for j in range(1, k):
        h *= U(0xA0761D6478BD642F)
        h += symbols[j : j + n]
    return mix(h)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    span, m = 1, x
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[:n], m[w - span : w - span + n])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column and the offsets of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of at most ``size`` bytes, documents whole."""
    if not len(column):
        return
    data, offsets = buffers(column)
    first = 0
    while first < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), first + 20_000, len(offsets) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray):
    """Start, end and document of each word; words never cross documents."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~sep[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_bounds(doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Index of each document's first word, and the end."""
    return np.searchsorted(doc, np.arange(n_docs + 1))


def flags_from_ranges(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for the places covered by any [start, end)."""
    depth = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(depth[:n]) > 0

