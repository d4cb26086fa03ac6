"""SentencePiece byte-pair encoding and decoding of whole texts, by vectorised merge rounds.

The symbols of many words lie in one flat array. Each round finds every word's smallest pair rank
by a segmented minimum, merges all leftmost non-overlapping pairs of that rank at once, looks up the
two new neighbours of each merge, and compacts the array; words without a pair left drop out.

The library merges one pair at a time. Merging all pairs of a rank is the same as long as no merge
can give rise to a pair of the same or a better rank; pieces for which the vocabulary does not rule
that out (``safe``) are merged one per word and round, and a long word that meets one goes on with
a heap. Words are cut where no piece of the vocabulary spans the two characters, which also bounds
what is held for a text without spaces. A space is the start of a word in every such vocabulary, so
each word is encoded once per worker and looked up afterwards.

The model file is read here; it has to be a BPE model without normalisation rules, with a dummy
prefix and byte fallback. Texts are handled in pieces of about a megabyte, whatever their length.

Defined cases: a null or empty text has no ids and decodes to an empty text; ``<s>`` and the like in
a text are ordinary characters; repeated rows are given once each; an empty table gives no rows;
a null doc_id is kept; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsluice.llm import common as c
from rowsluice.llm.words import Known, distinct, text_buffers

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format
NONE = np.iinfo(np.int64).max
PART = 1 << 20
KNOWN_CHARS = 8_000_000
SHORT = 64
SAFE_CUT = re.compile(f"(?<=[^ {SPACE}])[ {SPACE}](?=.)", re.DOTALL)
REPLACEMENT, UNKNOWN_TEXT = "�".encode(), " ⁇ ".encode()


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        size = {0: 0, 1: 8, 5: 4}.get(key & 7)
        if size == 0:
            yield key >> 3, number()
            continue
        size = number() if size is None else size
        yield key >> 3, message[at : at + size]
        at += size


class Model:
    """Pieces, scores and types of a model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            top = list(_fields(f.read()))
        pieces = [dict(_fields(v)) for k, v in top if k == 1]
        trainer = dict(_fields(next(v for k, v in top if k == 2)))
        normalizer = dict(_fields(next(v for k, v in top if k == 3)))
        self.pieces = [p[1].decode() for p in pieces]
        self.scores = np.array([struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces])
        self.types = np.array([p.get(3, NORMAL) for p in pieces])
        plain = not normalizer.get(2) and normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1)
        if trainer.get(3) != 2 or not trainer.get(35) or not plain or not set(self.types.tolist()) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path} is not a plain BPE model with byte fallback")


class Merger:
    """Merge rounds over the symbols of many words.

    A symbol is a piece's id, or ``n_pieces`` plus the code point of a character without a piece.
    """

    def __init__(self, model: Model):
        normal = {p: i for i, p in enumerate(model.pieces) if model.types[i] == NORMAL}
        self.n_pieces, self.base = len(model.pieces), len(model.pieces) + 0x110000
        levels = {s: r for r, s in enumerate(sorted({float(model.scores[i]) for i in normal.values()}, reverse=True))}
        rank = {p: levels[float(model.scores[i])] for p, i in normal.items()}
        shared = np.bincount(list(rank.values()), minlength=len(levels)) > 1
        symbol = lambda s: normal[s] if s in normal else self.n_pieces + ord(s) if len(s) == 1 else None
        pairs, bigrams, self.safe = {}, set(), ~shared
        for piece, i in normal.items():
            bigrams.update(zip(piece, piece[1:]))
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = (rank[piece], i)
                for part in (piece[:cut], piece[cut:]):
                    if part in rank and rank[part] >= rank[piece]:
                        self.safe[rank[part]] = False
        codes = sorted(pairs)
        self.codes = np.array([*codes, NONE], np.int64)
        self.ranks = np.array([*(pairs[k][0] for k in codes), NONE], np.int64)
        self.made = np.array([*(pairs[k][1] for k in codes), 0], np.int64)
        self.bigrams = np.array(sorted(ord(a) << 21 | ord(b) for a, b in bigrams), np.int64)
        self.symbols = np.arange(0x110000, dtype=np.int32) + self.n_pieces
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        self.bytes = np.zeros(256, np.int32)
        for i in np.flatnonzero(model.types == BYTE).tolist():
            self.bytes[int(model.pieces[i][3:5], 16)] = i

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; rank NONE if it is no piece."""
        code = left * self.base + right
        at = np.searchsorted(self.codes, code)
        return np.where(self.codes[at] == code, self.ranks[at], NONE), self.made[at]

    def merged(self, points: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words with these code points, and the word of each symbol; ``word`` ascends."""
        if not len(points):
            return np.zeros(0, np.int64), word
        near = points[:-1].astype(np.int64) << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.bigrams, near), len(self.bigrams) - 1)
        new = np.ones(len(points), bool)
        new[1:] = (self.bigrams[at] != near) | (word[1:] != word[:-1])
        segment = np.cumsum(new) - 1
        word_of = word[new]
        done = []
        edges = np.append(np.flatnonzero(new), len(points))
        first = 0
        while first < len(edges) - 1:  # whole segments, about PART symbols of them at once
            end = max(first + 1, int(np.searchsorted(edges, edges[first] + PART, "right")) - 1)
            cut = slice(edges[first], edges[end])
            done += self._rounds(self.symbols[points[cut]].astype(np.int64), segment[cut])
            first = end
        symbols, segments = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(segments, kind="stable")
        return symbols[order], word_of[segments[order]]

    def _rounds(self, symbol: np.ndarray, segment: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        done = []
        rank, made = np.full(len(symbol), NONE), np.zeros(len(symbol), np.int64)
        inner = np.flatnonzero(segment[1:] == segment[:-1])
        rank[inner], made[inner] = self._looked_up(symbol[inner], symbol[inner + 1])
        while len(symbol):
            first = np.append(True, segment[1:] != segment[:-1])
            starts = np.flatnonzero(first)
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(starts, append=len(symbol))
            unsafe = (best != NONE) & ~self.safe[np.where(best == NONE, 0, best)]
            for s in np.flatnonzero(unsafe & (sizes > SHORT)).tolist():
                found = np.array(self._one_by_one(symbol[starts[s] : starts[s] + sizes[s]].tolist()), np.int64)
                done.append((found, np.full(len(found), segment[starts[s]])))
            over = (best == NONE) | unsafe & (sizes > SHORT)
            ended = np.repeat(best == NONE, sizes)
            done.append((symbol[ended], segment[ended]))
            best, unsafe = np.repeat(np.where(over, -1, best), sizes), np.repeat(unsafe, sizes)
            hits = np.flatnonzero(rank == best)
            # in a run of overlapping pairs every other one is merged; an unsafe rank only once per segment
            run = np.append(True, np.diff(hits) != 1)[: len(hits)]
            place = np.arange(len(hits))
            odd = (place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 1
            later = np.append(False, segment[hits[1:]] == segment[hits[:-1]])[: len(hits)]
            hits = hits[~odd & ~(unsafe[hits] & later)]
            symbol[hits] = made[hits]
            stays = best >= 0
            stays[hits + 1] = False
            moved = np.cumsum(stays) - 1
            hits = moved[hits]
            symbol, segment, rank, made = symbol[stays], segment[stays], rank[stays], made[stays]
            rank[hits] = NONE
            rank[hits[hits > 0] - 1] = NONE
            near = np.sort(np.concatenate((hits, hits - 1)))
            near = near[(near >= 0) & (near < len(symbol) - 1)]
            near = near[segment[near] == segment[near + 1]]
            rank[near], made[near] = self._looked_up(symbol[near], symbol[near + 1])
        return done

    def _one_by_one(self, symbols: list[int]) -> list[int]:
        """The merges of one word in the library's order."""
        n = len(symbols)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(lefts: list[int]) -> None:
            rights = [after[i] for i in lefts]
            ranks, made = self._looked_up(np.array([symbols[i] for i in lefts], np.int64), np.array([symbols[i] for i in rights], np.int64))
            for i, j, r, m in zip(lefts, rights, ranks.tolist(), made.tolist()):
                if r != NONE:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[j], m))

        offer(list(range(n - 1)))
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j], after[i] = made, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer([k for k in (before[i], i) if k >= 0 and after[k] < n])
        return [s for s in symbols if s >= 0]

    def spelled(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the symbols, characters without a piece as the ids of their bytes."""
        points = np.maximum(symbols - self.n_pieces, 0)
        lacking = symbols >= self.n_pieces
        sizes = np.where(lacking, 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), 1)
        raw = points[lacking].astype("<u4").tobytes().decode("utf-32-le").encode()
        ids = np.repeat(symbols, sizes)
        ids[np.repeat(lacking, sizes)] = self.bytes[np.frombuffer(raw, np.uint8)]
        return ids.astype(np.int32), np.repeat(word, sizes)


class Decoder:
    """Texts of ids, as the library gives them."""

    def __init__(self, model: Model):
        surfaces = []
        for piece, kind in zip(model.pieces, model.types.tolist()):
            whole = {CONTROL: b"", UNKNOWN: UNKNOWN_TEXT, BYTE: bytes([int(piece[3:5], 16)]) if kind == BYTE else b""}
            surfaces.append(whole[kind] if kind in whole else piece.replace(SPACE, " ").encode())
        self.sizes = np.array([len(s) for s in surfaces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(surfaces), np.uint8)
        self.types = model.types
        self.leading = np.array([k == NORMAL and p.startswith(SPACE) for p, k in zip(model.pieces, model.types.tolist())])

    def surfaces(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids side by side; bytes that are no UTF-8 together become U+FFFD each."""
        sizes = self.sizes[ids]
        total = np.cumsum(sizes)
        data = self.data[np.repeat(self.starts[ids] - (total - sizes), sizes) + np.arange(total[-1] if len(ids) else 0)].tobytes()
        high = (self.types[ids] == BYTE) & (self.data[np.minimum(self.starts[ids], len(self.data) - 1)] >= 0x80)
        if not high.any():
            return data
        runs = np.flatnonzero(np.diff(np.concatenate(([False], high, [False])).astype(np.int8))).reshape(-1, 2)
        ends = np.concatenate(([0], total))[runs]
        out, at = [], 0
        for start, end in ends.tolist():
            out += [data[at:start], _valid(data[start:end])]
            at = end
        return b"".join([*out, data[at:]])

    def parts(self, ids: np.ndarray) -> Iterator[bytes]:
        """The text in UTF-8, in bounded pieces; runs of byte ids are not torn apart."""
        shown = np.flatnonzero(self.types[ids] != CONTROL)
        skip = int(len(shown) > 0 and self.leading[ids[shown[0]]])
        at = 0
        while at < len(ids):
            end = min(at + PART, len(ids))
            while end < len(ids) and self.types[ids[end]] == BYTE:
                end += 1
            part = self.surfaces(ids[at:end])
            at = end
            if skip and part:
                part, skip = part[1:], 0
            yield part

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.parts(ids)).decode()


def _valid(run: bytes) -> bytes:
    try:
        run.decode()
        return run
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for size in range(1, 5):
            try:
                run[at : at + size].decode()
            except UnicodeDecodeError:
                continue
            out.append(run[at : at + size])
            at += size
            break
        else:
            out.append(REPLACEMENT)
            at += 1
    return b"".join(out)


def split(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, each with the dummy prefix, the first byte of each word, and the number of each text's words.

    A word has the spaces that start it; an empty text has none.
    """
    data, offsets = text_buffers([t.replace(SPACE, " ") if SPACE in t else t for t in texts])
    some = np.diff(offsets) > 0
    data = np.insert(data, offsets[:-1][some], 0x20)
    offsets = offsets + np.append(0, np.cumsum(some))
    new = data == 0x20
    new[1:] &= data[:-1] != 0x20
    new[offsets[:-1][some]] = True
    starts = np.flatnonzero(new)
    return data, starts, np.diff(np.searchsorted(starts, offsets))


def portions(text: str, safe: re.Pattern = SAFE_CUT) -> Iterator[str]:
    """A text in parts of about PART characters, cut at safe spaces; these are left out."""
    at = 0
    while len(text) - at > PART and (cut := safe.search(text, at + PART)):
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:] if at else text


class PieceEncoder:
    def __init__(self, path: str):
        self.model = Model(path)
        self.merger, self.decoder = Merger(self.model), Decoder(self.model)
        self.known = Known(np.int32)

    def _learn(self, words: list[bytes]) -> np.ndarray:
        texts = [w.decode() for w in words]
        points = np.frombuffer("".join(texts).replace(" ", SPACE).encode("utf-32-le"), "<u4")
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ids, word = self.merger.spelled(*self.merger.merged(points, np.repeat(np.arange(len(words)), sizes)))
        return self.known.add(words, ids, np.bincount(word, minlength=len(words)))

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the number of each text's ids."""
        self.known.trim(KNOWN_CHARS)
        data, starts, n_words = split(texts)
        piece, words, _ = distinct(data, starts)
        numbers = self.known.find(words)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = self._learn([words[i] for i in new.tolist()])
        ids, sizes = self.known.get(numbers[piece])
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(n_words)]
        return ids, np.diff(ends, prepend=0)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; many short texts, or a part of a long one, at once."""
        some, size = [], 0
        for text in texts:
            if len(text) > PART:
                yield from self._flushed(some)
                some, size = [], 0
                yield np.concatenate([self._encode([p])[0] for p in portions(text)])
                continue
            some.append(text)
            size += len(text)
            if size > PART:
                yield from self._flushed(some)
                some, size = [], 0
        yield from self._flushed(some)

    def _flushed(self, texts: list[str]) -> list[np.ndarray]:
        ids, sizes = self._encode(texts)
        return np.split(ids, np.cumsum(sizes)[:-1]) if texts else []


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder."""
    return c.once(f"pieces {path}", lambda: PieceEncoder(path))


class Decimals:
    """Decimal digits of ids with one separator after each."""

    def __init__(self, n: int):
        width = len(str(n))
        rows = [f"{i},".ljust(width + 1, "\0") for i in range(n)]
        self.digits = np.frombuffer("".join(rows).encode(), np.uint8).reshape(n, width + 1)
        self.shown = self.digits != 0
        self.sizes = self.shown.sum(1)

    def text(self, ids: np.ndarray, separators: np.ndarray | None = None) -> np.ndarray:
        out = self.digits[ids][self.shown[ids]]
        if separators is not None:
            out[np.cumsum(self.sizes[ids]) - 1] = separators
        return out


def decimals(n: int) -> Decimals:
    return c.once(f"decimals {n}", lambda: Decimals(n))


def listed_sha(ids: np.ndarray, table: Decimals) -> str:
    """SHA-256 of the decimal ids joined by commas."""
    h = hashlib.sha256()
    for at in range(0, len(ids), PART):
        text = table.text(ids[at : at + PART])
        h.update(text if at + PART < len(ids) else text[:-1])
    return h.hexdigest()


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _ids(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = list(encoder(path).encode(texts_of(b["text"])))
        offsets = np.cumsum([0, *map(len, ids)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
        yield pa.RecordBatch.from_arrays([b["doc_id"], lists], names=["doc_id", "ids"])


def _texts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [encoder(path).decoder.decode(np.array(x or [], np.int64)) for x in b["ids"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tool = encoder(path)
    table = decimals(tool.merger.n_pieces)
    for b in batches:
        sizes, listed, decoded = [], [], []
        for ids in tool.encode(texts_of(b["text"])):
            sizes.append(len(ids))
            listed.append(listed_sha(ids, table))
            h = hashlib.sha256()
            for part in tool.decoder.parts(ids):
                h.update(part)
            decoded.append(h.hexdigest())
        columns = [b["doc_id"], pa.array(sizes, pa.int64()), pa.array(listed, pa.string()), pa.array(decoded, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


@dataclass(frozen=True)
class PieceTokenizer:
    """``model``: the path of a model file that every worker can open."""

    model: str

    def _rows(self, rows: DataFrame, column: str) -> DataFrame:
        return rows.select(F.col("doc_id").cast("long"), column)

    def encoded(self, docs: DataFrame) -> DataFrame:
        """doc_id and ids of each document."""
        return self._rows(docs, "text").mapInArrow(partial(_ids, path=self.model), "doc_id long, ids array<int>")

    def decoded(self, rows: DataFrame) -> DataFrame:
        """doc_id and text of each row's ids."""
        return self._rows(rows, "ids").mapInArrow(partial(_texts, path=self.model), "doc_id long, text string")

    def digested(self, docs: DataFrame) -> DataFrame:
        """Checksums of each document's ids and of the text that they decode to."""
        schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        return self._rows(docs, "text").mapInArrow(partial(_digests, path=self.model), schema)
