"""Token ids of whole texts by a byte-level BPE of the tokenizers library.

Byte-level BPE never merges across a space that is followed by a non-space, so a text may
be cut there: each piece is encoded once per worker and looked up afterwards. New pieces of
a chunk are encoded together by the library and cut apart by their ids' byte lengths. The
table of known pieces keeps those met again when it reaches its bound.

A text that spells one of the vocabulary's added tokens gets that token's id there, as by the
library's own call, and is encoded whole: spaces beside an added token are no safe cut.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rowsluice.llm import common as c
from rowsluice.llm.words import Known, distinct, text_buffers

CUT = re.compile(r"[ ](?=[^\s\u180e\u200b\ufeff])")
#: White space of the pattern above: ASCII bytes, and the bytes of other characters as one number.
BLANK = np.zeros(256, bool)
BLANK[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
OTHER_BLANK = np.array(
    sorted(
        int.from_bytes(chr(i).encode().ljust(3, b"\0"))
        for i in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)
    )
)
#: Characters given to the library at once (what it returns takes some 100 bytes for each), and kept in all.
TOGETHER, KNOWN_CHARS = 1 << 17, 10_000_000
END = 2


def safe_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of the spaces of all texts that ``CUT`` finds."""
    space = data == 0x20
    space[offsets[1:][offsets[1:] > 0] - 1] = False  # a space that ends a text
    at = np.flatnonzero(space)
    after = data[at + 1]
    safe = ~BLANK[after]
    wide = np.flatnonzero(after >= 0xC2)
    if len(wide):
        first, last = at[wide] + 1, len(data) - 1
        code = after[wide].astype(np.int64) << 16 | data[first + 1].astype(np.int64) << 8
        code |= np.where(after[wide] >= 0xE0, data[np.minimum(first + 2, last)], 0)
        safe[wide] = ~np.isin(code, OTHER_BLANK)
    return at[safe]


class Encoder:
    """``as_text``: added tokens spelled in a text are encoded as ordinary text."""

    def __init__(self, path: str, as_text: bool = True, known_chars: int = KNOWN_CHARS):
        self.known_chars = known_chars
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.added = [] if as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self.known = Known(np.uint32)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        """The library's ids; this call of it leaves out offsets."""
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Numbers of new pieces that start with their space, many encoded in one call."""
        ends, done, numbers = np.cumsum(sizes), 0, []
        at = 0
        while at < len(pieces):
            end = max(at + 1, int(np.searchsorted(ends, done + TOGETHER, "right")))
            ids = self._library([b"".join(pieces[at:end]).decode()])[0]
            counts = np.searchsorted(np.cumsum(self.bytes[ids]), ends[at:end] - done, "right")
            numbers.append(self.known.add(pieces[at:end], ids, np.diff(counts, prepend=0)))
            at, done = end, ends[end - 1]
        return np.concatenate(numbers)

    def _learn_heads(self, heads: list[bytes], whole: bool) -> np.ndarray:
        """Numbers of new pieces that start a text, or are ``whole`` texts with added tokens."""
        self.tokenizer.encode_special_tokens = not whole
        ids = self._library([h.decode() for h in heads])
        self.tokenizer.encode_special_tokens = True
        return self.known.add(heads, np.concatenate(ids), np.array([len(x) for x in ids]))

    def looked_up(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a buffer and the number of each text's ids."""
        self.known.trim(self.known_chars)
        n = len(offsets) - 1
        whole = np.zeros(n, bool)
        if self.added:
            texts = pa.Array.from_buffers(
                pa.large_binary(), n, [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(np.ascontiguousarray(data))]
            )
            for token in self.added:
                whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        cuts = safe_cuts(data, offsets)
        if whole.any():
            cuts = cuts[~whole[np.searchsorted(offsets, cuts, "right") - 1]]
        per_text = 1 + np.diff(np.searchsorted(cuts, offsets))
        heads = np.cumsum(per_text) - per_text
        starts = np.sort(np.concatenate((offsets[:-1], cuts)), kind="stable")
        piece, words, sizes = distinct(data, starts)
        numbers = self.known.find(words)
        new = numbers < 0
        if new.any():
            kind = np.zeros(len(words), np.int8)  # a piece that starts a text is none that follows its space
            kind[piece[heads]] = 1
            kind[piece[heads[whole]]] = 2
            for k in range(3):
                if len(some := np.flatnonzero(new & (kind == k))):
                    pieces = [words[i] for i in some.tolist()]
                    numbers[some] = self._learn_heads(pieces, k == 2) if k else self._learn(pieces, sizes[some])
        ids, counts = self.known.get(numbers[piece])
        return ids, np.add.reduceat(counts, heads) if n else counts

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the number of each text's ids."""
        return self.looked_up(*text_buffers(texts))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the number of each text's ids, with the end id after each text."""
        return self.ended(*text_buffers(texts))

    def ended(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, for the texts of a buffer."""
        ids, counts = self.looked_up(data, offsets)
        out = np.full(len(ids) + len(counts), END, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
        return out, counts + 1


def encoder(path: str, known_chars: int = KNOWN_CHARS) -> Encoder:
    """This worker's encoder, with the ids of the library's default call."""
    return c.once(f"encoder {path} {known_chars}", lambda: Encoder(path, as_text=False, known_chars=known_chars))


def encoded(column, path: str, known_chars: int = KNOWN_CHARS):
    """(first row, end row, ids, ids per row) of pieces of an Arrow column of texts."""
    for first, end, data, offsets in c.chunks(column):
        yield first, end, *encoder(path, known_chars).ended(data, offsets)
