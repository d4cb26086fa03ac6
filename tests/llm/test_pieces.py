"""SentencePiece merge rounds against the library."""

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st

from rowsluice.llm.pieces import Merger, PieceEncoder, PieceTokenizer, portions
from rowsluice.llm import pieces as module

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TOOL = PieceEncoder(PATH)
SCHEMA = "doc_id long, text string, ids array<int>, n_tokens long, part string"
TEXTS = [
    "", " ", "  ", "   a", "a ", "a  b   c", "▁x ▁ y▁▁", "<s>hi</s> <unk> <0x41>", "a\x00b\n\tc\r\n", "é é́ ﬁ　b﻿a", "😀👩‍👩‍👧 ▅▅", "\n \n  \n",
    "x" * 5000, "ab" * 3000, "aaab" * 999, " " * 700, "\t" * 90, "a" + " " * 77 + "b", "漢字" * 300, "русский текст " * 20, "=" * 1000 + "-" * 1000,
    "AbCdEf0123456789+/" * 60, "the the the quick brown fox", "ᚠ" * 9 + "\U0010ffff",
]


def noise(seed, n):
    r = random.Random(seed)
    pool = [p.replace("▁", " ") for p in TOOL.model.pieces[259:]]
    return "".join(r.choice(pool) if r.random() < 0.7 else chr(r.choice([r.randrange(32, 127), r.randrange(1, 0xD800), r.randrange(0xE000, 0x110000)])) for _ in range(n))


def agrees(text):
    want = LIBRARY.encode(text)
    (ids,) = TOOL.encode([text])
    assert ids.tolist() == want, repr(text)[:200]
    assert TOOL.decoder.decode(ids) == LIBRARY.decode(want), repr(text)[:200]


@pytest.mark.parametrize("text", TEXTS, ids=range(len(TEXTS)))
def test_texts(text):
    agrees(text)


def test_noise_without_words_and_with_few_letters():
    for seed in range(150):
        agrees(noise(seed, 1 + seed * 3))
    r = random.Random(1)
    for letters in ("ab", " a", "in ", "erns", "=- ", "▁ s", "the"):
        for n in (3, 10, 40, 300):
            agrees("".join(r.choice(letters) for _ in range(n)))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    agrees(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 300), st.sampled_from([0, 1, 2, 229, 153, 136, 259, 28705])), max_size=12))
def test_any_ids_decode(ids):
    assert TOOL.decoder.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


def test_documents_and_small_bounds(monkeypatch):
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()]
    for text, ids in zip(texts, TOOL.encode(texts)):
        assert ids.tolist() == LIBRARY.encode(text)
    monkeypatch.setattr(module, "PART", 50)  # portions, flat arrays and decoded parts
    monkeypatch.setattr(module, "SHORT", 3)
    monkeypatch.setattr(module, "KNOWN_CHARS", 200)
    for text in [*TEXTS, *texts[:60], noise(5, 400)]:
        agrees(text)
    assert " ".join(portions("ab cd " * 40)) == "ab cd " * 40


def test_unsafe_pieces_are_told_apart():
    merger = Merger(TOOL.model)
    assert 0 < (~merger.safe).sum() < len(merger.safe)


def test_query_cases(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "twice"), (3, "twice"), (90, None), (91, noise(9, 20_000))]
    docs = spark.createDataFrame([(i, t, [1], 5, "p") for i, t in rows], SCHEMA).repartition(3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(i, len(ids := LIBRARY.encode(t or "")), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))) for i, t in rows]
    tool = PieceTokenizer(PATH)
    got = tool.digested(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert tool.digested(docs.limit(0)).collect() == []
    back = tool.decoded(tool.encoded(docs))
    assert sorted(map(tuple, back.collect()), key=key) == sorted(((i, LIBRARY.decode(LIBRARY.encode(t or ""))) for i, t in rows), key=key)
    assert tool.decoded(tool.encoded(docs.limit(0))).collect() == []
