"""Alignment of two tokenizers against a plain version with both libraries."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import public_tokenizers
import sentencepiece
from brute import alignment
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rowsluice.llm import align as module
from rowsluice.llm.align import ALIGNED, TokenAligner, byte_alphabet, cuts

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
A.encode_special_tokens = True
SCHEMA = "doc_id long, text string, unit long, codes array<long>, n_a int, looked string, n int"


def encode_a(text):
    alphabet = byte_alphabet()
    found = A.encode(" " + text, add_special_tokens=False)
    return [(i, bytes(alphabet[ch] for ch in A.id_to_token(i))) for i in found.ids]


def encode_b(text):
    return [(i, bytes([i - 3]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]


def corpus():
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()][:80]
    texts += ["", None, " ", "a", "with ▁ in it", "a<|endoftext|>b <s> </s>", "x" * 300, "ab" * 150, "漢字 " * 30, "😀👩‍👩‍👧 ▅▅", "\n\n \t a  b   c ", "\x00\x01", "ꙮ" * 40, "tie tie tie"]
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (5, texts[5]), (5, texts[5])]


@pytest.fixture(scope="module")
def want():
    return sorted(alignment(corpus(), encode_a, encode_b), key=str)


@pytest.mark.parametrize("unit, pairs, step", [(8 << 20, 1 << 20, 1 << 19), (3000, 7, 2000)])
def test_documents(spark, want, unit, pairs, step, monkeypatch):
    # read again by the workers, as modules of this package travel by value
    monkeypatch.setattr(module, "UNIT", unit)
    monkeypatch.setattr(module, "PAIRS", pairs)
    monkeypatch.setattr(module, "STEP", step)
    docs = spark.createDataFrame([(i, t, 1, [2], 3, "x", 4) for i, t in corpus()], SCHEMA).repartition(3)
    tool = TokenAligner(PATH_A, PATH_B)
    got = tool.aligned(docs)
    assert got.columns == [f.split()[0] for f in ALIGNED.split(", ")]
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert tool.aligned(docs.limit(0)).collect() == []


def test_translations(spark):
    rows = [(1, "the cat"), (2, "the dog"), (3, "the the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["a"], r["b"]): (r["n_docs"], r["best"]) for r in TokenAligner(PATH_A, PATH_B).translations(docs).collect()}
    the = (A.encode(" the", add_special_tokens=False).ids[0], B.encode("the")[0])
    assert got[the] == (3, True) and len(got) == 3


def test_long_texts_in_parts(monkeypatch):
    tool = module.Aligner(PATH_A, PATH_B)
    text = corpus()[2][1] + "  x\n y " + corpus()[3][1]
    want = tool.aligned([text])
    monkeypatch.setattr("rowsluice.llm.pieces.PART", 40)
    monkeypatch.setattr(module, "PART", 40)
    tool.a.tool.known_chars = 100
    got = tool.aligned([text])
    assert got["digests"] == want["digests"] and np.array_equal(got["pairs"], want["pairs"]) and np.array_equal(got["times"], want["times"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 59)), st.sets(st.integers(1, 59))), min_size=1, max_size=4))
def test_cuts(docs):
    a, b, edges = [], [], [0]
    for x, y in docs:
        a += [edges[-1] + e for e in sorted(x | {60})]
        b += [edges[-1] + e for e in sorted(y | {60})]
        edges.append(edges[-1] + 60)
    assert cuts(np.array(a), np.array(b), np.array(edges)).tolist() == sorted(set(a) & set(b))


def test_large_group_without_cuts():
    r = random.Random(1)
    n = 1 << 16
    a = sorted({*(2 * r.randrange(n) for _ in range(n)), 2 * n})
    b = sorted({*(2 * r.randrange(n) + 1 for _ in range(n)), 2 * n})
    assert cuts(np.array([e for e in a if e]), np.array(b), np.array([0, 2 * n])).tolist() == [2 * n]
