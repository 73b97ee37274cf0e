"""Encoding and decoding against the tokenizers library, on chosen and random texts."""

import hashlib
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kiln.llm import bpe

LIB = Tokenizer.from_file(bpe.default_path())
OWN = bpe.SegmentTreeBPE(bpe.default_path())
TEXTS = ["", "   ", "Hello, world", "I'm don't WE'LL 12345", "café café Ærø ΣΣΣ İ", "<|startoftext|>x<|endoftext|> <|endof", "你好 \U0001f600\U0001f600", "a" * 3000, "x y z\x1cq\x85w", "՘a Ɤ", "!!! ... ((éé", "the quick brown fox " * 50]


def expect(text):
    return LIB.encode(text, add_special_tokens=False).ids


def test_chosen_texts():
    for text, got in zip(TEXTS, OWN.encode(TEXTS), strict=True):
        ids = np.frombuffer(got, "<u4").tolist()
        assert ids == expect(text), text
        assert OWN.decode(got) == LIB.decode(ids, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert np.frombuffer(OWN.encode([text])[0], "<u4").tolist() == expect(text)


def test_query_rows(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(99, None, None), (99, None, None)], "doc_id long, text string, ids0 string")
    rows = {r.doc_id: r for r in bpe.decode(bpe.encode(df, ["doc_id"]), ["doc_id", "ids"]).collect()}
    assert rows == {r.doc_id: r for r in bpe.round_trip(df, ["doc_id"]).collect()}
    assert rows[99].ids == b"" and rows[99].decoded == ""
    for i, t in enumerate(TEXTS):
        assert hashlib.sha256(rows[i].ids).digest() == hashlib.sha256(np.array(expect(t), "<u4").tobytes()).digest()
    assert bpe.encode(df.limit(0), ["doc_id"]).count() == 0


def test_long_pieces():
    rng = np.random.default_rng(1)
    letters = "".join(map(chr, rng.integers(97, 107, 100_000)))
    began = time.time()
    for text in ("a" * 200_000, letters, "=" * 20_000, "xy " + "b" * 17):
        assert np.frombuffer(OWN.encode([text])[0], "<u4").tolist() == expect(text)
    assert time.time() - began < 60


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 20_000)
    own = bpe.SegmentTreeBPE(bpe.default_path())
    for k in range(30):
        text = " ".join(f"w{i}x" for i in range(100 * k, 100 * k + 100))
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == expect(text)
        assert own.words.held <= 20_000 and own.pieces.held <= 20_000
