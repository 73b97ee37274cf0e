"""Token files: code properties, exact round trips, and rows against the tokenizers library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kiln.llm import bpe
from kiln.llm import token_files as tf


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=40), st.integers(6, 12))
def test_code_is_complete_and_limited(counts, limit):
    lengths = tf.code_lengths(np.array(counts), limit)
    used = np.array(counts) > 0
    assert ((lengths > 0) == used).all() and lengths.max(initial=0) <= limit
    if used.sum() > 1:
        assert sum(2.0 ** -int(x) for x in lengths[used]) == 1
    if used.any():
        ids = np.repeat(np.flatnonzero(used), 7)[: 3 * tf.BLOCK + 5]
        payload, offsets = (code := tf.Code(lengths)).encode(ids)
        assert (code.decode(payload, offsets, len(ids)) == ids).all()


def test_lengths_are_optimal_without_limit():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21])
    assert (tf.code_lengths(counts, 16) * counts).sum() == 132  # the sum of the inner nodes of the Huffman tree


def test_cut_file_is_refused():
    data = tf.pack(tf.Code(tf.code_lengths(np.array([3, 2, 1]), 4)), [7, None], [np.array([0, 1]), np.array([2])])
    docs, counts, ids = tf.unpack(data)
    assert docs == [7, None] and counts.tolist() == [2, 1] and ids.tolist() == [0, 1, 2]
    with pytest.raises(ValueError):
        tf.unpack(data[:-1])


def test_rows(spark):
    texts = ["one two", "", None, "three " * 500, "one two", "<|endoftext|> x", "é"]
    df = spark.createDataFrame([(10 - i, t, 1) for i, t in enumerate(texts)] + [(None, "no id", 1), (10, "one two", 2)], "doc_id long, text string, ids int")
    lib = Tokenizer.from_file(bpe.default_path())
    expected, start = [], 0
    for doc, t in sorted([(10 - i, t) for i, t in enumerate(texts)] + [(-1, "no id"), (10, "one two")], key=lambda x: x[0]):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((None if doc < 0 else doc, start, zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [(r.doc_id, r.start, zlib.crc32(r.ids)) for r in tf.read_files(tf.write_corpus(df.repartition(3))).collect()]
    assert sorted(got, key=lambda x: x[1]) == expected
    assert tf.read_files(tf.write_corpus(df.limit(0))).count() == 0


LIB = Tokenizer.from_file(bpe.default_path())
OWN = tf.LibraryIds(bpe.default_path(), "<u2")


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_has_the_ids_of_the_library(text):
    assert np.frombuffer(OWN.encode([text])[0], "<u2").tolist() == LIB.encode(text, add_special_tokens=False).ids


def test_one_id_on_many_rows(spark, monkeypatch):
    monkeypatch.setattr(tf, "FILE_TOKENS", 50)
    monkeypatch.setattr(tf, "PART_TOKENS", 100)
    df = spark.createDataFrame([(7, f"word{i} again") for i in range(200)], "doc_id long, text string")
    files = tf.write_corpus(df)
    assert files.select("part").distinct().count() > 4
    rows = sorted((r.start, len(r.ids) // 4) for r in tf.read_files(files).collect())
    assert len(rows) == 200 and all(a + n == b for (a, n), (b, _) in zip(rows, rows[1:]))
