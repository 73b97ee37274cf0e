"""Spelling variants against brute force; signatures that miss no edit."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kiln.llm import spelling
from kiln.llm.spelling import count_words, dimensions, op13_spelling_variants, part_enum, signatures, spelling_groups


def edits(word, alphabet):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in alphabet}
    return out - {word}


def plain(rows, min_chars=5, min_count=3):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_chars and c >= min_count}
    alphabet = {c for w in n for c in w}
    near = {w: [x for x in edits(w, alphabet) if x in n] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def corpus(seed=1):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcéÿ") for _ in range(rng.randrange(4, 9))) for _ in range(40)] + ["Straße", "naïveté", "a×b÷cd", "elephant"]
    words = base + [rng.choice(sorted(edits(w, "abÉé"))) for w in base for _ in range(6)]
    rows = [(i, rng.choice((" ", ", ", "1", "_")).join(words[min(int(rng.expovariate(0.02)), len(words) - 1)] for _ in range(rng.randrange(1, 60)))) for i in range(200)]
    return [*rows, (None, rows[0][1]), rows[1], rows[1], (900, None), (901, ""), (902, "12 -- 34"), (903, "elephant " * 40_000), (904, "q" * 5000 + " " + "q" * 5001), (905, "q" * 5000), (906, ("q" * 5000 + " " + "q" * 5001 + " ") * 3)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_against_brute_force(spark, monkeypatch):
    rows = corpus()
    want = plain(rows)
    got = sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in spelling_groups(frame(spark, rows)).collect()), key=repr)
    assert got == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1])
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    few = {r.word: r.n for r in count_words(frame(spark, rows), 3, 1).collect()}
    assert few == {r[0]: r[3] for r in plain(rows, 3, 1)}


def test_chain_of_forms_and_ties(spark):
    words = {"abcde": 1000, "abcdef": 200, "abcdeg": 200, "abcdefg": 50, "abcdefgh": 9, "zzzzz": 4, "zzzzy": 4}
    rows = [(i, " ".join([w] * c)) for i, (w, c) in enumerate(words.items())]
    got = {r.word: r for r in spelling_groups(frame(spark, rows)).collect()}
    want = {r[0]: r for r in plain(rows)}
    assert {w: (r.form, r.root, r.n_near) for w, r in got.items()} == {w: (r[1], r[2], r[4]) for w, r in want.items()}
    assert got["abcdefg"].form == "abcdef" and got["abcdefgh"].root == "abcde" and got["zzzzz"].form is None


def test_empty_and_further_columns(spark):
    assert spelling_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "word1", "hello hello hello", 1)], "doc_id int, word string, text string, n int")
    assert [tuple(r) for r in spelling_groups(df).collect()] == [("hello", None, "hello", 3, 0, None)]


def test_query_over_a_folder(spark, tmp_path):
    rows = corpus(6)
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, op13_spelling_variants(spark, str(tmp_path)).collect()), key=repr) == plain(rows)


@settings(max_examples=300, deadline=None)
@given(st.text("abcé", min_size=1, max_size=12), st.integers(0, 12), st.sampled_from("abcéz"), st.sampled_from(["insert", "replace"]))
def test_one_edit_shares_a_signature(word, at, c, how):
    at = min(at, len(word) - (how == "replace"))
    other = word[:at] + c + word[at + (how == "replace") :]
    mine, theirs = set(signatures(word)), set(signatures(other))
    if how == "replace":
        assert {s for r, s in mine if r == 0} & {s for r, s in theirs if r == 0}
    else:
        assert {s for r, s in mine if r == 2} & {s for r, s in theirs if r == 1}


@pytest.mark.parametrize(("k", "n1", "parts"), [(2, 1, 4), (1, 1, 3), (2, 2, 3), (5, 3, 4)])
def test_part_enum(k, n1, parts):
    rng = random.Random(0)
    for _ in range(200):
        a = {f"d{rng.randrange(40)}" for _ in range(20)}
        b = set(a)
        for d in rng.sample(range(40), k):
            b ^= {f"d{d}"}
        assert set(part_enum(sorted(a), k, n1, parts)) & set(part_enum(sorted(b), k, n1, parts))


def test_dimensions():
    assert dimensions("banana") == ["a0", "a1", "a2", "b0", "n0", "n1"]
