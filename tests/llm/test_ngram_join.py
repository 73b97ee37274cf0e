"""Classes against all pairs by brute force, on near copies, short texts and shared passages."""

import random

import pytest

from kiln.llm import ngram_join as nj


def brute(rows, k, num, den):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)}


def corpus(seed, copies=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage = text(40)
    out = [text(rng.randrange(1, 60)) for _ in range(60)]
    out += [passage + text(rng.randrange(5, 60)) for _ in range(30)]
    for base in (text(12), text(22), text(90), text(160), text(25)):
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                i = rng.randrange(len(w))
                w[i : i + rng.randrange(2)] = [rng.choice(vocab)] * rng.randrange(2)
            out.append(w)
    rows = [" ".join(w) for w in out] + ["", None, "Ab cD", "aB CD", " \t", "é x\x1cy z"]
    rng.shuffle(rows)
    return [(i * 2, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("seed", "k", "num"), [(1, 3, 90), (2, 5, 80), (3, 2, 70)])
def test_classes(spark, seed, k, num):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, node string, n int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_classes(df, k, num, 100).collect()}
    assert got == brute(rows, k, num, 100)


def test_repeated_rows_nulls_and_empty(spark):
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "only null ids here"), (3, "a b c d"), (9, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.first) for r in nj.ngram_classes(df, 3, 90, 100).collect()), key=repr)
    assert got == sorted([(5, 3, False), (5, 3, False), (None, 3, False), (None, None, True), (3, 3, True), (9, 9, True)], key=repr)
    assert nj.ngram_classes(df.limit(0)).count() == 0


def test_boundary():
    assert nj.boundary(90, 100) == 19 and nj.boundary(80, 100) == 9


def test_long_text_in_parts(monkeypatch):
    text = "The quick  brown\tfox jumps " * 50
    whole = nj.shingle_sets([text, "a b"], 3)
    monkeypatch.setattr(nj, "SLICE", 64)
    monkeypatch.setattr(nj, "segments", lambda t: __import__("kiln.llm.arrow", fromlist=["segments"]).segments(t, 64))
    for a, b in zip(whole, nj.shingle_sets([text, "a b"], 3), strict=True):
        assert (a == b).all()
