"""Searches against brute force: recall on random and clustered vectors, exact scores, ties and odd rows."""

import numpy as np

from kiln.llm import ann


def brute(ids, x, k=5):
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[i]
        s[i] = -9
        best = np.lexsort((ids, -s.round(12)))[:k]
        out[int(ids[i])] = [int(ids[j]) for j in best]
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r.vec_id)
    return np.mean([len(set(found.get(q, [])) & set(w)) / len(w) for q, w in want.items()])


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    p = df.toPandas()
    want = brute(p.vec_id.to_numpy(), np.stack(p.embedding.to_list()).astype(float))
    got = ann.op10_ann(spark, "/root/testdata/sf0.1").collect()
    assert recall(got, want) >= 0.9 and len(got) == 5 * len(want)
    x = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    for r in got[:200]:
        a, b = x[r.query_id], x[r.vec_id]
        assert abs(r.score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
    assert all(1 <= r["rank"] <= 5 for r in got)


def test_hot_vector_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "ASKERS", 4)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16))
    x[300:1000] = x[300]
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(ann.usable(df), ann.usable(df).where("vec_id % 50 = 0")).collect()
    want = brute(np.arange(1500), x)
    assert recall(got, want) >= 0.9
    hot = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (350, 900)}
    assert hot == {q: want[q] for q in (350, 900)}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (50, [2.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, list string")
    v = ann.usable(df)
    got = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 9)) for r in ann.search(v, v.where("vec_id % 50 = 0")).collect()}
    half = round(2**-0.5, 9)
    assert got == {(0, 1): (50, 1.0), (0, 2): (1, half), (50, 1): (0, 1.0), (50, 2): (1, half)}
    e = ann.usable(df.limit(0))
    assert ann.search(e, e).count() == 0


def test_recall_beyond_the_sample(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 1000)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 24))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(ann.usable(df), ann.usable(df).where("vec_id % 50 = 0")).collect()
    assert recall(got, brute(np.arange(6000), x)) >= 0.9 and len(got) == 5 * 120
