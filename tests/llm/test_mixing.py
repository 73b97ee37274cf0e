"""Targets against the rounds of sharing that define them, and the rows taken against a plain greedy mix."""

import math
import random

import pytest

from kiln.llm import mixing


def rounds(sizes, weights=(1, 2, 3)):
    """Share by weight, stop at three times a source's size, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / total for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not over or over | full == set(order):
            return target
        full |= over


def test_targets(spark):
    rng = random.Random(2)
    for n in (1, 2, 5, 9):
        for scale in (1, 6):
            sizes = {f"s{i:02d}" if i else None: int(math.exp(rng.random() * scale) * 10) for i in range(n)}
            df = spark.createDataFrame([(s, z, 1) for s, z in sizes.items()], "src string, source_size long, n_rows long")
            got = {r.src: r.target for r in mixing.source_targets(df).collect()}
            want = rounds(sizes)
            assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in sizes), (sizes, got, want)


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_A_RANGE", 5)
    rng = random.Random(8)
    rows = [(i, " ".join(["w%d" % rng.randrange(9)] * rng.randrange(0, 30)), "abc"[min(2, i // 90)] if i % 17 else None, i) for i in range(200)]
    rows += [rows[5], rows[5], (None, None, "a", 1), (900, "x y", "tiny", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    got = mixing.mix(df.repartition(3)).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(rows, key=repr)
    sizes = {}
    for r in got:
        assert r.mix_size == len((r.text or "").split()) and 0 <= r.mix_repeats <= 3
        sizes[r.source] = sizes.get(r.source, 0) + r.mix_size
    want = rounds(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert abs(own[0].mix_target - want[s]) < 1e-6 and {r.mix_source_size for r in own} == {sizes[s]}
        taken = sum(r.mix_size * r.mix_repeats for r in own)
        assert abs(taken - want[s]) <= 3 * max(r.mix_size for r in own) / 2 + 1
        assert max(r.mix_repeats for r in own) - min(r.mix_repeats for r in own) <= 1  # complete epochs first
    assert mixing.mix(df.limit(0)).count() == 0


def test_clashing_names_raise(spark):
    df = spark.createDataFrame([(1, "a b", "s", 3)], "doc_id long, text string, source string, Mix_Size long")
    with pytest.raises(ValueError, match="Mix_Size"):
        mixing.mix(df)
    from kiln.llm import bpe, secrets

    with pytest.raises(ValueError, match="n_live"):
        secrets.scan(df.withColumnRenamed("Mix_Size", "n_live"))
    with pytest.raises(ValueError, match="decoded"):
        bpe.decode(df.selectExpr("cast(text as binary) as ids", "doc_id as decoded"), ["decoded"])


def test_long_texts_and_an_empty_table(spark, tmp_path):
    long = "word " * 200_000
    df = spark.createDataFrame([(1, long, "a"), (2, "x", "a"), (3, "y z", "b")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(df).collect()}
    assert got[1].mix_size == 200_000 and got[1].mix_source_size == 200_001
    df.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert mixing.op5_mix_sources(spark, str(tmp_path)).collect() == []
