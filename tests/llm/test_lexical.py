"""Ranked search against scoring every document, over blocks, groups of items and ties."""

import math
import random
import re

import numpy as np
import pytest

from kiln.llm import lexical
from kiln.llm.lexical import Block, op12_lexical_search, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    found = [(d, terms(t)) for d, t in docs]
    n_docs, total = sum(1 for _, t in found if t), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        asked = {t for t in terms(text) if t in df}
        rows = []
        for doc, t in found:
            m = 10 + (90 * len(t) * n_docs) // total if t else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10**9 * t.count(x)) // (1000 * t.count(x) + 8 * m)) for x in asked if x in t)
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(rows, key=lambda r: r[:3])[:k])]
    return sorted(out, key=repr)


def corpus(seed=2, n=300):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)] + ["été", "日本", "straße", "É"]
    pick = lambda: vocab[min(int(rng.expovariate(0.03)), len(vocab) - 1)]
    docs = [(i, rng.choice((" ", "-", "\n", "_")).join(pick() for _ in range(rng.randrange(1, 60)))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)] + [(None, docs[7][1]), docs[8], docs[8], (2000, None), (2001, ""), (2002, "--- !!"), (2003, "w1 " * 30_000), (-4, "W1 w2 w3")]
    items = [(i, " ".join(pick() for _ in range(rng.randrange(1, 25)))) for i in range(25)] + [(90, docs[7][1]), (91, docs[7][1]), (91, "w1"), (92, ""), (93, None), (None, "w2 w2 w5"), (94, "absent"), (95, "w0 w1 w2 w3 w4")]
    return docs, items


def result(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize(("block", "short", "group"), [(4096, 0.25, 10_000), (50, 0.25, 10_000), (50, 0.0, 10_000), (300, 100.0, 7), (64, 2.0, 10_000)])
def test_against_every_score(spark, monkeypatch, block, short, group):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "SHORT", short)
    monkeypatch.setattr(lexical, "GROUP_ITEMS", group)
    monkeypatch.setattr("kiln.llm.arrow.SLICE", 2000)
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = search(d, spark.createDataFrame(items, "item_id long, text string"))
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert result(got) == plain(docs, items)


def test_skipping_loses_nothing(monkeypatch):
    rng = np.random.default_rng(4)
    size, n_terms = 5000, 12
    lists = [np.flatnonzero(rng.random(size) < p) for p in [0.002, 0.01, 0.05] + [0.3, 0.5, 0.8] * 3]
    doc, term = np.concatenate(lists), np.repeat(np.arange(n_terms), [len(x) for x in lists])
    tf = rng.geometric(0.5, len(doc)).astype(np.int64)
    m = rng.integers(20, 400, size)
    weight = rng.integers(0, 9000, n_terms)
    gain = (10**9 * tf) // (1000 * tf + 8 * m[doc])
    score = np.zeros(size, np.int64)
    np.add.at(score, doc, weight[term] * gain)
    order = rng.permutation(len(doc))
    block = Block(n_terms, m, doc[order], term[order], tf[order])
    walked = []
    walk = Block._walk
    monkeypatch.setattr(Block, "_walk", lambda self, ranges, *a: walked.append(len(ranges)) or walk(self, ranges, *a))
    for least in (1, int(np.sort(score)[-10]), int(score.max()), int(score.max()) + 1):
        at, got = block.search(np.arange(n_terms), weight, 10, least)
        assert set(at) == set(np.flatnonzero(score >= max(least, int(np.sort(score)[-10])))) and (got == score[at]).all()
    assert 0 < sum(walked) < 4 * len(block.cuts)


def test_empty_tables_and_names(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert search(docs, items).collect() == [] and search(spark.createDataFrame([(1, "a b")], docs.schema), items.limit(0)).collect() == []
    assert search(spark.createDataFrame([(1, "..")], docs.schema), items).collect() == []
    odd = spark.createDataFrame([(5, "alpha beta", 1, 2.0)], "id long, body string, score int, item double")
    got = search(odd, spark.createDataFrame([("q", "BETA", 3)], "name string, words string, doc_id int"), 1, "id", "body", "name", "words")
    assert [tuple(r) for r in got.collect()] == [("q", 1, 5, plain([(5, "alpha beta")], [("q", "BETA")])[0][3])]


def test_query_over_a_folder(spark, tmp_path):
    docs, items = corpus(9, 80)
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert result(op12_lexical_search(spark, str(tmp_path))) == plain(docs, items)
