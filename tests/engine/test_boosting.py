"""Symmetric trees against brute force, both ways of fitting, ordered category codes."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.functions import metrics
from kiln.functions.columns import order_hash
from kiln.functions.encoders import ordered_target
from kiln.operators import boosting, evaluate
from kiln.operators.boosting import BoostParams, Tree, fit, fit_rows, margins


def plain_tree(codes, y, weight, margin, depth, l2, rate, bins):
    """One symmetric tree by trying every question on every row."""
    g = [w * (t - 1 / (1 + math.exp(-m))) for w, t, m in zip(weight, y, margin, strict=True)]
    h = [w / (1 + math.exp(-m)) * (1 - 1 / (1 + math.exp(-m))) for w, m in zip(weight, margin, strict=True)]
    nodes, splits = [list(range(len(y)))], []
    quality = lambda rows: sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + l2)
    for _ in range(depth):
        best = None
        for f in range(len(codes[0])):
            for b in range(bins - 1):
                halves = [[i for i in n if codes[i][f] <= b] for n in nodes], [[i for i in n if codes[i][f] > b] for n in nodes]
                gain = sum(quality(x) for part in halves for x in part) - sum(quality(n) for n in nodes)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-6):
                    best = (gain, f, b, halves)
        if best is None:
            break
        splits.append(best[1:3])
        nodes = [x for pair in zip(*best[3], strict=True) for x in pair]
    return splits, [rate * sum(g[i] for i in n) / (sum(h[i] for i in n) + l2) for n in nodes]


@pytest.mark.parametrize("l2", [0.5, 3.0])
def test_trees_against_brute_force(l2):
    rng = random.Random(1)
    codes = [[rng.randrange(6), rng.randrange(6), rng.randrange(2)] for _ in range(120)]
    y = [int(a + 2 * (b > 3) + rng.gauss(0, 1) > 4) for a, b, _ in codes]
    weight = [1.0 if t else 2.5 for t in y]
    params = BoostParams(rounds=3, rate=0.3, depth=3, l2=l2, bins=6)
    trees = fit_rows(np.array(codes), np.array(y, float), np.array(weight), params)
    margin = [0.0] * len(y)
    for tree in trees:
        splits, values = plain_tree(codes, y, weight, margin, 3, l2, 0.3, 6)
        assert tree.splits == splits and np.allclose(tree.values, values, atol=1e-5)
        leaf = tree.leaves(np.array(codes))
        margin = [m + tree.values[k] for m, k in zip(margin, leaf, strict=True)]
    assert np.allclose(margin, margins(trees, np.array(codes)))


def sample(spark, n=900, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        shop, a, b = rng.choice("pqrst") if rng.random() > 0.1 else None, rng.gauss(0, 1), rng.random()
        p = 1 / (1 + math.exp(-(1.5 * a + (shop in ("p", "q")) * 2 - 1)))
        rows.append((i, int(rng.random() < p), a, b, shop, str(i)))
    return spark.createDataFrame(rows, "id long, y int, a double, b double, shop string, own string").repartition(5)


def test_both_ways_give_the_same_trees(spark):
    rows = metrics.stratified_folds(sample(spark, 300).fillna("none"), "id", "y", 3)
    few = dict(rounds=3, depth=2, bins=16, refresh=2)
    near, held = fit(rows, "id", ["a", "b", "shop"], "y", "fold", 3, BoostParams(**few))
    far, held2 = fit(rows.repartition(7, "b"), "id", ["a", "b", "shop"], "y", "fold", 3, BoostParams(**few, local_rows=0))
    assert len(near.models) == 4
    for a, b in zip(near.models, far.models, strict=True):
        assert [t.splits for t in a] == [t.splits for t in b] and all(np.array_equal(s.values, t.values) for s, t in zip(a, b, strict=True))
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, held2.collect()))


def test_full_rounds_rank_well_and_categories_help(spark):
    df = sample(spark)
    scores = {k: [r.auc for r in evaluate.cv_scores(df, "id", f, "y").collect()] for k, f in {"both": ["a", "b", "shop"], "numbers": ["a", "b"], "noise": ["b"], "own": ["own"]}.items()}
    mean = {k: sum(v) / len(v) for k, v in scores.items()}
    assert all(len(v) == 5 for v in scores.values())
    assert mean["both"] > 0.8 and mean["both"] > mean["numbers"] + 0.03
    assert abs(mean["noise"] - 0.5) < 0.07 and abs(mean["own"] - 0.5) < 0.07  # a category of its own for every row says nothing


def test_model_on_new_rows(spark):
    df = sample(spark)
    model, held = fit(df.where("id < 700").fillna("none"), "id", ["a", "shop"], "y", params=BoostParams(rounds=60))
    assert held.where("margin is not null").isEmpty() and len(model.models) == 1
    new = df.where("id >= 700").withColumn("shop", F.when(F.col("id") % 7 == 0, "unseen").otherwise(F.coalesce("shop", F.lit("none")))).withColumn("numbers", F.lit("x"))
    got = model.margin(new)
    assert got.columns == [*new.columns, "margin"] and got.count() == 200 and metrics.auc(got, "margin", "y").first().auc > 0.72
    assert abs(sum(model.importance().values()) - 1) < 1e-9 and model.importance()["a"] > 0.3
    with pytest.raises(ValueError, match="no features"):
        fit(df, "id", [], "y")


def test_constant_features_give_bare_leaves(spark):
    df = spark.createDataFrame([(i, i % 2, 1.0) for i in range(20)], "id long, y int, a double")
    model, _ = fit(df, "id", ["a"], "y", params=BoostParams(rounds=3))
    assert all(t.splits == [] and len(t.values) == 1 for t in model.models[0]) and model.importance() == {"a": 0.0}


def test_ordered_codes(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["hot", "hot", "b", None, f"u{i}"]), int(rng.random() < 0.4), rng.random() < 0.8) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, c string, y int, use boolean").repartition(3).withColumn("o", order_hash(F.col("id"), 7))
    got = ordered_target(df, "c", "y", "o", {"code": F.col("use")}, 0.3, rows=20).collect()
    assert len(got) == len(rows)
    for r in got:
        some = [x for x in got if x.c == r.c and x.use and (x.o < r.o or not r.use)]
        assert abs(r.code - (sum(x.y for x in some) + 0.3) / (len(some) + 1)) < 1e-12


def test_tree_numbers_leaves_by_answers():
    assert Tree([(0, 1), (1, 0)]).leaves(np.array([[0, 0], [0, 1], [2, 0], [2, 1]])).tolist() == [0, 1, 2, 3]
    assert boosting.best_split(np.zeros((1, 2, 4, 2), np.int64), 3.0) is None
