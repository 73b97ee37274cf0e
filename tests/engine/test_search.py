"""Bounds against exact scores, sets that need both features, the deadline, exact outputs."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.functions import metrics
from kiln.operators import contract, search, select
from kiln.operators.boosting import BoostParams
from kiln.operators.search import Sample, SetScores, auc_bounds, best_features, distance, fold_auc, gains, rank_auc, search_sets
from kiln.plans import pipeline
from kiln.sources.csv import read_csv


def table(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(i, y, y + rng.gauss(0, 1.5), rng.gauss(0, 1), float(rng.randrange(3)) if rng.random() < 0.8 else None, float("nan") if i % 3 else -y * 0.4, 7.0) for i in range(n) for y in [int(rng.random() < 0.3)]]
    return spark.createDataFrame(rows, "id long, y int, good double, noise double, few double, gaps double, same double").repartition(4), ["good", "noise", "few", "gaps", "same"]


def test_bounds_hold_exact_scores(spark):
    df, features = table(spark)
    sample = Sample.of(df, "id", features, "y", rows=200)
    assert 120 < len(sample.y) < 280 and sample.codes.shape == (len(sample.y), 5)
    bounds = auc_bounds(df, "y", sample)
    assert set(bounds) == {"good", "noise", "few", "gaps"}
    exact = {r.feature: r.auc for r in select.feature_scores(df, features, "y").collect()}
    for f, (low, high) in bounds.items():
        assert low - 1e-12 <= exact[f] <= high + 1e-12 and high - low < 0.05
    assert bounds["few"][0] == bounds["few"][1] and auc_bounds(df.limit(0), "y", sample) == {} and auc_bounds(df, "y", Sample.of(df, "id", [], "y")) == {}
    order = sorted(bounds, key=lambda f: (-abs(exact[f] - 0.5), f))
    for n in (1, 2, 4, 9):
        assert best_features(df, "y", bounds, n) == order[:n]
    assert distance((0.4, 0.7)) == (0.0, pytest.approx(0.2)) and distance((0.2, 0.3)) == (pytest.approx(0.2), pytest.approx(0.3))


def test_rank_auc():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 9, 200).astype(float), (rng.random(200) < 0.4).astype(float)
    a, b = x[y == 1], x[y == 0]
    assert abs(rank_auc(x, y) - ((a[:, None] > b).mean() + (a[:, None] == b).mean() / 2)) < 1e-12
    assert rank_auc(x, np.ones(200)) == 0.5
    codes = np.stack([x, rng.integers(0, 9, 200)], 1)
    assert fold_auc(codes, (x > 4).astype(float), 0, 2, BoostParams(rounds=3, bins=64)) > 0.99


def test_finds_a_pair_that_is_weak_singly(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1200):
        a, b = rng.random(), rng.random()
        y = int(((a > 0.5) != (b > 0.5)) != (rng.random() < 0.05))
        rows.append((i, y, a, b, *(0.25 * y + rng.gauss(0, 1) for _ in range(22))))
    names = ["a", "b", *(f"w{k:02}" for k in range(22))]
    df = spark.createDataFrame(rows, "id long, y int, " + ", ".join(f"{n} double" for n in names)).repartition(4)
    sample = Sample.of(df, "id", names, "y")
    bounds = auc_bounds(df, "y", sample)
    short = best_features(df, "y", bounds, 20)
    assert not {"a", "b"} & set(short)
    scores = SetScores(spark, sample)
    got = search_sets(scores, tuple(sorted(short[:5])), short, names)
    assert {"a", "b"} <= set(got) and len(got) <= 5
    steps = {step for step, *_ in scores.trace}
    assert {"start", "change"} <= steps and all(0 <= auc <= 1 for *_, auc in scores.trace)
    assert search_sets(scores, tuple(short[:5]), short, names, late=lambda: True) == tuple(short[:5])


def test_gains_and_spread():
    assert gains([0.6, 0.62, 0.61], [0.5, 0.52, 0.5]) and not gains([0.6, 0.4, 0.5], [0.5, 0.5, 0.5]) and not gains([0.5004] * 3, [0.5] * 3)
    near = lambda some: {frozenset(("a", "b"))}
    assert select.spread(["a", "b", "c", "d"], near, 3) == ["a", "c", "d"] and select.spread(["a", "b", "c"], near, 2, block=1) == ["a", "c"] and select.spread([], near) == []


def test_sample_near(spark):
    df, features = table(spark)
    sample = Sample.of(df.withColumn("copy", F.col("good") * -3 + 1), "id", ["good", "copy", "same"], "y")
    assert sample.near(["good", "copy", "same"]) == {frozenset(("good", "copy"))}


def test_deadline_holds_between_jobs(spark):
    began = time.perf_counter()
    with pytest.raises(TimeoutError), pipeline.within(spark, 0.5):
        time.sleep(1.5)  # the driver is busy when the time is over
        spark.range(0, 4, 1, 4).selectExpr("reflect('java.util.concurrent.locks.LockSupport', 'parkNanos', 60000000000L + id)").collect()
    assert time.perf_counter() - began < 30
    with pytest.raises(TimeoutError), pipeline.within(spark, 0.3):
        time.sleep(0.8)  # no job at all
    assert spark.range(5).count() == 5


def folder(tmp_path, extra=""):
    rng = random.Random(9)
    data, out = tmp_path / "data", tmp_path / "out"
    data.mkdir(), out.mkdir()
    y = {i: int(rng.random() < 0.4) for i in range(200)}
    (data / "train.csv").write_text(f"cid;bought{extra and ';' + extra}\n" + "".join(f"{i};{y[i]}{extra and ';' + str(i % 7)}\n" for i in range(150)))
    (data / "test.csv").write_text(f"cid{extra and ';' + extra}\n" + "".join(f"{i}{extra and ';' + str(i % 7)}\n" for i in range(150, 200)))
    (data / "visits.csv").write_text("cid|spent\n" + "".join(f"{i % 200}|{rng.gauss(10 + 4 * y[i % 200], 3):.2f}\n" for i in range(900)))
    return data, out


def test_exact_columns_and_record(spark, tmp_path):
    data, out = folder(tmp_path, "region")
    spec = pipeline.TaskSpec("cid", "bought", judge=BoostParams(rounds=3, depth=3))
    got = pipeline.run_recorded(spark, str(data), str(out), spec)
    assert (got.train_rows, got.test_rows, got.stopped) == (150, 50, False) and 1 <= len(got.chosen) <= 5
    assert got.table(spark).first().candidates == got.candidates
    train, test = (read_csv(spark, str(out / f"{k}.csv")) for k in ("train", "test"))
    assert train.columns == ["cid", "bought", *got.chosen] and test.columns == ["cid", *got.chosen]
    inputs = {k: read_csv(spark, str(data / f"{k}.csv")) for k in ("train", "test")}
    rules = lambda outputs: {(r.rule, r.column_name) for r in contract.violations(spark, inputs, outputs, id_col="cid", target="bought").collect()}
    assert rules({"train": train, "test": test}) == set()
    assert rules({"train": train.withColumn("region", F.lit(1)), "test": test}) == {("extra_column", "region")}
    with pytest.raises(ValueError, match="region"):
        pipeline.run(spark, str(data), str(out), pipeline.TaskSpec("cid", "bought", strict=True))


def test_target_from_a_table_of_its_own(spark, tmp_path):
    data, out = folder(tmp_path)
    whole = (data / "train.csv").read_text()
    (data / "labels.csv").write_text(whole)
    (data / "train.csv").write_text("\n".join(x.partition(";")[0] for x in whole.split("\n")))
    got = pipeline.run_recorded(spark, str(data), str(out), pipeline.TaskSpec("cid", "bought", judge=BoostParams(rounds=2, depth=2)))
    assert (out / "train.csv").read_text().startswith("cid,bought," + ",".join(got.chosen)) and not any("bought" in c for c in got.chosen)
    (data / "labels.csv").unlink()
    with pytest.raises(ValueError, match="no table has cid and bought"):
        pipeline.run(spark, str(data), str(out), pipeline.TaskSpec("cid", "bought"))


def test_late_search_keeps_what_it_has(spark, tmp_path, monkeypatch):
    data, out = folder(tmp_path)
    monkeypatch.setattr(pipeline, "best_features", lambda *a: time.sleep(60))
    began = time.perf_counter()

    def stop(*a):
        raise TimeoutError

    monkeypatch.setattr(pipeline, "best_features", stop)
    got = pipeline.run_recorded(spark, str(data), str(out), pipeline.TaskSpec("cid", "bought"))
    assert got.stopped and got.chosen and any("spent" in c for c in got.chosen) and time.perf_counter() - began < 120
    with pytest.raises(TimeoutError):
        pipeline.run(spark, str(data), str(out), pipeline.TaskSpec("cid", "bought", budget_s=0.01))


def test_written_facts_are_those_of_a_pass(spark, tmp_path):
    ids = spark.range(30).withColumnRenamed("id", "cid")
    good = ids.withColumn("f", F.col("cid") * 1.0).withColumn("g", F.lit(float("nan")))
    assert pipeline.written(good, ids, "cid", ["f"], str(tmp_path / "a.csv")) == (30, [])
    n, broken = pipeline.written(good.where("cid < 29").union(good.where("cid = 1")), ids, "cid", ["f", "g"], str(tmp_path / "b.csv"))
    assert n == 30 and len(broken) == 2 and "g is empty" in broken[0] and "other ids" in broken[1]


def test_rows_deal_out_alike():
    assert search.RUNGS[-1][0] == search.SEARCH_ROWS and math.isclose(search.RUNGS[-1][3], 1.0)
    assert metrics.auc  # the exact score that bounds stand in for
