"""Join semantics, exact scores, leakage, the output contract and the whole run."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from kiln.functions import columns, encoders, metrics
from kiln.operators import contract, evaluate, features, joins, profile, select
from kiln.operators.features import FeatureSpec, compile_features
from kiln.operators.ordered import range_of, running_before
from kiln.plans import pipeline
from kiln.sources import catalog
from kiln.sources.csv import read_csv
from kiln.streaming import events as ev


def test_lookup_semantics(spark):
    left = spark.createDataFrame([(1, "a", 1), (None, "b", 2), (3, "c", 3)], "k long, v string, x long")
    right = spark.createDataFrame([(1, 10), (1, 11), (None, 12)], "k long, x long")
    got = sorted(map(tuple, joins.lookup_left(left, right, ["k"]).select("k", "v", "x_x", "x_y").collect()), key=repr)
    assert got == sorted([(1, "a", 1, 10), (1, "a", 1, 11), (None, "b", 2, 12), (3, "c", 3, None)], key=repr)
    with pytest.raises(ValueError, match="repeats"):
        joins.lookup_left(left, right, ["k"], unique=True)
    with pytest.raises(TypeError):
        joins.lookup_left(left, right.withColumn("k", F.col("k").cast("string")), ["k"])


def test_auc(spark):
    rng = random.Random(0)
    rows = [(rng.randrange(30), int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "x long, y int")
    pos, neg = [x for x, y in rows if y], [x for x, y in rows if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    assert abs(metrics.auc(df, "x", "y").first().auc - want) < 1e-12
    assert abs(metrics.auc(df.withColumn("x", -F.col("x")), "x", "y").first().auc - (1 - want)) < 1e-12
    assert metrics.auc(df.withColumn("x", F.lit(1)), "x", "y").first().auc == 0.5
    assert metrics.auc(df.where("y = 1"), "x", "y").first().auc is None and metrics.auc(df.limit(0), "x", "y").first().auc is None


def test_running_before(spark):
    df = spark.createDataFrame([(x, x % 7) for x in random.Random(1).sample(range(1000), 300)], "x long, v long")
    got = {r.x: r.v_before for r in running_before(df, "x", ["v"], rows=40).collect()}
    assert got == {x: sum(y % 7 for y in got if y < x) for x in got}


def test_groups_are_ordered_in_ranges(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.choice(["a", "b", None]), x, x % 5) for x in range(600)], "g string, x long, v long")
    rows = [tuple(r) for r in df.collect()]
    got = {r.x: r.v_before for r in running_before(df, "x", ["v"], ["g"], rows=20).collect()}
    assert got == {x: sum(w for h, y, w in rows if h == g and y < x) for g, x, v in rows}
    ranges = range_of(df, "x", ["g"], rows=20).groupBy("g", "__range").count().collect()
    assert len(ranges) > 20 and max(r["count"] for r in ranges) < 60
    labelled = df.withColumn("y", (df.v > 2).cast("int"))
    for plan in (metrics.stratified_folds(labelled, "x", "y", 5), metrics.auc_by(labelled, "x", "y", ["g"]), select.feature_scores(labelled, ["x"], "y")):
        windows = [x for x in plan._jdf.queryExecution().optimizedPlan().toString().split("\n") if "windowspecdefinition" in x]
        assert windows and all("__range" in x or "__first" in x for x in windows)  # no window over a whole class, group or feature


def test_lookups_of_a_table_are_one_join(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    side = spark.createDataFrame([(1, 3.0, 4.0), (3, 5.0, 6.0)], "id long, a double, b double")
    made = compile_features(ids, "id", {"s": side}, [FeatureSpec(f"s_{c}", "lookup", "s", "id", c) for c in "ab"])
    assert made._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert sorted(made.collect()) == [(1, 3.0, 4.0), (2, None, None)]


def test_folds(spark):
    rng = random.Random(3)
    y = [int(rng.random() < 0.2) for _ in range(103)]
    df = spark.createDataFrame(list(enumerate(y)), "i long, y int")
    got = {r.i: r.fold for r in metrics.stratified_folds(df, "i", "y", 5).collect()}
    codes = {c: k for k, c in enumerate(dict.fromkeys(y))}
    order = sorted(codes[c] for c in y)
    alloc = [[order[f::5].count(k) for f in range(5)] for k in range(2)]
    runs = {k: [f for f in range(5) for _ in range(alloc[k][f])] for k in range(2)}
    seen = {0: 0, 1: 0}
    for i, c in enumerate(y):
        assert got[i] == runs[codes[c]][seen[codes[c]]]
        seen[codes[c]] += 1


def test_fill_and_tail(spark):
    df = spark.createDataFrame([(1, float("nan"), None, None), (2, None, "a", True)], "i long, d double, s string, b boolean")
    assert [tuple(r) for r in columns.fill_missing(df, ["i", "d", "s", "b"]).collect()] == [(1.0, -999.0, "-999", "-999"), (2.0, -999.0, "a", "true")]
    assert columns.categorical(df, df.columns) == [2] and df.select(columns.tail(F.lit("abc"), 2)).first()[0] == "bc"


def test_out_of_fold_code_of_an_id_says_nothing(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, i // 2, int(rng.random() < 0.5), i % 4) for i in range(2000)], "id long, c long, y int, fold int")
    coded = df.join(encoders.out_of_fold_target(df, "c", "y", "fold"), ["c", "fold"])
    assert abs(metrics.auc(coded, "encoded", "y").first().auc - 0.5) < 0.05


def test_profile_and_join_graph(spark):
    f = "/root/testdata/sf0.001"
    tables = {n: spark.read.parquet(f"{f}/{n}.parquet") for n in ("nation", "region", "customer", "orders", "events")}
    graph = profile.join_graph(tables)
    assert ("orders", "o_custkey", "customer", "c_custkey") in graph and ("nation", "n_regionkey", "region", "r_regionkey") in graph
    assert not any(g[0] == "events" and g[1] == "user_id" for g in graph)  # dense integers include one another by chance


def pair(spark, train="id long, y int, a double", test="id long, a double"):
    make = lambda schema: spark.createDataFrame([tuple(0.5 if "double" in c else 1 for c in schema.split(","))], schema)
    return {"train": make(train), "test": make(test)}


def test_contract_mutants(spark):
    inputs = pair(spark, "id long, y int", "id long")
    rules = lambda out, **k: {r.rule for r in contract.violations(spark, inputs, out, id_col="id", **k).collect()}
    assert rules(pair(spark)) == set()
    assert "missing_input_column" in rules(pair(spark, train="id long, a double"))
    assert "feature_names_differ" in rules(pair(spark, test="id long, b double"))
    assert "feature_count" in rules(pair(spark, "id long, y int", "id long"))
    six = ", ".join(f"f{i} double" for i in range(6))
    assert "feature_count" in rules(pair(spark, f"id long, y int, {six}", f"id long, {six}"))
    empty = {k: v.withColumn("a", F.lit(None).cast("double")) for k, v in pair(spark).items()}
    assert "empty_feature" in rules(empty) and "empty_feature" in rules({k: v.withColumn("a", F.lit(float("nan"))) for k, v in pair(spark).items()})
    assert "duplicate_column" in rules(pair(spark), headers={"train": ["id", "y", "a", "a"]})
    good = pair(spark)
    assert rules({"train": good["train"].limit(0), "test": good["test"].union(good["test"])}) >= {"id_missing", "id_added"}


def test_whole_run(spark, tmp_path):
    rng = random.Random(9)
    data, out = tmp_path / "data", tmp_path / "out"
    data.mkdir(), out.mkdir()
    y = {i: int(rng.random() < 0.4) for i in range(400)}
    (data / "train.csv").write_text("cid;bought\n" + "".join(f"{i};{y[i]}\n" for i in range(300)))
    (data / "test.csv").write_text("cid\n" + "".join(f"{i}\n" for i in range(300, 400)))
    lines = [f"{i}|{rng.gauss(10 + 8 * y[i], 3):.2f}|{rng.choice('abc')}\n" for i in range(400) for _ in range(rng.randrange(1, 4))]
    (data / "visits.csv").write_text("cid|spent|shop\n" + "".join(lines))
    (data / "person.csv").write_text("cid,age\n" + "".join(f"{i},{20 + i % 50}\n" for i in range(400)))
    spec = pipeline.TaskSpec("cid", "bought", judge=evaluate.BoostParams(rounds=2, depth=3))
    chosen = pipeline.run(spark, str(data), str(out), spec)
    assert 1 <= len(chosen) <= 5 and chosen[0].startswith("visits_") and "spent" in chosen[0]
    train, test = (read_csv(spark, str(out / f"{k}.csv")) for k in ("train", "test"))
    assert train.columns == ["cid", "bought", *chosen] and test.columns == ["cid", *chosen] and train.count() == 300 and test.count() == 100
    labels = spark.createDataFrame(list(y.items()), "cid long, bought int")
    result = evaluate.score(train, test, labels, "cid", "bought", params=evaluate.BoostParams(rounds=2, depth=3))
    assert result.roc_auc > 0.8 and abs(result.gini - (2 * result.roc_auc - 1)) < 2e-6 and result.primary == result.roc_auc
    with pytest.raises(ValueError, match="no label"):
        evaluate.score(train, test, labels.where("cid < 350"), "cid", "bought")
    assert pipeline.ensure_target(train.drop("bought"), labels, spec).where("bought is null").count() == 0


def test_selection(spark):
    rng = random.Random(2)
    rows = [(i, y, y + rng.random(), rng.random(), 1.0) for i, y in ((i, i % 2) for i in range(300))]
    df = spark.createDataFrame(rows, "i long, y int, good double, noise double, same double").withColumn("copy", F.col("good") * 2)
    assert select.choose(df, ["copy", "good", "noise", "same"], "y") == ["copy", "noise"]


def test_streams(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    stream = ev.event_stream(spark, folder)
    out = ev.run_once(ev.sessions(stream), "append")
    assert out.count() > 0 and out.where("end <= start").count() == 0


def test_run_walks_joins(spark, tmp_path):
    data = tmp_path / "in"
    n = 40
    orders = spark.range(1000, 1000 + 2 * n).selectExpr("id as o_orderkey", "cast((id - 1000) % 40 as bigint) as o_custkey", "cast(id % 3 as int) as o_prio", "date_add(date'2020-01-01', cast(id % 5 as int)) as o_date", "id % 2 = 0 as o_open")
    lines = spark.range(0, 4 * n).selectExpr("1000 + id % 80 as l_orderkey", "cast((id % 40) % 2 * 10 + id % 7 as int) as l_qty")
    ids = spark.range(n).selectExpr("id as c_custkey", "cast(id % 2 as int) as y")
    for name, df in {"orders": orders, "lineitem": lines, "customer": ids.selectExpr("c_custkey", "c_custkey % 4 as c_rank"), "train": ids.where("c_custkey < 30"), "test": ids.where("c_custkey >= 30").drop("y")}.items():
        df.write.parquet(str(data / f"{name}.parquet"))
    tables = pipeline.history_tables(pipeline.TableCatalog(spark, str(data)), "c_custkey")
    assert set(tables) == {"customer", "orders", "lineitem"} and tables["lineitem"].where("c_custkey = 3").count() == 4
    names = {s.name for s in pipeline.candidate_specs(tables, "c_custkey", "y")}
    assert {"lineitem_avg_l_qty", "orders_max_o_date", "orders_avg_o_open", "orders_sum_o_prio", "customer_c_rank"} <= names
    chosen = pipeline.run(spark, str(data), str(tmp_path / "out"), pipeline.TaskSpec("c_custkey", "y", judge=evaluate.BoostParams(rounds=2, depth=3)))
    assert chosen and not any(c.startswith("ft_") for c in chosen)
    bare = tmp_path / "bare"
    for name in ("train", "test"):
        spark.read.parquet(str(data / f"{name}.parquet")).write.parquet(str(bare / f"{name}.parquet"))
    with pytest.raises(ValueError, match="joined"):
        pipeline.run(spark, str(bare), str(tmp_path / "out2"), pipeline.TaskSpec("c_custkey", "y"))


def test_descriptions_and_hints(spark, tmp_path):
    text = "The task: predict y.\n\n## train.csv - the sample\n- `cid`: the id\n\nclicks.csv: what people did\n  who (bigint) - the person, see train.cid\n  at: time\nshops.code: key\n"
    found = catalog.descriptions(text, ["train", "clicks", "shops"])
    assert found == [("train", None, "the sample"), ("train", "cid", "the id"), ("clicks", None, "what people did"), ("clicks", "who", "the person, see train.cid"), ("clicks", "at", "time"), ("shops", "code", "key")]
    assert catalog.join_hints(found, {"train": ["cid"], "clicks": ["who", "at"]}) == {("clicks", "who", "train", "cid")}
    assert catalog.descriptions("", ["a"]) == [] and catalog.join_hints([("a", "b", "see nowhere.k")], {"a": ["b"]}) == set()
    (tmp_path / "train.csv").write_text("cid;y\n1;0\n2;1\n")
    (tmp_path / "test.csv").write_text("cid\n3\n")
    (tmp_path / "clicks.csv").write_text("who;at\n1;5\n3;6\n3;7\n")
    (tmp_path / "blank.csv").write_text("")
    tables = catalog.TableCatalog(spark, str(tmp_path))
    with pytest.raises(ValueError, match="empty"):
        tables["blank"]
    (tmp_path / "blank.csv").unlink()
    assert pipeline.history_tables(catalog.TableCatalog(spark, str(tmp_path)), "cid") == {}
    (tmp_path / "readme.txt").write_text(text)
    assert pipeline.history_tables(catalog.TableCatalog(spark, str(tmp_path)), "cid")["clicks"].where("cid = 3").count() == 2


def test_grammar_values_and_windows(spark):
    rows = [(1, "a'b", "2024-01-01", 2.0), (1, "c", "2024-03-30", 3.0), (2, "c", "2024-01-05", 5.0), (2, None, "2024-01-02", None)]
    df = spark.createDataFrame(rows, "k long, s string, d string, v double").withColumn("d", F.to_date("d"))
    values, last = profile.common_values(df), profile.last_days(df)
    assert values == {"s": ["a'b", "c"]} and str(last["d"]) == "2024-03-30"
    specs = features.grammar("h", df, "k", (), values, last)
    assert len({s.name for s in specs}) == len(specs)
    out = {r.k: r for r in features.compile_features(spark.createDataFrame([(1,), (2,), (3,)], "k long"), "k", {"h": df}, specs).collect()}
    assert out[1].h_share_s_a_b == 0.5 and out[2].h_share_s_c == 1.0 and out[3].h_count is None
    assert out[1].h_count_30d_d == 1 and out[1].h_sum_v_30d_d == 3.0 and out[2].h_sum_v_90d_d == 5.0 and out[2].h_share_90d_d == 1.0 and out[2].h_share_30d_d == 0
    assert features.value_names("p", ["a b", "a-b"]) == {"a b": "p_a_b", "a-b": "p_a_b_1"}
    assert profile.common_values(df.select("k")) == {} and profile.last_days(df.select("k")) == {} and profile.common_values(df.limit(0)) == {}


def test_forward_prefers_what_completes(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, int(1.2 * a + 0.9 * b + rng.gauss(0, 0.7) > 0), a + rng.gauss(0, 0.2), a + rng.gauss(0, 0.2), b + rng.gauss(0, 0.9), rng.random(), None))
    df = spark.createDataFrame(rows, "i long, y int, twin1 double, twin2 double, other double, chance double, blank double")
    got = select.forward(df, select.ranked(df, ["twin1", "twin2", "other", "chance", "blank"], "y"), "y", "i", limit=2)
    assert len(got) == 2 and "other" in got  # two near twins have the two best single scores
    assert select.forward(df, [], "y", "i") == [] and select.forward(df, ["twin1"], "y", "i", late=lambda: True) == []


@pytest.mark.parametrize("limit", [100_000, 0])
def test_codes_match_plain_sums(spark, monkeypatch, limit):
    monkeypatch.setattr(select, "MAX_CODES", limit)
    rng = random.Random(6)
    rows = [(i % 3, int(rng.random() < 0.4), rng.choice(["p", "q", None])) for i in range(90)]
    got = select.woe_codes(spark.createDataFrame(rows, "fold int, y int, b string"), {"b": "b"}, "y", "fold").collect()
    for r in got:
        rest = [(y, b) for f, y, b in rows if f != r.fold]
        n = lambda y, b=0: sum(1 for v, c in rest if v == y and (b == 0 or c == b))
        want = math.log(((n(1, r.b) + 0.5) / (n(1) + 0.5)) / ((n(0, r.b) + 0.5) / (n(0) + 0.5)))
        assert abs(r["__w_b"] - want) < 1e-12


def test_time_limit_cuts_jobs(spark):
    began = time.perf_counter()
    with pytest.raises(TimeoutError), pipeline.within(spark, 1.5):
        spark.range(0, 4, 1, 4).selectExpr("reflect('java.util.concurrent.locks.LockSupport', 'parkNanos', 60000000000L + id)").collect()
    assert time.perf_counter() - began < 30
    with pytest.raises(TimeoutError), pipeline.within(spark, 0):
        pass
    with pytest.raises(KeyError), pipeline.within(spark, 100):
        raise KeyError("own errors pass")
    assert spark.range(5).count() == 5


def test_features_over_time(spark):
    rows = [(1, "2024-01-01", 10.0), (1, "2024-01-11", 30.0), (1, "2024-01-31", 20.0), (2, "2024-01-31", 5.0), (3, None, 7.0)]
    df = spark.createDataFrame(rows, "k long, d string, v double").withColumn("d", F.to_date("d"))
    specs = features.over_time("h", "k", "d", profile.last_days(df)["d"], ["v"])
    got = {r.k: r for r in compile_features(spark.createDataFrame([(1,), (2,), (3,)], "k long"), "k", {"h": df}, specs).collect()}
    x, y = [0, 10, 30], [10.0, 30.0, 20.0]
    mx, my = sum(x) / 3, sum(y) / 3
    slope = sum((a - mx) * (b - my) for a, b in zip(x, y, strict=True)) / sum((a - mx) ** 2 for a in x)
    assert got[1].h_gap_d == 15 and got[1].h_recency_d == 0 and abs(got[1].h_slope_v_d - slope) < 1e-9
    assert abs(got[1].h_decayed_count_d - (0.5 + 0.5 ** (20 / 30) + 1)) < 1e-9 and abs(got[1].h_decayed_v_d - (5 + 30 * 0.5 ** (20 / 30) + 20)) < 1e-9
    assert got[2].h_gap_d is None and got[2].h_slope_v_d is None and got[3].h_decayed_count_d == 0 and got[3].h_recency_d is None


def test_ratios(spark):
    df = spark.createDataFrame([(1, 2.0, 4.0), (1, 4.0, 8.0), (2, 1.0, 0.0)], "k long, a double, b double")
    ids = spark.createDataFrame([(1,), (2,)], "k long")
    got = {r.k: r.h_ratio_a_b for r in compile_features(ids, "k", {"h": df}, features.ratios("h", "agg", "k", ["a", "b"])).collect()}
    assert got == {1: 0.5, 2: None} and "o_ratio_a_b" in {s.name for s in features.column_specs("o", "own", df, "k")}
    assert len(features.ratios("h", "agg", "k", list("abcdefgh"))) == 15


def test_rows_are_not_dealt_by_class_or_feature(spark):
    df = spark.createDataFrame([(i, i % 2, float(i % 9)) for i in range(400)], "i long, y int, x double")
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for plan, key in ((metrics.stratified_folds(df, "i", "y", 5), "y"), (select.feature_scores(df, ["x", "i"], "y"), "feature")):
            text = plan._jdf.queryExecution().executedPlan().toString()
            dealt = [x for x in text.split("\n") if "hashpartitioning(" in x]
            rows_by_class = [x for x in dealt if f"hashpartitioning({key}#" in x and "," not in x.partition("hashpartitioning(")[2].partition(")")[0].replace(", 4", "")]
            assert dealt and "SortMergeJoin" not in text, text
            assert len(rows_by_class) <= 4  # sums and cuts of a class, never its rows
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def stream_files(spark, folder, name, rows):
    import pandas as pd

    folder.mkdir(exist_ok=True)
    made = pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
    made["ts"] = pd.to_datetime(made["ts"]).astype("datetime64[us]")
    made.to_parquet(folder / f"{name}.parquet")


def test_keyed_state_with_late_files_and_a_restart(spark, tmp_path):
    one = lambda i, ts, user, kind="view", value=1.0: (i, ts, user, kind, value, None)
    folder, state = tmp_path / "in", f"file://{tmp_path}/job"
    stream_files(spark, folder, "events1", [one(1, "2024-01-01 00:00:00", 1), one(2, "2024-01-03 00:00:00", 1, "click", None), one(3, "2024-01-03 00:00:00", 2)])
    stream = lambda: ev.last_event_features(ev.event_stream(spark, str(folder)))
    first = {r.event_id: r for r in ev.run_once(stream(), "append", state).collect()}
    assert set(first) == {1} and first[1].n_before == 0 and first[1].gap_s is None  # the others still wait
    # In time though out of order (4), and later than a day (5).
    stream_files(spark, folder, "events2", [one(4, "2024-01-02 12:00:00", 1, "view", 4.0), one(5, "2024-01-01 06:00:00", 1)])
    stream_files(spark, folder, "events3", [one(6, "2024-01-09 00:00:00", 2), one(7, "2024-01-09 00:00:01", 3)])
    got = {r.event_id: r for r in ev.run_once(stream(), "append", state).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert (got[4].gap_s, got[4].last_type, got[4].n_before) == (36 * 3600, "view", 1)
    assert (got[2].gap_s, got[2].last_value, got[2].last_type) == (12 * 3600, 4.0, "view") and got[3].n_before == 0


def test_two_streams_within_an_hour(spark, tmp_path):
    one = lambda i, ts, user, kind: (i, ts, user, kind, 1.0, None)
    stream_files(spark, tmp_path / "in", "events1", [one(1, "2024-01-01 00:00:00", 1, "click"), one(2, "2024-01-01 01:00:00", 1, "purchase"), one(3, "2024-01-01 01:00:01", 1, "purchase"), one(4, "2024-01-01 00:30:00", 2, "purchase")])
    side = lambda kind: ev.event_stream(spark, str(tmp_path / "in")).where(F.col("event_type") == kind)
    assert [tuple(r) for r in ev.run_once(ev.within_after(side("click"), side("purchase")), "append").collect()] == [(1, 1, 2, 3600.0)]
