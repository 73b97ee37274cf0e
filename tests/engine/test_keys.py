"""Keys and joins by sketches: the links that counting everything finds, keys of two columns, jobs in proportion to tables."""

import random

import pytest
from pyspark.sql import functions as F

from kiln.operators import profile
from kiln.operators.boosting import BoostParams
from kiln.operators.profile import find_keys, inclusion, join_graph, key_check, sketches
from kiln.plans import pipeline
from kiln.sources import catalog

NAMES = "region nation customer supplier part orders lineitem events labels documents conversations".split()


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in NAMES}


def test_same_links_as_counting_everything(spark, tables):
    few = {n: tables[n] for n in ("region", "nation", "customer", "supplier", "orders", "labels", "documents")}
    tail = lambda c: c.partition("_")[2] or c
    whole = lambda kind: kind in ("int", "bigint")
    want = set()
    for p, parent in few.items():
        for k, kind in parent.dtypes:
            if kind in ("int", "bigint", "string") and k != "text" and key_check(parent, [k]).first().is_key:
                for t, child in few.items():
                    for c, own in child.dtypes:
                        if t != p and tail(c) == tail(k) and (own == kind or whole(own) and whole(kind)):
                            r = inclusion(child, c, parent, k).first()
                            if r.n_rows and not r.n_orphans:
                                want.add((t, c, p, k))
    assert want and {x for x in join_graph(few) if isinstance(x[1], str)} == want


def test_jobs_grow_with_tables_not_columns(spark, tables):
    def jobs(width):
        wide = {n: tables[n].select("*", *(F.col(tables[n].columns[0]).alias(f"x{i}_{n}") for i in range(width))) for n in ("nation", "region", "customer")}
        tag = f"count-{width}"
        spark.sparkContext.setJobGroup(tag, tag)
        try:
            find_keys(wide, 1)
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))

    assert jobs(8) <= jobs(0) + 40 and jobs(8) < 11 * 3 * 2  # one aggregate a table; candidates' exact counts share one job and its broadcast-free stages


def test_sketches_say_what_counts_say(spark):
    rng = random.Random(3)
    rows = [(i, i % 977, None if i % 10 == 0 else f"s{rng.randrange(50)}", 5) for i in range(20_000)]
    made = sketches(spark.createDataFrame(rows, "a long, b int, c string, d int"), [("a",), ("b",), ("c",), ("d",), ("b", "c")])
    for key, n in {("a",): 20_000, ("b",): 977, ("c",): 50, ("d",): 1}.items():
        assert abs(made[key].n_distinct - n) <= profile.SLACK * n and made[key].n_rows == 20_000
    assert made["c",].n_some == 18_000 and made["b", "c"].n_some == 18_000 and made["a",].may_be_key and not made["b",].may_be_key
    assert sketches(spark.createDataFrame([], "a long"), [("a",)])[("a",)].n_distinct == 0 and sketches(spark.range(3), []) == {}


def test_keys_of_two_columns(spark, tables):
    keys, _ = find_keys({n: tables[n] for n in ("conversations", "lineitem", "orders")})
    assert ("conv_id", "turn") in keys["conversations"] and keys["lineitem"] == [] and keys["orders"] == [("o_orderkey",)]
    stock = spark.createDataFrame([(a, b, 10 * a + b) for a in range(6) for b in range(4)], "shop int, item string, level int").drop("level")
    sold = spark.createDataFrame([(a % 6, str(a % 3), a) for a in range(50)], "shop bigint, item string, amount long")
    odd = spark.createDataFrame([(7, "0")], "shop int, item string")
    graph = join_graph({"stock": stock, "sold": sold, "odd": odd})
    assert ("sold", ("shop", "item"), "stock", ("shop", "item")) in graph and not any(g[0] == "odd" and g[2] == "stock" for g in graph)
    assert find_keys({"e": spark.createDataFrame([], "a int, b int")})[0] == {"e": []}
    assert find_keys({"n": spark.createDataFrame([(1, None), (2, 3)], "a int, b int")})[0] == {"n": [("a",)]}


def test_values_don_t_run_together(spark):
    left = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    assert left.select(profile.key_value(("x", "y"), dict(left.dtypes))).distinct().count() == 2


def test_run_joins_by_two_columns(spark, tmp_path):
    data, n = tmp_path / "in", 60
    ids = spark.range(n).selectExpr("id as cid", "cast(id % 2 as int) as y")
    ids.where("cid < 45").write.parquet(str(data / "train.parquet"))
    ids.where("cid >= 45").drop("y").write.parquet(str(data / "test.parquet"))
    # Who was where: a visit names a shop and a day; only both together name a row of ``weather``.
    visits = spark.range(240).selectExpr("id % 60 as cid", "cast((id % 60) % 2 + 2 * (id % 3) as int) as v_shop", "concat('d', cast(id / 60 as int)) as v_day")
    visits.write.parquet(str(data / "visits.parquet"))
    weather = spark.range(24).selectExpr("cast(id % 6 as int) as w_shop", "concat('d', cast(id / 6 as int)) as w_day", "double(id % 2) * 5 + rand(3) as w_rain")
    weather.write.parquet(str(data / "weather.parquet"))
    catalog = pipeline.TableCatalog(spark, str(data))
    assert ("visits", ("v_shop", "v_day"), "weather", ("w_shop", "w_day")) in join_graph({k: catalog[k] for k in ("visits", "weather")})
    found = pipeline.history_tables(catalog, "cid")
    assert set(found) == {"visits", "weather"} and {"cid", "w_rain"} <= set(found["weather"].columns)
    chosen = pipeline.run(spark, str(data), str(tmp_path / "out"), pipeline.TaskSpec("cid", "y", judge=BoostParams(rounds=3, depth=2)))
    assert any("w_rain" in c for c in chosen)


PROSE = """We want to know who leaves. The sample is in train, and cid is the number of a client.
Clicks were logged by the site. Its field who is the client, the same number as cid in train!
There are also shops. Every click happened in one of the shops; the place of a click is the code of a shop."""


def test_prose_names_joins(spark, tmp_path):
    columns = {"train": ["cid"], "clicks": ["who", "place", "amount"], "shops": ["code", "rent"]}
    assert catalog.join_hints(catalog.descriptions(PROSE, list(columns)), columns) == set()
    hints = [h for h, _ in catalog.prose_hints(PROSE, columns)]
    assert ("clicks", "who", "train", "cid") in hints[:4] and ("clicks", "place", "shops", "code") in hints[:4]
    assert catalog.prose_hints("", columns) == [] and catalog.prose_hints("Nothing of note.", columns) == []
    (tmp_path / "train.csv").write_text("cid;y\n" + "".join(f"{i};{i % 2}\n" for i in range(20)))
    (tmp_path / "test.csv").write_text("cid\n" + "".join(f"{i}\n" for i in range(20, 30)))
    (tmp_path / "clicks.csv").write_text("who;place;amount\n" + "".join(f"{i % 30};{100 + i % 4};{i}\n" for i in range(90)))
    (tmp_path / "shops.csv").write_text("code;rent\n" + "".join(f"{100 + i};{i * 1.5}\n" for i in range(4)))
    assert pipeline.history_tables(catalog.TableCatalog(spark, str(tmp_path)), "cid") == {}
    (tmp_path / "readme.txt").write_text(PROSE)
    found = pipeline.history_tables(catalog.TableCatalog(spark, str(tmp_path)), "cid")
    assert set(found) == {"clicks", "shops"} and found["clicks"].where("cid = 3").count() == 3 and "rent" in found["shops"].columns
    # A hint that values refute is no join.
    (tmp_path / "readme.txt").write_text("In clicks the amount is the cid of train.")
    assert ("clicks", "amount", "train", "cid") in [h for h, _ in catalog.prose_hints("In clicks the amount is the cid of train.", columns)]
    assert pipeline.history_tables(catalog.TableCatalog(spark, str(tmp_path)), "cid") == {}
