"""Every query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from kiln.plans.oracles import ORACLE_SQL
from kiln.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    order = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    rel = duck.sql(ORACLE_SQL[name])
    assert sorted(rel.columns) == order
    theirs = sorted((tuple(plain(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall()), key=repr)
    assert ours == theirs


def test_without_sql(spark):
    assert os.path.isdir(FOLDER)
    noise = QUERIES["baseline_noise"](spark, FOLDER)
    assert sorted(map(tuple, noise.collect())) == sorted(map(tuple, QUERIES["baseline_noise"](spark, FOLDER).repartition(3).collect()))
    row = noise.selectExpr("avg(ft_1) m", "stddev_pop(ft_1) s", "corr(ft_1, ft_2) c").first()
    assert abs(row.m) < 0.3 and 0.8 < row.s < 1.2 and abs(row.c) < 0.3
    scores = QUERIES["gbt_cv_score"](spark, FOLDER).collect()
    assert [r.fold for r in sorted(scores)] == list(range(5)) and all(0 <= r.auc <= 1 for r in scores)


def test_score_report(spark, duck):
    (row,) = QUERIES["score_report"](spark, FOLDER).collect()
    (split,) = duck.sql("SELECT count_if(doc_id % 5 <> 0), count_if(doc_id % 5 = 0) FROM labels JOIN documents USING (doc_id)").fetchall()
    assert (row.train_rows, row.test_rows) == split and row.n_features == 3
    assert 0 <= row.roc_auc <= 1 and abs(row.gini - (2 * row.roc_auc - 1)) < 1e-5 and 0 <= row.cv_mean_auc <= 1
