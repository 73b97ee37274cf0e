"""The additive model: held-out accuracy, tables against a direct sum, and edge cases."""

import zlib

import numpy as np

from kiln.llm import quality


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.Additive(x, y)
    s = model.score(x)
    assert ((s > 0.5) == y).mean() > 0.9  # only the pair tells the classes apart
    bins = model.bins(x[:5])
    for i in range(5):
        raw = model.base + sum(t[bins[i, j]] for j, t in enumerate(model.tables))
        raw += sum(g[model.coarse[a][bins[i, a]], model.coarse[b][bins[i, b]]] for (a, b), g in zip(model.pairs, model.grids, strict=True))
        assert abs(1 / (1 + np.exp(-raw)) - s[i]) < 1e-12


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = quality.op1_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.97
    good, bad = got.score[got.quality == 1].to_numpy(), got.score[got.quality == 0].to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.97


def test_edges(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (2, None), (None, "x " * 50_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, None, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        rows = quality.score(docs, quality.fit(docs, labels), ["doc_id"]).collect()
        assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), none), ["doc_id"]).count() == 0


def test_rows_of_a_fit_are_bounded_and_held_out_is_crc32(spark, tmp_path):
    docs = spark.createDataFrame([(i % 7, f"a b {i % 50}", i) for i in range(900)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(7)], "doc_id long, quality int, toxic int")
    sizes = []
    plain = quality.Additive.__init__
    quality.Additive.__init__ = lambda self, x, y: (sizes.append(len(y)), plain(self, x, y))[1]
    try:
        quality.fit(docs, labels, 100)
    finally:
        quality.Additive.__init__ = plain
    assert sizes == [100]
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert quality.keep_good(spark, docs, str(tmp_path), 0.0).columns == docs.columns  # a column named score stays
    ids = spark.range(-5, 300).select("id", quality.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in ids)
