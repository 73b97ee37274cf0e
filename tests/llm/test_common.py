"""Shared folders: what operators leave there, and what a ``scratch`` block takes away."""

from pathlib import Path

import pytest

from kiln.llm.common import drop, scratch, shared_dir, stored
from kiln.llm.ngram_join import ngram_classes


def shared(spark):
    return Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))


def folders(spark):
    return set(shared(spark).glob("kiln-*"))


def test_drop_and_scratch(spark):
    outer = shared_dir(spark)
    before = folders(spark)
    with scratch(spark):
        kept = stored(stored(spark.range(5), "inner").where("id > 1"), "kept", outer)
        assert len(folders(spark) - before) == 2
        with pytest.raises(KeyError), scratch(spark):
            stored(spark.range(3), "raised")
            raise KeyError
        assert len(folders(spark) - before) == 2
    assert folders(spark) - before == {Path(outer.removeprefix("file://"))}
    assert kept.count() == 3
    drop(spark, outer, "kept", "never-written")
    assert not Path(f"{outer.removeprefix('file://')}/kept").exists()


def test_join_leaves_only_what_its_result_reads(spark):
    before = folders(spark)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words)) for i in range(3)] + [(9, " ".join(words[:-1] + ["x"])), (10, "a b"), (11, None)]
    got = ngram_classes(spark.createDataFrame(rows, "doc_id long, text string"), k=3, num=80, den=100)
    (folder,) = folders(spark) - before
    assert {p.name for p in folder.iterdir()} == {"facts", "all"}
    assert len(list((folder / "all").iterdir())) == 1
    assert {r.doc_id: r.component_id for r in got.collect()} == {0: 0, 1: 0, 2: 0, 9: 0, 10: 10, 11: 11}
