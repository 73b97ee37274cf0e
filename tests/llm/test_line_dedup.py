"""Line dedup against brute force, on all its ways; filters that forget nothing."""

import hashlib
import random
import re

import numpy as np
import pytest

from kiln.llm import line_dedup
from kiln.llm.line_dedup import Filters, dedup_lines, op11_line_dedup, places

WS = " \t\n\v\f\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WS))


def plain(rows, min_chars=40, min_docs=5):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    last = {k: max((d for d in docs if d is not None), default=None) for k, docs in holders.items() if len(docs) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def corpus(seed=3, n=120):
    rng = random.Random(seed)
    shared = [f"Shared line {i} " + "É" * rng.randrange(20, 40) for i in range(30)]
    rows = []
    for d in range(n):
        lines = [rng.choice((f"\t {rng.choice(shared)} \r", rng.choice(shared).upper(), f"own line {d} {rng.random()} that is long enough", "short", "", "x" * 39, "Common footer of nearly every document here")) for _ in range(rng.randrange(12))]
        rows.append((d * 7, "\n".join(lines)))
    rows += [(700_000, None), (700_001, ""), (None, rows[5][1]), (None, rows[6][1]), rows[9], (rows[9][0], rows[10][1]), (-5, "\n\n"), (800_000, "\n".join([shared[0]] * 9))]
    rows.append((900_000, "\n".join(f"long document, line {i % 500} of a text that repeats itself" for i in range(20_000))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def result(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("way", ["broadcast", "shuffle", "slices"])
def test_against_brute_force(spark, monkeypatch, way):
    if way != "broadcast":
        monkeypatch.setattr(line_dedup, "MAX_BROADCAST_LINES", 0)
    if way == "slices":
        monkeypatch.setattr(line_dedup, "BITS", (1 << 9, 1 << 11))
    rows = corpus()
    got = result(dedup_lines(frame(spark, rows)))
    assert got == plain(rows) and sum(r[2] for r in got) > 100
    assert result(dedup_lines(frame(spark, rows), min_chars=3, min_docs=2)) == plain(rows, 3, 2)


def test_exactly_five_documents_and_the_last_one(spark):
    line = "k" * 40
    four, five = [(i, line) for i in range(4)], [(i, f"a\n{line}\nb\n  {line.upper()}") for i in (3, 1, 9, 2, 5)]
    assert all(r[2] == 0 for r in result(dedup_lines(frame(spark, four))))
    assert {r[0]: (r[2], r[3]) for r in result(dedup_lines(frame(spark, five)))} == {i: ((0, five[2][1]) if i == 9 else (2, "a\nb")) for i in (3, 1, 9, 2, 5)}
    same_id = [(1, line)] * 9 + [(2, line)]
    assert all(r[2] == 0 for r in result(dedup_lines(frame(spark, same_id))))


def test_all_lines_go(spark):
    got = result(dedup_lines(frame(spark, [(i, "z" * 50) for i in range(6)])))
    assert [(r[1], r[2], r[3]) for r in got] == [(1, 1, "")] * 5 + [(1, 0, "z" * 50)]


def test_empty_table_and_further_columns(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "x", "a b", 2.5)], "doc_id int, doc string, text string, text_hash double")
    assert dedup_lines(df).collect()[0].asDict() == {"doc_id": 1, "doc": "x", "text": "a b", "text_hash": 2.5, "n_lines": 1, "n_dropped": 0, "kept": "a b"}
    with pytest.raises(ValueError, match="exist already"):
        dedup_lines(df.withColumnRenamed("doc", "Kept"))
    with pytest.raises(ValueError, match="two documents"):
        dedup_lines(df, min_docs=1)


def test_query_over_a_folder(spark, tmp_path):
    rows = corpus(8, 60)
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op11_line_dedup(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(((a, b, c, hashlib.sha256(k.encode()).hexdigest()) for a, b, c, k in plain(rows)), key=repr)


def test_filters_miss_no_repeat():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**64, (4000, 2), np.uint64)
    seen = np.concatenate([keys, keys[:500], keys[100:300]])
    rng.shuffle(seen)
    whole = Filters(1 << 16)
    for part in np.array_split(seen, 7):
        own = Filters(1 << 16)
        for few in np.array_split(part, 3):
            own.add(few)
        whole.merge(own.once, own.twice)
    word, mask = places(keys, 1 << 16)
    hit = whole.twice[word] & mask == mask
    assert hit[:500].all() and hit[500:].mean() < 0.05
    assert (whole.once[word] & mask == mask).all()
