"""Each stage against a plain version on a small corpus, and the whole run."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from kiln.llm import bpe, pii, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("the", "an", "or", "ing") for b in ("re", "st", "ea", "nd", "ou", "ti")]
    rows = []
    for i in range(240):
        n = rng.randrange(20, 90)
        w = [rng.choice(words) for _ in range(n)]
        text = " ".join(w).capitalize() + "." if i % 4 else " ".join(x.upper() + "!!" for x in w)
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    rows += [(1000 + r[0], r[1] + " More.", *r[2:]) for r in rows[1:30]] + [rows[1], rows[1]]
    rows += [(2000, rows[2][1] + " mail a.b@c.org now +1 555 123 4567", "en", None, 9), (2001, None, None, "s0", None), (None, "", "en", "s1", 0)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]
    for name, stage in cp.STAGES:
        after_df = cp.stored(stage(spark, docs, folder), name)
        after = [tuple(r) for r in after_df.collect()]
        if name != "token_ids":
            assert after_df.columns == docs.columns
        if name == "quality":
            model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
            want = [r for r in before if model.score(quality.features([r[1] or ""]))[0] >= 0.5]
            assert sorted(after, key=repr) == sorted(want, key=repr)
            assert all(r in after for r in before if r[0] is not None and r[0] < 240 and r[0] % 4) and not any((r[0] or 1) < 240 and r[0] is not None and r[0] % 4 == 0 for r in after)
        elif name == "near_duplicates":
            assert sorted(after, key=repr) == sorted(plain_dedupe(before), key=repr)
        elif name == "personal_data":
            assert len(after) == len(before) and not any(pii.base_spans(r[1] or "") for r in after)
            clean = {r for r in before if not pii.base_spans(r[1] or "")}
            assert clean <= {(*r[:4], x[4]) for r in after for x in before if x[:4] == r[:4]} | {r for r in after}
        elif name == "mix":
            assert set(after) <= set(before)
            size = lambda rows: sum(len((r[1] or "").encode().split()) for r in rows)
            for s, weight in ((s, w) for s, w in zip(("s0", "s1", "s2"), (1, 2, 3), strict=True)):
                have, took = size(r for r in before if r[3] == s), size(r for r in after if r[3] == s)
                total = size(before)
                assert took <= 3 * have and abs(took - min(3 * have, total * weight / 6)) < 0.1 * total  # the null source is small
        else:
            lib = Tokenizer.from_file(bpe.default_path())
            want = []
            for r in before:
                ids = lib.encode(r[1] or "", add_special_tokens=False).ids
                want.append((r[0], r[3], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
            assert sorted(after, key=repr) == sorted(want, key=repr)
        docs, before = after_df, after


def plain_dedupe(rows):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    kept, sets = [], [(r, shingles(r[1])) for r in rows]
    seen = set()
    for i, (r, s) in enumerate(sets):
        if i in seen:
            continue
        group, queue = [], [i]
        seen.add(i)
        while queue:
            j = queue.pop()
            group.append(sets[j][0])
            for k, (_, t) in enumerate(sets):
                both = len(sets[j][1] & t)
                if k not in seen and both and 100 * both >= 80 * (len(sets[j][1]) + len(t) - both):
                    seen.add(k)
                    queue.append(k)
        kept.append(min(group, key=lambda x: (x[0] is None, x[0] or 0)))
    return kept


def test_run_and_empty(spark, folder, tmp_path):
    assert cp.run(spark, folder).columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns(spark, folder):
    names = ["score", "row", "body", "masked", "k_id", "k_hash", "mix_size", "mix_target", "mix_repeats", "mix_copy", "mix_source_size", "src", "turn"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", *(f"-{i} AS `{n}`" for i, n in enumerate(names)))
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, folder), name)
        assert docs.columns[5:] == names and docs.count() > 50
        assert docs.select(*names).distinct().collect() == [tuple(-i for i in range(len(names)))]
