"""I-Match rows against a brute-force version of the edit, the order and the band."""

import hashlib
import math
import random
import re
from collections import Counter

import xxhash

from kiln.llm import imatch


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed % (1 << 64))


def words(text):
    return {w for w in re.split(r"[^\w]|_", text.lower()) if len(w) > 1}


def level_of(t, k):
    h = xx(k.to_bytes(4, "little"), xx(t.to_bytes(8, "little")))
    return next((i for i in range(15) if h >> i & 1), 15)


def plain_fingerprint(text, lexicon):
    kept = sorted(signed(xx(w.encode())) for w in words(text) & lexicon)
    if not kept:
        return "x." + hashlib.sha256(str(signed(xx(text.encode()))).encode()).hexdigest()
    level = min(imatch.MAX_LEVEL, math.floor(math.log2(len(kept) / imatch.LOAD)))
    parts = [f"{level:x}"]
    for now in (level, level + 1):
        for k in range(imatch.SUBSETS):
            own = [t for t in kept if level_of(t % 2**64, k) >= now]
            seed = 42
            for t in own:
                seed = xx(t.to_bytes(8, "little", signed=True), seed)
            parts.append(f"{xx(now.to_bytes(4, 'little'), xx(k.to_bytes(4, 'little'), seed)):016x}" if own else imatch.NO_TERM)
    return ".".join(parts)


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if "x" in a[0] + b[0]:
        return 0.0
    x, y = a.split("."), b.split(".")
    levels = [{int(p[0], 16) + i: p[1 + i * imatch.SUBSETS : 1 + (i + 1) * imatch.SUBSETS] for i in range(2)} for p in (x, y)]
    pairs = [(u, v) for l in set(levels[0]) & set(levels[1]) for u, v in zip(levels[0][l], levels[1][l], strict=True) if (u, v) != (imatch.NO_TERM, imatch.NO_TERM)]
    return sum(u == v for u, v in pairs) / len(pairs) if pairs else 0.0


def test_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(imatch, "ROWS_A_RANGE", 7)
    rng = random.Random(5)
    vocab = [f"w{chr(97 + i % 26)}{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(500, texts[0]), (501, ""), (502, None), (503, "é\U0001f600" * 7), (None, "null id")]
    spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, pos int").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in imatch.op6_imatch(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    many = Counter(w for _, t in rows for w in words(t or ""))
    lexicon = {w for w, n in many.items() if max(2, 0.002 * len(rows)) <= n <= max(2, 0.1 * len(rows))}
    assert len(lexicon) > 50
    for k, (doc, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[doc].fingerprint == plain_fingerprint(text, lexicon) and got[doc].edited_fingerprint == plain_fingerprint(edited, lexicon)
        assert got[doc].near_edited == plain_likeness(got[doc].fingerprint, got[doc].edited_fingerprint)
        assert got[doc].near_next == plain_likeness(got[doc].fingerprint, plain_fingerprint(after, lexicon))
        if edited == text:
            assert got[doc].near_edited == 1
    assert got[0].fingerprint == got[500].fingerprint and got[501].fingerprint == got[502].fingerprint


def test_band(spark):
    rows = [("common rare%d mid%d" % (i, i % 10),) for i in range(100)]
    df = spark.createDataFrame(rows, "text string")
    lex = {r.t for r in imatch.lexicon(df, 0.05, 0.5).collect()}
    want = {r.t for r in spark.createDataFrame([(f"mid{i}",) for i in range(10)], "x string").select(imatch.F.xxhash64("x").alias("t")).collect()}
    assert lex == want


def test_likeness_and_empty(spark):
    a, b, n = "0" * 16, "1" * 16, imatch.NO_TERM
    fill = lambda level, first, second: ".".join([level, first, *[n] * (imatch.SUBSETS - 1), second, *[n] * (imatch.SUBSETS - 1)])
    rows = [(fill("1", a, n), fill("1", a, n), 1.0), (fill("1", a, b), fill("1", a, a), 0.5), (fill("1", b, a), fill("2", a, n), 1.0), (fill("2", a, n), fill("1", b, a), 1.0), (fill("2", a, n), fill("1", a, b), 0.0), (fill("1", a, n), fill("3", a, n), 0.0), (f"x.{a}", f"x.{a}", 1.0), (f"x.{a}", f"x.{b}", 0.0), (f"x.{a}", fill("0", a, n), 0.0), (fill("e", a, n), fill("d", n, a), 1.0)]
    df = spark.createDataFrame(rows, "x string, y string, want double")
    assert all(r.got == r.want == plain_likeness(r.x, r.y) for r in df.select("*", imatch.likeness(imatch.F.col("x"), imatch.F.col("y")).alias("got")).collect())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert imatch.with_next(empty).count() == 0 and re.fullmatch("-+", n)


def test_a_replaced_third_leaves_likeness(spark, tmp_path):
    rng = random.Random(4)
    vocab = [f"t{chr(97 + i % 26)}{i}" for i in range(30_000)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(int(10 ** rng.uniform(1.5, 3.6))))) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = imatch.op6_imatch(spark, str(tmp_path)).collect()
    assert sum(r.near_edited == 0 for r in got) < 0.03 * len(got) and sum(r.near_edited > r.near_next for r in got) > 0.95 * len(got)


def test_order_with_hot_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(imatch, "ROWS_A_RANGE", 10)
    rows = [(i, f"t{i}") for i in range(-50, 100)] + [(7, f"hot {i}") for i in range(150)] + [(None, f"none {i}") for i in range(80)] + [(2**63 - 1, "top"), (-(2**63), "bottom"), (30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = imatch.with_next(docs).collect()
    assert len(got) == len(rows)
    by_pos = {r.pos: r for r in got}
    assert len(by_pos) == len(rows) and all(by_pos[r.next_pos].text == r.next_text for r in got)
    ordered = sorted(got, key=lambda r: r.pos)
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda x: (x is None, -(x or 0)))
    assert all(a.next_pos == b.pos for a, b in zip(ordered, [*ordered[1:], ordered[0]], strict=True))
    assert max(Counter(r.range for r in got).values()) <= 40
    assert len({r.range for r in got if r.doc_id == 7}) > 5 and len({r.range for r in got if r.doc_id is None}) > 5


def test_long_text_and_empty_table_through_the_query(spark, tmp_path):
    long = " ".join(f"term{i % 5000}" for i in range(150_000))
    rows = [(1, long), (2, long), (3, "few words here"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "a" / "documents.parquet"))
    got = {r.doc_id: r for r in imatch.op6_imatch(spark, str(tmp_path / "a")).collect()}
    assert got[1].n_chars == len(long) and got[1].fingerprint == got[2].fingerprint and len(got) == 4
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert imatch.op6_imatch(spark, str(tmp_path / "b")).collect() == []
