"""Base spans against the plain patterns, and what the field adds."""

import hashlib
import itertools
import random
import re
import time
import tracemalloc

import numpy as np

from kiln.llm import pii

PLAIN = {
    0: re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), 1: re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    2: re.compile(r"[0-9]([\x20-]?[0-9])+"), 3: re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain(text):
    out = []
    for k, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {0: True, 1: k == 1 and all(int(p) <= 255 for p in m[0].split(".")), 2: 14 <= len(digits) <= 19 and pii.luhn(digits), 3: 10 <= len(digits) <= 15}[k]
            out += [(m.start(), k, m.end())] * good
    return sorted(out)


CASES = ["", "a@b", "x.y@z.co.uk, a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (555) 123-4567 and +12345", "é\U0001f600 me@host.org", "@@a@b.c@d.e", "12+34 5.6", "..@a.b a%+b@c-d.e.", "٣٤٥ ²³ 1"]


def test_base_is_the_plain_patterns():
    rng = random.Random(3)
    texts = CASES + ["".join(rng.choice("a1@.+- (9é\n4") for _ in range(80)) for _ in range(3000)]
    for t in texts:
        assert pii.base_spans(t) == plain(t), t


def test_long_runs_take_linear_time():
    began = time.time()
    for t in ("a" * 300_000 + " x@y", "1" * 300_000, "@" * 100_000, "a1" * 200_000, "+1" + " " * 300_000):
        pii.tag(t, None)
        pii.nodes(t)
    assert time.time() - began < 20


def corpus(rng):
    words = ["and", "of", "house", "tree", "call", "me", "room", "12", "3", "1999"]
    phone = f"+1{rng.randrange(10**9, 10**10)}"
    text = [rng.choice(words) for _ in range(40)]
    text[5], text[20] = phone, f"u{rng.randrange(99)}@host.com"
    return " ".join(text), phone


def test_field_links_repeated_numbers(spark):
    rng = random.Random(1)
    made = [corpus(rng) for _ in range(200)]
    df = spark.createDataFrame([(i, t, 2) for i, (t, _) in enumerate(made)], "doc_id long, text string, hash int")
    field = pii.fit(df)
    text, phone = made[0]
    base, both = pii.tag(f"{text} later {phone[1:]} and 1999 again", field)
    assert set(base) < set(both) and [x[1] for x in both if x not in base] == [3]
    assert pii.tag("room 12 in 1999, 3 trees and 48151623 more", field) == ([], [])
    rows = pii.find(spark.createDataFrame([(1, t) for t in CASES] + [(None, None)], "doc_id long, text string"), field, ["doc_id"]).collect()
    assert len(rows) == len(CASES) + 1 and [len(r.pii_base) for r in rows][:2] == [0, 0]
    out = pii.mask(spark.createDataFrame([(1, "to a@b.co now", 13), (2, None, None)], "doc_id long, text string, n_chars long"), field).collect()
    assert out[0].text == "to [EMAIL] now" and out[0].n_chars == 14 and out[1].text is None


def test_query_and_edges(spark, tmp_path):
    spark.createDataFrame([(i, t, 1) for i, t in enumerate(CASES)] + [(99, None, 1)], "doc_id long, text string, start int").write.parquet(str(tmp_path / "documents.parquet"))
    for r in pii.op8_pii(spark, str(tmp_path)).collect():
        spans = plain(CASES[r.doc_id] if r.doc_id != 99 else "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
        assert r.n_email == sum(k == 0 for _, k, _ in spans)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.fit(empty) is None and pii.find(empty, None, ["doc_id"]).count() == 0


def some_field(rng):
    made = [corpus(rng)[0] for _ in range(60)]
    x, y, pairs = [], [], np.zeros((2, 5, 5))
    for t in made:
        found = pii.nodes(t)
        known = pii.labels(found, pii.base_spans(t))
        x += [pii.shape(n) for n in found]
        y += known.tolist()
        for table, e in zip(pairs, pii.edges(found, known), strict=True):
            np.add.at(table, (known[e[:, 0]], known[e[:, 1]]), 1)
    return pii.fit_field(np.array(x), np.array(y), *pairs)


def test_beliefs_are_exact_without_loops():
    field = some_field(random.Random(2))
    found = pii.nodes("call 4111111111111111 then 17 and x1 x2 far " + "away " * 30 + "4111111111111111 or 40")
    known = np.zeros(len(found), np.int64)
    chain, skip = pii.edges(found, known)
    assert len(skip) == 1 and len(chain) + len(skip) < len(found)  # a tree
    unary = np.stack([pii.shape(n) for n in found]) @ field.weights
    want = np.zeros((len(found), 5))
    for one in itertools.product(range(5), repeat=len(found)):
        one = np.array(one)
        e = sum(unary[i, v] for i, v in enumerate(one)) + field.chain[one[chain[:, 0]], one[chain[:, 1]]].sum() + field.skip[one[skip[:, 0]], one[skip[:, 1]]].sum()
        want[np.arange(len(found)), one] += np.exp(e)
    want /= want.sum(1, keepdims=True)
    assert np.abs(field.beliefs(found, known) - want).max() < 5e-3


def test_every_mention_of_a_number_is_found():
    field = some_field(random.Random(2))
    bare = " and then ".join(["room 12 is free, ask 5557654321"] * 30)
    base, both = pii.tag(f"{bare}. Write to +15557654321 or +1 555 765 4321 or 15557654321.", field)
    assert sum(1 for s in both if s not in base) >= 1
    text = "first +15557654321 " + "then 15557654321 for a while " * 25
    base, both = pii.tag(text, field)
    assert len(base) == 1 and len(both) == 26


def test_long_text_with_a_field_is_bounded():
    field = some_field(random.Random(2))
    text = " ".join(f"w{i % 5000}x a" for i in range(100_000))
    tracemalloc.start()
    began = time.time()
    pii.tag(text, field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert time.time() - began < 60 and peak < 150 << 20


def test_fit_takes_equal_rows_once(spark, monkeypatch):
    rows = spark.createDataFrame([(None, "call +15551234567 now")] * 500 + [(i, f"no {i} here") for i in range(20)], "doc_id long, text string")
    sizes = []
    monkeypatch.setattr(pii, "fit_field", lambda x, y, chain, skip: sizes.append(len(y)))
    pii.fit(rows)
    assert sizes == [21]


def test_added_spans_are_whole_and_valid():
    field = some_field(random.Random(2))
    pieces = "+15557654321 is theirs, and later +1 (555) 765-4321 98765432101234567 stands there"
    assert pii.holds(3, "+1 (555) 765-4321") and pii.base_spans(pieces) == [(0, 3, 12)]
    base, both = pii.tag(pieces, field)
    assert all(pii.holds(k, pieces[s:e]) for s, k, e in both if (s, k, e) not in base)
    # A number that fails its check digit isn't a card, however often it stands there.
    text = " and ".join(["5927243074273351"] * 9)
    assert pii.tag(text, field)[1] == [] and len(pii.edges(pii.nodes(text), np.zeros(9, np.int64))[1]) == 0
    assert len(pii.edges(pii.nodes(" x ".join(["4111111111111111"] * 9)), np.zeros(9, np.int64))[1]) == 8


class Sure:
    """A field that takes every node for one kind."""

    def __init__(self, kind):
        self.kind = kind

    def beliefs(self, found, known):
        return np.eye(5)[[self.kind] * len(found)]


def test_runs_against_trying_all_parts():
    rng = random.Random(11)
    for _ in range(300):
        text = " ".join(rng.choice(["+1", "(826", "555-4081", "12", "4111", "1111", "1.2.3.4", "x9", "and", "999.1.1.1"]) for _ in range(10))
        for kind in range(4):
            found, known = pii.nodes(text), np.zeros(20, np.int64)
            got = pii.added(text, found, known[: len(found)], Sure(kind + 1))
            want, i = [], 0
            while i < len(found):
                ends = [j for j in range(i, len(found)) if pii.holds(kind, text[found[i].start : found[j].end]) and all(re.fullmatch("[ ().,-]{1,3}", text[found[k].end : found[k + 1].start]) for k in range(i, j))]
                if ends:
                    want.append((found[i].start, kind, found[ends[-1]].end))
                i = ends[-1] + 1 if ends else i + 1
            assert got == want, (text, kind)


def test_octets():
    assert pii.octets("1.2.3.255") and pii.octets("001.2.3.4") and not any(map(pii.octets, ("1.2.3", "1.2.3.256", "1..2.3", "1.2.3.4.5", "a.b.c.d", "1.2.3.٣")))


def test_what_is_hidden_is_found_again(spark):
    rng = random.Random(5)
    made = []
    for i in range(150):
        text, phone = corpus(rng)
        made.append(f"{text}. Once more {phone} for {i}")
    field = pii.fit(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"))
    away, again, added, right = np.sum([pii.hidden(t, field) for t in made], 0)
    assert away > 90 and again / away > 0.95 and right / added > 0.95
