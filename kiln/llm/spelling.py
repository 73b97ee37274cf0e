"""Spelling variants: PartEnum signatures of letter multisets, joined by equality and verified.

A word's letters are a binary vector with a dimension for each (letter, occurrence). One inserted or deleted code point changes
one dimension, a replaced one changes two. PartEnum (``part_enum``) turns "at most k dimensions differ" into equality: dimensions are dealt
into ``n1`` groups, of which one differs in at most k / n1 of them; within each group they are dealt into parts, and every choice
that leaves out as many parts as may differ is one signature. Vectors within the distance share a signature, whatever the words.

Letters alone would tie up all anagrams, so a signature also carries what one edit must leave alone: the longer word's length, and the
first or the last half of the word (an edit in one half can't touch the other). Words of equal length meet under k = 2; a word and one
that is a code point longer meet under k = 1. An equi-join of signatures gives candidates, which ``levenshtein`` verifies in the same stage.

A word's form is its near word of largest count, if that is at least twice its own, so counts double along a chain of forms, and roots
follow in a few rounds of pointer doubling.

Defined results: null or empty text has no words; a null id counts as the empty string in the deletion rule; equal rows count each; words are
compared by code points; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import segments, slices
from .common import drop, shared_dir, ship, stored, table

LETTER = r"[A-Za-zÀ-ÿ]"
MIN_CHARS, MIN_COUNT, DELETE_EVERY = 5, 3, 97
#: Distinct words that a task holds before it hands their counts on.
HELD_WORDS = 200_000
#: (k, n1, parts) for words of equal length, and for those a code point apart.
EQUAL, LONGER = (2, 1, 4), (1, 1, 3)


def thinned(run: str, doc: bytes) -> str:
    """``run`` as document ``doc`` (its id and a colon) holds it: in one of DELETE_EVERY a code point is missing."""
    h = zlib.crc32(run.encode(), zlib.crc32(doc))
    if h % DELETE_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the words of ``docs(doc_id, text)`` after the deletion rule, A-Z lowered, of at least so many code points and occurrences."""
    ship(docs.sparkSession)
    runs = regex.compile(f"{LETTER}{{{min_chars},}}")  # shorter ones stay too short

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch, texts in slices(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                own: Counter = Counter()
                for _, part in segments(text):
                    own.update(runs.findall(part.encode().lower().decode()))
                mark = f"{'' if doc is None else doc}:".encode()
                for found, n in own.items():
                    word = thinned(found, mark)
                    if len(word) >= min_chars:
                        counts[word] += n
                if len(counts) >= HELD_WORDS:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def dimensions(word: str) -> list[str]:
    """(letter, occurrence) of every code point, sorted."""
    seen: Counter = Counter()
    out = []
    for c in sorted(word):
        out.append(f"{c}{seen[c]}")
        seen[c] += 1
    return out


def part_enum(dims: list[str], k: int, n1: int, parts: int) -> Iterator[str]:
    """Signatures such that two vectors that differ in at most ``k`` dimensions share one."""
    may = k // n1  # of n1 groups, one differs in no more
    dealt: list[list[list[str]]] = [[[] for _ in range(parts)] for _ in range(n1)]
    for d in dims:
        h = zlib.crc32(d.encode())
        dealt[h % n1][h // n1 % parts].append(d)
    for g, group in enumerate(dealt):
        for out in combinations(range(parts), may):
            yield f"{g}{out}" + "".join(d for p, some in enumerate(group) if p not in out for d in some)


def signatures(word: str) -> Iterator[tuple[int, int]]:
    """(role, signature): 0 to meet words of equal length, 1 to meet shorter ones, 2 to meet longer ones."""
    n, dims = len(word), dimensions(word)
    for role, length, half, how in ((0, n, n // 2, EQUAL), (1, n, (n - 1) // 2, LONGER), (2, n + 1, n // 2, LONGER)):
        kind = min(role, 1)
        for letters in part_enum(dims, *how):
            for side, kept in enumerate((word[:half], word[n - half :])):
                yield role, xxhash.xxh64_intdigest(f"{kind},{length},{side},{kept},{letters}".encode()) - (1 << 63)


def near_words(words: DataFrame) -> DataFrame:
    """a, b: every two words of ``words(word)`` that differ by one inserted, deleted or replaced code point, once each way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                some = batch.column("word").slice(start, 2000).to_pylist()
                rows = [(w, role, s) for w in some for role, s in signatures(w)]
                word, role, sig = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(role, pa.int8()), pa.array(sig, pa.int64())], names=["word", "role", "sig"])

    ship(words.sparkSession)
    listed = words.select("word").mapInArrow(run, "word string, role byte, sig long")
    listed = stored(listed, "signatures", folder := shared_dir(words.sparkSession))

    def met(left: int, right: int) -> DataFrame:
        x = listed.where(F.col("role") == left).select(F.col("word").alias("a"), "sig")
        y = listed.where(F.col("role") == right).select(F.col("word").alias("b"), "sig")
        both = x.join(y, "sig")
        both = both.where(F.col("a") < F.col("b")) if left == right else both
        return both.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")

    pairs = stored(met(0, 0).union(met(1, 2)).distinct(), "pairs", folder)
    drop(words.sparkSession, folder, "signatures")
    return pairs.union(pairs.select("b", "a"))


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """word, root of ``forms(word, form)`` by pointer doubling; forms end somewhere, since counts at least double."""
    now, step = stored(forms.select("word", F.col("form").alias("root")), "roots/0", folder), 0
    while True:
        ahead = now.select(F.col("word").alias("w"), F.col("root").alias("next"))
        jumped = now.join(ahead, F.col("root") == F.col("w"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step += 1
        jumped = stored(jumped, f"roots/{step}", folder)
        drop(forms.sparkSession, folder, f"roots/{step - 1}")
        now = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return now


def spelling_groups(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs(doc_id, text)``: see the module."""
    spark = docs.sparkSession
    ship(spark)
    folder = shared_dir(spark)
    words = stored(count_words(docs, min_chars, min_count), "words", folder)
    near = near_words(words)
    counted = near.join(words.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
    best = counted.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("b").alias("form"))).alias("best"))
    placed = words.join(best, words.word == best.a, "left")
    twice = -F.col("best.rank") >= 2 * F.col("n")
    placed = placed.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(twice, F.col("best.form")).alias("form"), F.when(twice, -F.col("best.rank")).alias("form_n"))
    placed = stored(placed, "placed", folder)
    ends = roots(placed.where("form is not null").select("word", "form"), folder)
    return placed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) t(i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zA-Z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
own AS (
  SELECT run, c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS raw
  FROM (SELECT doc_id, run, count(*)::BIGINT AS c FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run)),
hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, (length(raw) // 2)::BIGINT), lambda i: ('0x' || substr(raw, 2 * i + 1, 2))::BIGINT)),
                 lambda s, b: xor(s >> 8, tab[(xor(s, b) & 255) + 1]))) AS h
  FROM own, crc),
thinned AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i) AS head, substr(word, i + 2) AS tail FROM words, unnest(range(0, length(word)::BIGINT)) t(i)),
pairs AS (
  SELECT x.word AS a, y.word AS b, y.n AS bn FROM cut x JOIN cut y ON x.head || '*' || x.tail = y.head || '*' || y.tail AND x.word <> y.word
  UNION SELECT x.word, w.word, w.n FROM cut x JOIN words w ON w.word = x.head || x.tail
  UNION SELECT w.word, x.word, x.n FROM cut x JOIN words w ON w.word = x.head || x.tail),
best AS (SELECT a, count(*)::BIGINT AS n_near, max(bn) AS bn, min_by(b, (-bn, b)) AS b FROM pairs GROUP BY a),
formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN bn >= 2 * n THEN b END AS form, CASE WHEN bn >= 2 * n THEN bn END AS form_n
  FROM words LEFT JOIN best ON word = a),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.at WHERE e.form IS NULL
"""
