"""Ranked lexical search: hybrid of term-at-a-time accumulators and document-at-a-time skipping.

Two passes over the documents. The first counts documents, terms, and the documents of each asked term; the second ranks. A task gathers
documents in blocks and inverts each block, for the asked terms only. An item's lists of a block are split by length:

* short lists are added up term at a time into accumulators; these then act as one list with one bound;
* long lists are walked over document ranges, those with the largest bound (largest accumulator, plus each long list's largest contribution
  there) first; a range whose bound stays below the item's k-th score is skipped, and within the others the long lists are added by
  falling bound, and a document is left as soon as what is still to come can't lift it to that score.

The k-th score so far is kept from block to block of a task, and starts from the k-th largest accumulator. Scores are whole numbers and
no bound cuts ties, so the result is that of scoring every document. Tasks return k rows an item; a ranked window joins them.

Items are searched in groups of bounded number and text, each with its own two passes, so what is broadcast (the terms asked and
their weights) has a fixed bound. Terms are 64-bit hashes.

Defined results: null text has no terms, and a document without terms counts nowhere; rows with equal ids are ranked each for itself;
null document ids rank last among equal scores; every row of the items is one, null, repeated or equal ids included, and one without terms, or
whose terms no document holds, gets no rows; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrow import SLICE, segments, slices
from .common import shared_dir, ship, stored, table
from .ngram_join import word_hashes

#: Bytes that belong to no term: ASCII other than letters and digits.
_OUTSIDE = np.ones(256, bool)
_OUTSIDE[128:] = _OUTSIDE[48:58] = _OUTSIDE[65:91] = _OUTSIDE[97:123] = False
#: A block of the index ends at so many documents, or postings.
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 2_000_000
#: Documents of a range, for which long lists have bounds.
RANGE = 64
#: Ranges that are walked first.
FIRST_RANGES = 4
#: Share of a block's documents up to which lists, summed from the shortest, count as short.
SHORT = 0.25
#: Items, and characters of their texts, that are searched in one pair of passes.
GROUP_ITEMS, GROUP_CHARS = 10_000, 32 << 20


def term_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all texts as 64-bit hashes, and the number of each one's text."""
    held, owner, size = [], [], 0
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> None:
        nonlocal held, owner, size
        hashes, part = word_hashes(held, _OUTSIDE)
        found.append((hashes, np.array(owner, np.int64)[part]))
        held, owner, size = [], [], 0

    for i, text in enumerate(texts):
        for _, part in segments(text):
            held.append(part.encode().lower())
            owner.append(i)
            size += len(part)
            if size >= SLICE:
                flush()
    if held:
        flush()
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([h for h, _ in found]), np.concatenate([o for _, o in found])


@dataclass
class Query:
    """Items as numbers of terms: item i asks ``terms[starts[i] : starts[i + 1]]``, numbers into ``vocab`` (sorted hashes)."""

    vocab: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    weights: np.ndarray | None = None

    @staticmethod
    def of(texts: list[str]) -> Query:
        hashes, owner = term_hashes(texts)
        vocab, number = np.unique(hashes, return_inverse=True)
        pairs = np.unique(owner * max(1, len(vocab)) + number)  # a term counts once an item
        return Query(vocab, pairs % max(1, len(vocab)), np.searchsorted(pairs, np.arange(len(texts) + 1) * max(1, len(vocab))))

    def asked(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms that are asked, and where they stand in ``hashes``."""
        at = np.searchsorted(self.vocab, hashes)
        hit = np.flatnonzero((at < len(self.vocab)) & (self.vocab[np.minimum(at, len(self.vocab) - 1)] == hashes))
        return at[hit], hit


def postings(query: Query, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (document, term, occurrences) of the asked ones."""
    hashes, owner = term_hashes(texts)
    lengths = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    term, at = query.asked(hashes)
    pairs, tf = np.unique(owner[at] * len(query.vocab) + term, return_counts=True)
    return lengths, pairs // len(query.vocab), pairs % len(query.vocab), tf.astype(np.int64)


def statistics(docs: DataFrame, query: Broadcast) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each asked term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, n, total = query.value, 0, 0
        df = np.zeros(len(q.vocab), np.int64)
        for _, texts in slices(batches, "text"):
            lengths, _, term, _ = postings(q, texts)
            n, total = n + int((lengths > 0).sum()), total + int(lengths.sum())
            df += np.bincount(term, minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2])), pa.array(np.append(df[some], [n, total]))], names=["term", "n"])

    found = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row an asked term
    sums = dict(zip(found.column("term").to_pylist(), found.column("n").to_pylist(), strict=True))
    df = np.zeros(len(query.value.vocab), np.int64)
    for t, n in sums.items():
        if t >= 0:
            df[t] = n
    return sums.get(-1, 0), sums.get(-2, 0), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Best:
    """The k best of each item so far: by score, then least id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * items

    def least(self, item: int) -> int:
        """What a score must reach to get in, at least 1."""
        scores = self.rows[item][0]
        return int(scores[-1]) if len(scores) == self.k else 1

    def offer(self, item: int, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        scores, null, ids = (np.concatenate(x) for x in zip(self.rows[item], (scores, null, ids), strict=True))
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.rows[item] = scores[order], null[order], ids[order]


class Block:
    """The inverted lists of some documents, with each posting's contribution before the weight."""

    def __init__(self, n_terms: int, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray):
        order = np.argsort(term * len(m) + doc, kind="stable")
        self.docs, term = doc[order], term[order]
        tf = tf[order]
        self.gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs])
        self.size = len(m)
        self.starts = np.searchsorted(term, np.arange(n_terms + 1))
        self.cuts = np.arange(0, len(m), RANGE)
        self._bounds: dict[int, np.ndarray] = {}

    def bounds(self, t: int) -> np.ndarray:
        """The largest gain of a list in each range of documents."""
        if t not in self._bounds:
            a, b = self.starts[t], self.starts[t + 1]
            out = np.zeros(len(self.cuts), np.int64)
            np.maximum.at(out, self.docs[a:b] // RANGE, self.gain[a:b])
            self._bounds[t] = out
        return self._bounds[t]

    def search(self, terms: np.ndarray, weight: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that reach ``least``, or the k-th partial sum if that is more, and their scores; those at the limit are among them."""
        length = self.starts[terms + 1] - self.starts[terms]
        use = (length > 0) & (weight > 0)
        order = np.argsort(length[use], kind="stable")
        terms, weight, length = terms[use][order], weight[use][order], length[use][order]
        n_short = int(np.searchsorted(np.cumsum(length), SHORT * self.size, side="right"))

        score = np.zeros(self.size, np.int64)
        for t, w in zip(terms[:n_short].tolist(), weight[:n_short].tolist(), strict=True):
            a, b = self.starts[t], self.starts[t + 1]
            score[self.docs[a:b]] += w * self.gain[a:b]
        if self.size >= k:
            least = max(least, int(np.partition(score, self.size - k)[self.size - k]))
        if n_short == len(terms):
            docs = np.flatnonzero(score >= max(1, least))
            return docs, score[docs]
        bound = np.array([w * self.bounds(t) for t, w in zip(terms[n_short:].tolist(), weight[n_short:].tolist(), strict=True)])
        by = np.argsort(-bound.max(1), kind="stable")
        terms, weight, bound = terms[n_short:][by], weight[n_short:][by], bound[by]
        rest = bound[::-1].cumsum(0)[::-1]  # what this list and those after it can add, by range
        ahead = np.maximum.reduceat(score, self.cuts) + rest[0]
        ranges = np.argsort(-ahead, kind="stable")
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        start = 0
        while start < len(ranges) and ahead[ranges[start]] >= least:
            some = np.sort(ranges[start : start + max(FIRST_RANGES, start)])  # the most promising first, each time as many as before
            at = self._walk(some[ahead[some] >= least], score, terms, weight, rest, least)
            docs, scores = np.concatenate([docs, at]), np.concatenate([scores, score[at]])
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            start += max(FIRST_RANGES, start)
        good = scores >= max(1, least)
        return docs[good], scores[good]

    def _walk(self, ranges: np.ndarray, score: np.ndarray, terms: np.ndarray, weight: np.ndarray, rest: np.ndarray, least: int) -> np.ndarray:
        """Adds the long lists to ``score`` in these ranges; the documents that may reach ``least``."""
        docs = (ranges[:, None] * RANGE + np.arange(RANGE)).ravel()
        docs = docs[docs < self.size]
        docs = docs[score[docs] + rest[0][docs // RANGE] >= least]
        for i, (t, w) in enumerate(zip(terms.tolist(), weight.tolist(), strict=True)):
            if not len(docs):
                break
            a, b = self.starts[t], self.starts[t + 1]
            own = self.docs[a:b]
            at = np.searchsorted(own, docs)  # skips to each document still in question
            hit = (at < len(own)) & (own[np.minimum(at, len(own) - 1)] == docs)
            score[docs[hit]] += w * self.gain[a + at[hit]]
            if i + 1 < len(terms):
                docs = docs[score[docs] + rest[i + 1][docs // RANGE] >= least]
        return docs[score[docs] >= max(1, least)]


def _ranked(docs: DataFrame, query: Broadcast, n_docs: int, total: int, k: int) -> DataFrame:
    """item, doc_id, score: the k best of each item in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = query.value
        best = Best(len(q.starts) - 1, k)
        held: list[tuple[np.ndarray, ...]] = []
        size = n_postings = 0

        def flush() -> None:
            nonlocal size, n_postings
            if held:
                ids, null, lengths, doc, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
                block = Block(len(q.vocab), 100 - 90 + (90 * lengths * n_docs) // total, doc, term, tf)
                for item in range(len(q.starts) - 1):
                    terms = q.terms[q.starts[item] : q.starts[item + 1]]
                    at, scores = block.search(terms, q.weights[terms], k, best.least(item))
                    if len(at):
                        best.offer(item, scores, null[at], ids[at])
            held.clear()
            size = n_postings = 0

        for batch, texts in slices(batches, "text"):
            lengths, doc, term, tf = postings(q, texts)
            ids = batch.column("doc_id")
            held.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), lengths, doc + size, term, tf))
            size, n_postings = size + len(texts), n_postings + len(doc)
            if size >= BLOCK_DOCS or n_postings >= BLOCK_POSTINGS:
                flush()
        flush()
        for item, (scores, null, ids) in enumerate(best.rows):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item)), pa.array(ids, mask=null), pa.array(scores)], names=["item", "doc_id", "score"])

    return docs.mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each row of ``items``; scores as in the module's contract, all in whole numbers."""
    spark = docs.sparkSession
    ship(spark)
    folder = shared_dir(spark)
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text"))
    kind = asked.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    groups = max(1, -(-size.n // GROUP_ITEMS), -(-size.chars // GROUP_CHARS))
    if groups > 1:
        asked = stored(asked.withColumn("group", F.pmod(F.xxhash64("text", F.coalesce(F.col("item_id").cast("string"), F.lit(""))), F.lit(groups))), "items", folder)
    out = []
    for g in range(groups):
        rows = (asked.where(F.col("group") == g) if groups > 1 else asked).select("item_id", "text").collect()  # about GROUP_ITEMS
        texts = list(dict.fromkeys(r.text for r in rows))
        query = Query.of(texts)
        if not len(query.vocab):
            continue
        first = spark.sparkContext.broadcast(query)
        n_docs, total, df = statistics(docs, first)
        if not total:
            break
        query.weights = weights(n_docs, df)
        found = _ranked(docs, spark.sparkContext.broadcast(query), n_docs, total, k)
        order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        number = {t: i for i, t in enumerate(texts)}
        named = spark.createDataFrame([(r.item_id, number[r.text]) for r in rows], f"item_id {kind}, item long")
        out.append(stored(found.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"), f"found/{g}", folder))
    return reduce(DataFrame.union, out) if out else spark.createDataFrame([], schema)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH tokens AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
tf AS (SELECT rid, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf FROM tokens GROUP BY rid, term),
lengths AS (SELECT rid, sum(tf)::BIGINT AS n FROM tf GROUP BY rid),
whole AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM lengths),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
asked AS (
  SELECT DISTINCT iid, item_id, term FROM (
    SELECT iid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS iid, item_id, text FROM benchmark))),
weighed AS (
  SELECT a.iid, a.item_id, a.term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM asked a JOIN df USING (term), whole),
scored AS (
  SELECT w.iid, any_value(w.item_id) AS item_id, t.rid, any_value(t.doc_id) AS doc_id,
         sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 90 + (90 * l.n * nn) // ll))))::BIGINT AS score
  FROM weighed w JOIN tf t USING (term) JOIN lengths l USING (rid), whole GROUP BY w.iid, t.rid)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
