"""Line dedup across documents: two Bloom filters find suspected repeats, only those are shuffled.

A first pass turns every long line into a 128-bit digest of its key and stores the digests, 16 bytes a line. Each task over them
then keeps two Bloom filters, of digests seen once and of digests seen twice; the filters of all tasks are merged as
``twice = twice1 | twice2 | (once1 & once2)`` and ``once = once1 | once2``, so no repeat is missed. Digests in the merged filter of the
twice-seen are suspected repeats (a few unique ones slip in), and only these are shuffled, with their documents: counts per digest
confirm what does repeat, and choose the document that keeps it. A last pass drops the confirmed lines.

The filters have 8 to 16 bits a digest, up to the second of ``BITS``, which larger executors may raise. Beyond that the digests are dealt into slices of the hash space, stored by
slice, and each slice has its own filters, so that memory stays bounded and the share of false suspects stays the same at any size.

Defined results: null or empty text is one empty line; lines are cut at ``\\n`` alone; equal ids are one document when repeats are counted, and
each of their rows keeps its lines or loses them alike; null ids are one document, which keeps a line only if no other has it; equal rows
are kept as rows; an empty table gives an empty one; input columns may have any names but those added, which raise ValueError.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .arrow import check_names, slices
from .common import drop, shared_dir, ship, stored, table

#: What is stripped at both ends of a line for its key.
STRIP = " \t\n\v\f\r"
#: Bits of a filter, at least and at most (32 MB; a task has two).
BITS = (1 << 12, 1 << 28)
#: Filter words of 64 bits that travel as one row.
CHUNK = 256
#: Digests that a task of a filter takes at least, so that the filters which tasks hand on stay few; slices that are worked on at once.
DIGESTS_A_TASK, SLICES_AT_ONCE = 1_000_000, 4
#: So many confirmed lines are broadcast (24 bytes each); more are joined by a shuffle.
MAX_BROADCAST_LINES = 1_000_000
ADDED = ("n_lines", "n_dropped", "kept")


def digests(text: str, min_chars: int) -> list[bytes | None]:
    """Per line the digest of its key, None for short ones. The key is the stripped line with A-Z lowered."""
    out = []
    for line in text.split("\n"):
        s = line.strip(STRIP) if len(line) >= min_chars else ""
        out.append(xxhash.xxh3_128_digest(s.encode().lower()) if len(s) >= min_chars else None)
    return out


def _halves(keys: bytes) -> np.ndarray:
    return np.frombuffer(keys, "<u8").reshape(-1, 2)


def _facts(docs: DataFrame, min_chars: int) -> DataFrame:
    """id, hash of the text, and the distinct digests of its long lines in one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            keys = [b"".join({k for k in digests(t, min_chars) if k}) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text_hash"), pa.array(keys, pa.binary())], names=["doc", "text_hash", "keys"])

    return docs.mapInArrow(run, "doc long, text_hash long, keys binary").where("length(keys) > 0")


def _sliced(facts: DataFrame, n: int) -> DataFrame:
    """A row per document and slice of the hash space that it has digests in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text_hash, keys in zip(*(batch.column(c).to_pylist() for c in ("doc", "text_hash", "keys")), strict=True):
                pairs = _halves(keys)
                at = (pairs[:, 1] >> np.uint64(40)) % np.uint64(n)
                rows += [(doc, text_hash, pairs[at == s].tobytes(), int(s)) for s in np.unique(at)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.int32()), strict=True)], names=["doc", "text_hash", "keys", "slice"])

    return facts.mapInArrow(run, "doc long, text_hash long, keys binary, slice int")


def places(pairs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter word of each digest, and its four bits there."""
    word = (pairs[:, 0] >> np.uint64(64 - (bits.bit_length() - 7))).astype(np.int64)
    mask = np.zeros(len(pairs), np.uint64)
    for k in range(4):
        mask |= np.uint64(1) << ((pairs[:, 1] >> np.uint64(6 * k)) & np.uint64(63))
    return word, mask


class Filters:
    """Digests seen in one document, and in two or more; neither forgets."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once, self.twice = np.zeros(bits // 64, np.uint64), np.zeros(bits // 64, np.uint64)

    def add(self, pairs: np.ndarray) -> None:
        """``pairs``: digests of any number of documents, each once a document."""
        _, first, many = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        word, mask = places(pairs[first], self.bits)
        again = (many > 1) | (self.once[word] & mask == mask)
        np.bitwise_or.at(self.twice, word[again], mask[again])
        np.bitwise_or.at(self.once, word, mask)

    def merge(self, once: np.ndarray, twice: np.ndarray, at: slice = slice(None)) -> None:
        self.twice[at] |= twice | (self.once[at] & once)
        self.once[at] |= once


def _seen_twice(facts: DataFrame, bits: int, n: int) -> np.ndarray:
    """The merged filter of about ``n`` twice-seen digests: ``bits`` bits, whatever the size of the corpus."""
    width = min(CHUNK, bits // 64)
    schema = "chunk int, once binary, twice binary"

    def rows(chunks: dict[int, Filters]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.int32()), pa.array([c.once.tobytes() for c in chunks.values()], pa.binary()), pa.array([c.twice.tobytes() for c in chunks.values()], pa.binary())], names=["chunk", "once", "twice"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(bits)
        for batch in batches:
            own.add(_halves(b"".join(batch.column("keys").to_pylist())))
        once, twice = own.once.reshape(-1, width), own.twice.reshape(-1, width)
        some = np.flatnonzero(once.any(1))
        for a in range(0, len(some), 4096):
            at = some[a : a + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([once[i].tobytes() for i in at], pa.binary()), pa.array([twice[i].tobytes() for i in at], pa.binary())], names=["chunk", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Filters] = {}
        for batch in batches:
            for chunk, once, twice in zip(*(batch.column(c).to_pylist() for c in ("chunk", "once", "twice")), strict=True):
                held.setdefault(chunk, Filters(64 * width)).merge(np.frombuffer(once, np.uint64), np.frombuffer(twice, np.uint64))
        yield rows({k: f for k, f in held.items() if f.twice.any()})

    out = np.zeros((bits // 64 // width, width), np.uint64)
    parts = max(1, min(64, len(out) // 16))
    tasks = max(1, n // DIGESTS_A_TASK)
    for r in facts.select("keys").coalesce(tasks).mapInArrow(build, schema).repartition(parts, "chunk").mapInArrow(merge, schema).select("chunk", "twice").toLocalIterator():
        out[r.chunk] = np.frombuffer(r.twice, np.uint64)
    return out.ravel()


def _suspects(facts: DataFrame, twice: np.ndarray, bits: int) -> DataFrame:
    shared = facts.sparkSession.sparkContext.broadcast(twice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for batch in batches:
            keys = batch.column("keys").to_pylist()
            pairs, owner = _halves(b"".join(keys)), np.repeat(np.arange(len(keys)), [len(k) // 16 for k in keys])
            word, mask = places(pairs, bits)
            hit = seen[word] & mask == mask
            owner = pa.array(owner[hit])
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in pairs[hit]], pa.binary()), batch.column("doc").take(owner), batch.column("text_hash").take(owner)], names=["key", "doc", "text_hash"])

    return facts.select("doc", "text_hash", "keys").mapInArrow(run, "key binary, doc long, text_hash long")


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """(suspects(key, doc, text_hash), confirmed(key, last)), both stored; ``docs(doc, text, text_hash)``."""
    spark = docs.sparkSession
    facts = stored(_facts(docs, min_chars), "facts", folder)
    n = facts.agg(F.coalesce(F.sum(F.length("keys")), F.lit(0))).first()[0] // 16
    bits = min(BITS[1], max(BITS[0], 1 << (8 * n - 1).bit_length() if n else 0))
    count = max(1, -(-8 * n // bits))
    parts = [facts]
    if count > 1:
        _sliced(facts, count).write.partitionBy("slice").parquet(f"{folder}/slices")
        every = spark.read.schema("doc long, text_hash long, keys binary, slice int").parquet(f"{folder}/slices")
        parts = [every.where(F.col("slice") == s) for s in range(count)]

    def one(s: int) -> None:
        stored(_suspects(parts[s], _seen_twice(parts[s], bits, n // count), bits), f"suspects/{s}", folder)

    with ThreadPoolExecutor(SLICES_AT_ONCE) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(one), s) for s in range(count)]:
            done.result()
    suspects = spark.read.schema("key binary, doc long, text_hash long").option("recursiveFileLookup", True).parquet(f"{folder}/suspects")
    counts = suspects.groupBy("key", "doc").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last"))
    confirmed = stored(counts.where(F.col("docs") >= min_docs).select("key", "last"), "confirmed", folder)
    drop(spark, folder, "facts", "slices")
    return suspects, confirmed


def _rewritten(rows: DataFrame, schema: StructType, min_chars: int, gone: Callable[[pa.RecordBatch], Callable[[int, list[bytes | None]], list[bool]]], text: str) -> DataFrame:
    """The columns of ``rows`` that ``schema`` names, and what is left of the text. ``gone(batch)(i, digests)``: which lines of row i go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            which = gone(batch)
            lines, dropped, kept = [], [], []
            for i, t in enumerate(texts):
                some = digests(t, min_chars)
                go = which(i, some)
                n = sum(go)
                lines.append(len(go))
                dropped.append(n)
                kept.append("\n".join([x for x, g in zip(t.split("\n"), go, strict=True) if not g]) if n else t)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in schema.names[:-3]), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """All columns of ``docs`` with ``n_lines``, ``n_dropped`` and ``kept``, the text without its repeated lines.

    A line whose key has at least ``min_chars`` code points and stands in at least ``min_docs`` documents stays in the one with the largest id alone.
    """
    check_names(docs, docs.columns, list(ADDED))
    if min_docs < 2:
        raise ValueError("a line repeats from two documents on")
    spark = docs.sparkSession
    ship(spark)
    folder = shared_dir(spark)
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc, body = names[docs.columns.index(doc_id)], names[docs.columns.index(text)]
    rows = docs.toDF(*names)
    known = rows.select(F.col(doc).cast("long").alias("doc"), F.col(body).alias("text"), F.xxhash64(body).alias("text_hash"))
    suspects, confirmed = repeated_lines(known, min_chars, min_docs, folder)
    schema = StructType([*rows.schema.fields, *(StructField(c, LongType()) for c in ADDED[:2]), StructField(ADDED[2], StringType())])

    if confirmed.count() <= MAX_BROADCAST_LINES:
        found = confirmed.select("key", "last").toArrow()
        pairs = _halves(b"".join(found.column("key").to_pylist()))
        order = np.argsort(pairs[:, 0], kind="stable")
        last = found.column("last")
        known_last = spark.sparkContext.broadcast((pairs[order], last.fill_null(0).to_numpy()[order], last.is_null().to_numpy()[order]))

        def gone(batch: pa.RecordBatch) -> Callable[[int, list[bytes | None]], list[bool]]:
            pairs, last, none = known_last.value
            ids = batch.column(doc).to_pylist()

            def which(i: int, some: list[bytes | None]) -> list[bool]:
                go = [False] * len(some)
                at = [k for k, d in enumerate(some) if d]
                if at and len(pairs):
                    asked = _halves(b"".join([some[k] for k in at]))
                    left = np.searchsorted(pairs[:, 0], asked[:, 0])
                    while True:  # digests with equal first halves stand side by side
                        here = np.minimum(left, len(pairs) - 1)
                        on = (left < len(pairs)) & (pairs[here, 0] == asked[:, 0]) & (pairs[here, 1] != asked[:, 1])
                        if not on.any():
                            break
                        left = left + on
                    hit = (left < len(pairs)) & (pairs[here] == asked).all(1)
                    other = ~none[here] if ids[i] is None else none[here] | (last[here] != ids[i])
                    for k, g in zip(at, hit & other, strict=True):
                        go[k] = bool(g)
                return go

            return which

        out = _rewritten(rows, schema, min_chars, gone, body)
    else:
        drops = suspects.join(confirmed, "key").where(~F.col("doc").eqNullSafe(F.col("last")))
        drops = drops.groupBy("doc", "text_hash").agg(F.collect_set("key").alias("gone_keys"))  # those of one text
        same = F.col(doc).cast("long").eqNullSafe(F.col("doc")) & (F.xxhash64(body) == F.col("text_hash"))

        def gone(batch: pa.RecordBatch) -> Callable[[int, list[bytes | None]], list[bool]]:
            keys = [set(x or ()) for x in batch.column("gone_keys").to_pylist()]
            return lambda i, some: [d in keys[i] for d in some]

        out = _rewritten(rows.join(drops, same, "left").drop("doc", "text_hash"), schema, min_chars, gone, body)
    return out.toDF(*docs.columns, *ADDED)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
split AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
repeats AS (
  SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5),
marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.last AS gone
  FROM keyed k LEFT JOIN repeats r ON k.key = r.key)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""
