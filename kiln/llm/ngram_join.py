"""N-gram Jaccard join, exact: a size-aware heavy-light join on sets of word shingles.

Equal sets are one node. A set is light up to the size where enumerating subsets costs more than reading lists (``boundary``).

Light: two sets link when they share a subset of the overlap that their sizes ask for. Every light set lists its subsets of
each such size; a subset's sets all link to the smallest of them or not at all, so one hub per subset gives the same components
as all pairs, without a check of sets.

Heavy: shingles get one global order, rare first, and a heavy set goes into the inverted lists of its first few (as many
as a linked set can't miss all of). Within a list, the member in which the shingle comes earliest is the hub; every other
member is checked against it, and what links becomes one component. Then only pairs of one list that lie in different components
remain. In each list the largest component is left aside, and the rest is checked against all members. No pair that might link two
components goes unchecked, and pairs within one are never made.

The rarity order comes from counters of fixed size over all documents. It decides how long lists get, never the
result: any order that all sets share is exact.

Defined results: null or blank text has no shingles, n_shingles 0 and links with nothing; a text shorter than a shingle is one shingle;
equal rows are one class; rows with null doc_id take part and can't name a class unless all its rows are null; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import SLICE, segments, slices
from .common import drop, mix64, shared_dir, stored, table
from .components import components

#: Cost of one entry of an inverted list (its checks included) in enumerated subsets.
LIST_COST = 16
#: Counters for the rarity order: about 16 a document, within these powers of two (64 MB at the most).
SKETCH_BITS = (14, 24)
#: So many document ids are broadcast, at most (8 MB); more are joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000
#: The same for shingles that several sets begin with (16 MB).
MAX_BROADCAST_TOKENS = 2_000_000

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def word_hashes(parts: list[bytes], outside: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word, and the number of its part, over lower-cased texts; ``outside`` has the bytes between words, the line feed among them."""
    raw = b"\n".join(parts)
    data = np.frombuffer(raw, np.uint8)
    inside = ~outside[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = end - start
    first = np.cumsum(n) - n
    at = np.arange(n.sum()) - np.repeat(first, n)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(n.max()), 0x9E3779B97F4A7C15, np.uint64))
        total = np.add.reduceat(_BYTE[data[inside]] * power[at], first)
        hashes = mix64(total + n.astype(np.uint64) * _ODD[0])
    sizes = np.array([len(p) + 1 for p in parts])
    return hashes, np.searchsorted(np.cumsum(sizes), start, side="right")


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """The distinct shingles of ``k`` words of each text as sorted 64-bit hashes."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    held, owners, size = [], [], 0

    def flush() -> None:
        nonlocal held, owners, size
        hashes, part = word_hashes(held)
        cuts = np.searchsorted(part, np.arange(len(held) + 1))
        for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            found[owners[p]].append(hashes[a:b])
        held, owners, size = [], [], 0

    for i, text in enumerate(texts):
        for _, part in segments(text):
            held.append(part.encode().lower())
            owners.append(i)
            size += len(part)
            if size >= SLICE:
                flush()
    if held:
        flush()
    out = []
    with np.errstate(over="ignore"):
        for parts in found:
            w = parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint64)])
            span = min(k, len(w))
            if not span:
                out.append(w)
                continue
            total = np.full(len(w) - span + 1, np.uint64(span))
            for j in range(span):
                total += w[j : len(w) - span + 1 + j] * _ODD[j]
            out.append(np.unique(mix64(total)))
    return out


def required(n: int, m: int, num: int, den: int) -> int:
    """Least overlap o with den * o >= num * (n + m - o)."""
    return -(-num * (n + m) // (num + den))


def least(n: int, num: int, den: int) -> int:
    """Least overlap, and size, of anything that links with a set of ``n``."""
    return -(-num * n // den)


def subsets_of(n: int, low: int, high: int) -> int:
    return sum(comb(n, c) for c in range(low, high + 1))


def boundary(num: int, den: int, list_cost: int = LIST_COST) -> int:
    """Largest size up to which enumerating subsets is the cheaper way for every size."""
    n = 1
    while subsets_of(n, least(n, num, den), n) <= list_cost * (n - least(n, num, den) + 1):
        n += 1
    return n - 1


def set_key(hashes: np.ndarray, salt: int) -> bytes:
    """128 bits that don't depend on order."""
    with np.errstate(over="ignore"):
        a = mix64(hashes ^ _ODD[10]).sum(dtype=np.uint64) + np.uint64(salt) * _ODD[12]
        b = mix64(hashes ^ _ODD[11]).sum(dtype=np.uint64) + np.uint64(salt) * _ODD[13]
    return mix64(np.array([a, b])).tobytes()


def light_keys(hashes: np.ndarray, num: int, den: int, bound: int) -> list[tuple[int, bytes]]:
    """(c, key) of every subset of c shingles, for the overlaps c that a link with a light set may ask for."""
    n = len(hashes)
    out = []
    for c in range(least(n, num, den), min(n, bound) + 1):
        out += [(c, set_key(hashes[list(s)], c)) for s in combinations(range(n), c)]
    return out


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(set_key(hashes, len(hashes)), np.int64).tolist())


FACTS = "doc_id long, text_hash long, n int, node long, node2 long, light array<struct<c:int,key:binary>>, slice int, counts binary"


def _measure(docs: DataFrame, k: int, num: int, den: int, bound: int, bits: int) -> DataFrame:
    """First pass: size, node and subsets of each document; at a task's end its counters, in slices of 2**14."""
    largest = bound * den // num
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("node2", pa.int64()), ("light", pa.list_(pa.struct([("c", pa.int32()), ("key", pa.binary())]))), ("slice", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint32)
        for batch, texts in slices(batches, "text"):
            sets = shingle_sets(texts, k)
            np.add.at(counters, (np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
            keys = [_digest(s) for s in sets]
            light = [[{"c": c, "key": x} for c, x in light_keys(s, num, den, bound)] if 0 < len(s) <= largest else [] for s in sets]
            none = pa.nulls(len(texts), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int32()), pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.int64()), pa.array(light, schema.field("light").type), none, pa.nulls(len(texts), pa.binary())], schema=schema)
        small = np.minimum(counters, 255).astype(np.uint8).reshape(-1, 1 << min(bits, 14))
        some = np.flatnonzero(small.any(1))
        if len(some):
            nulls = [pa.nulls(len(some), schema.field(c).type) for c in ("doc_id", "text_hash", "n", "node", "node2", "light")]
            yield pa.RecordBatch.from_arrays([*nulls, pa.array(some, pa.int32()), pa.array([small[i].tobytes() for i in some], pa.binary())], schema=schema)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, FACTS)


def _rarity(facts: DataFrame, bits: int) -> np.ndarray:
    """The summed counters: 2**bits numbers of four bytes, whatever the size of the corpus."""
    width = 1 << min(bits, 14)
    parts = max(1, min(16, 1 << bits >> 14))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, c in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[i] = sums.get(i, np.zeros(width, np.int64)) + np.frombuffer(c, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(s, 2**32 - 1).astype(np.uint32).tobytes() for s in sums.values()], pa.binary())], names=["slice", "counts"])

    out = np.zeros((1 << bits) // width * width, np.uint32).reshape(-1, width)
    for r in facts.where(F.col("slice").isNotNull()).select("slice", "counts").repartition(parts, "slice").mapInArrow(add, "slice int, counts binary").toLocalIterator():
        out[r.slice] = np.frombuffer(r.counts, np.uint32)
    return out.ravel()


def _prefixes(docs: DataFrame, k: int, num: int, den: int, bound: int, bits: int, rarity: np.ndarray) -> DataFrame:
    """Second pass: the first shingles of each heavy set in the rarity order."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch, texts in slices(batches, "text"):
            rows = []
            for s in shingle_sets(texts, k):
                if len(s) > bound:
                    take = len(s) - least(len(s), num, den) + 1
                    first = np.lexsort((s, order[s >> np.uint64(64 - bits)]))[:take]
                    rows.append((*_digest(s), len(s), s[first].view(np.int64)))
            node, node2, n, tokens = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(node2, pa.int64()), pa.array(n, pa.int32()), pa.array(tokens, pa.list_(pa.int64()))], names=["node", "node2", "n", "tokens"])

    return docs.select("text").mapInArrow(run, "node long, node2 long, n int, tokens array<long>").dropDuplicates(["node", "node2"])


def _sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            sets = shingle_sets(texts, k)
            yield pa.RecordBatch.from_arrays([pa.array([_digest(s)[0] for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"])


def _can_link(a: str, b: str, num: int, den: int) -> Column:
    """By sizes, and by what is left of both after the shared shingle, if it is their first shared one."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos"))
    return (F.least(na, nb) * den >= F.greatest(na, nb) * num) & (rest * (num + den) >= (na + nb) * num)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).where("a <> b").distinct()


def _checked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs that link, by their whole sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared * (num + den) >= (F.size("x") + F.size("y")) * num).select("a", "b")


def ngram_classes(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """A row per row of ``docs(doc_id, text)``: doc_id, text_hash, n_shingles, component_id and ``first`` (the row's doc_id and text_hash are its class's least).

    Two documents link when ``den * |intersection| >= num * |union|`` of their sets of ``k``-word shingles.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark)
    docs = docs.select("doc_id", "text")
    bound = boundary(num, den)
    bits = int(np.clip(int(16 * max(1, docs.count()) - 1).bit_length(), *SKETCH_BITS))
    facts = stored(_measure(docs, k, num, den, bound, bits), "facts", folder)
    rows = facts.where(F.col("slice").isNull())

    subsets = rows.where(F.size("light") > 0).dropDuplicates(["node", "node2"]).select("node", "n", F.explode("light").alias("s")).select("node", "n", "s.c", "s.key")
    hubs = subsets.groupBy("c", "key").agg(F.min(F.struct("n", "node")).alias("hub"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    need = F.ceil((F.col("n") + F.col("hub.n")) * num / (num + den))
    light = subsets.join(hubs, ["c", "key"]).where((need <= F.col("c")) & (F.col("node") != F.col("hub.node"))).select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct()

    prefixes = stored(_prefixes(docs, k, num, den, bound, bits, _rarity(facts, bits)), "prefixes", folder)
    entries = prefixes.select("node", "n", F.posexplode("tokens").alias("pos", "token"))
    several = stored(entries.groupBy("token").agg(F.count(F.lit(1)).alias("length")).where("length > 1").select("token"), "several", folder)
    few = F.broadcast(several) if several.count() <= MAX_BROADCAST_TOKENS else several
    lists = stored(entries.join(few, "token"), "lists", folder)
    drop(spark, folder, "prefixes", "several")
    hub = lists.groupBy("token").agg(F.min(F.struct("pos", "n", "node")).alias("r"))
    first = stored(_pairs(lists.alias("l").join(hub, "token").where(_can_link("l", "r", num, den))), "first", folder)

    owners = rows.groupBy("node", "node2").agg(F.min("doc_id").alias("doc_id"))

    def sets_of(pairs: DataFrame, name: str) -> DataFrame:
        """Whole sets of the nodes in ``pairs``, made again from one document of each."""
        asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ids = stored(owners.join(asked, "node", "left_semi").select(F.col("doc_id").alias("asked")).distinct(), f"{name}-ids", folder)
        few = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
        return stored(_sets(docs.join(few, F.col("doc_id").eqNullSafe(F.col("asked")), "left_semi"), k), f"{name}-sets", folder)

    linked = stored(_checked(first, sets_of(first, "first"), num, den).union(light), "linked", folder)
    drop(spark, folder, "first-ids", "first-sets")
    roots = components(linked, folder, "roots")
    placed = lists.join(roots, "node", "left").select("token", "pos", "n", "node", F.coalesce("root", "node").alias("root"))
    placed = stored(placed, "placed", folder)
    drop(spark, folder, "linked", "lists")
    shares = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("members"))
    mixed = shares.groupBy("token").agg(F.max_by("root", F.struct("members", "root")).alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    mixed = stored(placed.join(mixed, "token"), "mixed", folder)
    drop(spark, folder, "placed")
    rest = mixed.where("root <> main").alias("l").join(mixed.alias("r"), (F.col("l.token") == F.col("r.token")) & (F.col("l.root") != F.col("r.root")) & _can_link("l", "r", num, den))
    second = stored(_pairs(rest).join(first, ["a", "b"], "left_anti"), "second", folder)
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(_checked(second, sets_of(second, "second"), num, den))
    roots = components(links, folder, "all")
    drop(spark, folder, "first", "mixed", "second", "second-ids", "second-sets", "roots")

    # Per node first, so copies meet only in sums that combine before the shuffle.
    nodes = rows.where("n > 0").groupBy("node", "node2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")).alias("least"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # A class whose links are none keeps its own second half, so a clash of 64-bit nodes joins nothing.
    classes = nodes.groupBy("root").agg(F.min("least").alias("head"))
    named = nodes.join(classes, "root").select(F.col("node").alias("d"), F.col("node2").alias("d2"), "head")
    out = rows.join(named, (F.col("node") == F.col("d")) & (F.col("node2") == F.col("d2")), "left")
    return out.select(
        "doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("head.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_hash") == F.col("head.text_hash"))).otherwise(F.lit(True)).alias("first"),
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents"), k=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT rid, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                              ELSE list_transform(range(1, (len(words) - 1)::BIGINT), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS shingle FROM w),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
shared AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.rid <> y.rid GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
reach AS (SELECT rid, rid AS at FROM w UNION SELECT r.rid, l.b FROM reach r JOIN links l ON l.a = r.at)
SELECT any_value(w.doc_id) AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM w LEFT JOIN n USING (rid) JOIN reach r ON r.rid = w.rid JOIN w o ON o.rid = r.at GROUP BY w.rid
"""
