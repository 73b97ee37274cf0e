"""Approximate nearest neighbours by adaptive dimension scan within inverted lists.

Lists: unit vectors go to the nearest of about sqrt(n) centroids, which spherical k-means fits on at most ``SAMPLE`` vectors (those
whose ids hash lowest). Every vector is indexed. A list longer than ``BLOCK`` is dealt over several blocks, a list
asked by more than ``ASKERS`` queries over several groups of queries, so no task holds an unbounded part of either.

How many lists a query probes follows from the sample: as many as hold ``RECALL`` of the sample's own true neighbours.

Scan: in a block, vectors and queries are rotated by one random orthogonal matrix and stored by columns. For
a query, squared distances grow by ``STEP`` columns at a time. The share of the full distance that the columns seen so far stand for is
known up to a random error, so a candidate whose partial distance already speaks against the current
k-th best at ``SURE`` standard errors is given up; columns seen by fewer and fewer candidates are the gain. What is left
to the end is scored on the original vectors in double precision.

Defined results: vectors that are null, zero, hold null or non-finite components, or have another number of
components than most take no part, as queries neither; ties go to the smaller vec_id; with fewer candidates than k all are returned;
rows with a null id take no part; rows that share an id count as one another's own; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop, shared_dir, stored, table

SAMPLE = 20_000
MAX_LISTS = 4096
BLOCK = 2048
ASKERS = 1024
#: Share of true neighbours that the probed lists should hold, as measured on the sample with so many of its vectors as queries.
RECALL = 0.97
CALIBRATE = 400
STEP = 16
SURE = 2.1
SEED = 7


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and embedding (array of double) of the vectors that take part."""
    v = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    sizes = v.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    width = sizes.orderBy(F.desc("n"), "d").first()
    return v.where(F.size("embedding") == width.d) if width else v.limit(0)


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit vectors; empty ones keep their place."""
    rng = np.random.default_rng(SEED)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmax(x @ c.T, 1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norm = np.sqrt((sums * sums).sum(1))
        some = norm > 1e-12
        c[some] = sums[some] / norm[some, None]
    return c


def probes_for(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float) -> int:
    """The fewest lists whose members hold ``recall`` of the sample's own neighbours, by brute force within the sample."""
    own = np.argmax(sample @ centroids.T, 1)
    asks = np.random.default_rng(SEED).permutation(len(sample))[:CALIBRATE]
    place = np.empty((len(asks), len(centroids)), np.int64)
    rank = np.argsort(-(sample[asks] @ centroids.T), 1, kind="stable")
    np.put_along_axis(place, rank, np.arange(len(centroids))[None], 1)
    needed = []
    for row, i in enumerate(asks):
        sim = sample @ sample[i]
        sim[i] = -2
        needed.append(place[row, own[np.argsort(-sim)[: min(k, len(sample) - 1)]]])
    found = np.sort(np.concatenate(needed))
    return int(found[min(len(found) - 1, int(np.ceil(recall * len(found))))]) + 1 if len(found) else 1


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def scan(ids: np.ndarray, x: np.ndarray, query_id: int, q: np.ndarray, columns: np.ndarray, rotated: np.ndarray, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Up to k nearest of a block: ids, cosines. ``columns`` holds the block's rotated unit vectors by columns; ``bound`` is a squared distance."""
    d = len(rotated)
    alive = np.flatnonzero(ids != query_id)
    partial = np.zeros(len(alive))
    for lo in range(0, d, STEP):
        hi = min(lo + STEP, d)
        diff = columns[lo:hi, alive] - rotated[lo:hi, None]
        partial = partial + np.einsum("ij,ij->j", diff, diff)
        if hi < d and len(alive) > k:
            # The scaled partial distance errs by about 1/sqrt(seen); beyond SURE such errors a candidate is out.
            scaled = partial * (d / hi)
            kth = min(bound, np.partition(scaled, k - 1)[k - 1] * (1 + SURE / np.sqrt(hi)))
            keep = scaled <= kth * (1 + SURE / np.sqrt(hi)) ** 2
            alive, partial = alive[keep], partial[keep]
    if len(alive) > k:
        alive = alive[partial <= np.partition(partial, k - 1)[k - 1] + 1e-9]
    rows = x[alive]
    score = np.sum(rows * q, 1) / (np.sqrt(np.sum(rows * rows, 1)) * np.sqrt(np.sum(q * q)))
    best = np.lexsort((ids[alive], -score))[:k]
    return ids[alive][best], score[best]


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_list()).astype(float) if len(col) else np.zeros((0, 0))


def search(vectors: DataFrame, asks: DataFrame, k: int = 5, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score for every row of ``asks`` against every other row of ``vectors`` (both as ``usable`` gives them)."""
    spark = vectors.sparkSession
    folder = shared_dir(spark)
    vectors = stored(vectors, "vectors", folder)
    n = vectors.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    picked = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toPandas()
    sample = _units(_matrix(picked["embedding"]))
    lists = int(max(1, min(MAX_LISTS, len(sample), round(np.sqrt(n)))))
    fitted = kmeans(sample, lists)
    centroids = spark.sparkContext.broadcast(fitted)
    d = sample.shape[1]
    n_probes = probes_for(sample, fitted, k, recall)

    def nearest(many: int):
        def run(parts):
            c = centroids.value
            for part in parts:
                for a in range(0, len(part), 1024):
                    some = part.iloc[a : a + 1024]
                    sim = _units(_matrix(some["embedding"])) @ c.T
                    near = np.argsort(-sim, 1, kind="stable")[:, :many]
                    wide = near.shape[1]
                    yield pd.DataFrame({"vec_id": np.repeat(some["vec_id"].to_numpy(), wide), "embedding": [e for e in some["embedding"] for _ in range(wide)], "list": near.ravel(), "place": np.tile(np.arange(wide), len(some))})

        return run

    indexed = stored(vectors.mapInPandas(nearest(1), "vec_id long, embedding array<double>, list int, place int").drop("place"), "indexed", folder)
    asked = stored(asks.mapInPandas(nearest(n_probes), "vec_id long, embedding array<double>, list int, place int"), "asked", folder)
    drop(spark, folder, "vectors")
    # A row per list: how many blocks and groups of queries it needs.
    sizes = indexed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    groups = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / ASKERS).cast("int").alias("groups"))
    plan = stored(sizes.join(groups, "list"), "plan", folder)
    small = F.broadcast(plan)  # at most MAX_LISTS rows
    deal = lambda count: F.pmod(F.xxhash64("vec_id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = indexed.join(small, "list").select("list", deal("blocks").alias("block"), every("groups").alias("part"), "vec_id", "embedding")
    turn = spark.sparkContext.broadcast(rotation(d))

    def probe(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(queries):
            block = block.sort_values("vec_id", kind="stable")
            x, q = _matrix(block["embedding"]), _matrix(queries["embedding"])
            ids = block["vec_id"].to_numpy()
            columns = np.ascontiguousarray((_units(x) @ turn.value).T)
            rotated = _units(q) @ turn.value
            for i, (query, bound) in enumerate(zip(queries["vec_id"].to_numpy(), queries["bound"].to_numpy(), strict=True)):
                found, score = scan(ids, x, query, q[i], columns, rotated[i], k, bound)
                out.append(pd.DataFrame({"query_id": np.full(len(found), query), "vec_id": found, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})

    keys = ["list", "block", "part"]
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def nearest_in(some: DataFrame) -> DataFrame:
        """The k best of each query in the lists that ``some`` (with a ``bound`` for its squared distances) asks."""
        right = some.join(small, "list").select("list", every("blocks").alias("block"), deal("groups").alias("part"), "vec_id", "embedding", "bound")
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(probe, "query_id long, vec_id long, score double")
        return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # The nearest list gives each query's k-th distance so far, beyond which the other lists' candidates are given up.
    first = stored(nearest_in(asked.where("place = 0").withColumn("bound", F.lit(float("inf")))), "first", folder)
    bounds = first.groupBy(F.col("query_id").alias("b_id")).agg(F.when(F.count(F.lit(1)) == k, 2 - 2 * F.min("score")).otherwise(float("inf")).alias("bound"))
    others = asked.where("place > 0").join(bounds, F.col("vec_id") == F.col("b_id"), "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    both = first.drop("rank").union(nearest_in(others).drop("rank"))
    return both.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where(F.col("vec_id") % 50 == 0))
