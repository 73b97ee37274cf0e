"""The corpus pipeline: quality, near duplicates, personal data, mixing, token ids.

Every stage takes what its predecessor kept, as stored Parquet; what a stage's operators stored goes when the stage is done. Null, empty and repeated rows keep the results that the operators
define; an empty table passes through. A row's columns travel in one struct, so they may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import bpe, mixing, pii, quality
from kiln.llm.common import scratch, shared_dir, stored, table
from kiln.llm.ngram_join import ngram_classes

#: So many keys of rows that go are broadcast at most; more are joined by a shuffle.
MAX_BROADCAST_KEYS = 1_000_000


def packed(docs: DataFrame, *read: str) -> DataFrame:
    """All columns as one struct ``row``, and beside it those that a stage reads."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *read)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return quality.keep_good(spark, docs, sf_dir)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five words, similarity 0.8): the one with the least doc_id, of equal rows one.

    Documents without words link with nothing and stay.
    """
    classes = stored(ngram_classes(docs, k=5, num=80, den=100), "classes")
    repeated = classes.where(F.col("first") & (F.col("n_shingles") > 0)).groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id", "text_hash")
    gone = classes.where(~F.col("first")).select("doc_id", "text_hash").union(repeated).distinct()
    gone, repeated = stored(gone, "gone"), stored(repeated, "repeated")

    whole = packed(docs, "doc_id", "text")

    def having(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
        keys = F.broadcast(keys) if keys.count() <= MAX_BROADCAST_KEYS else keys
        return whole.join(keys, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.xxhash64("text") == F.col("k_hash")), how)

    kept = having(gone, "left_anti")
    if not repeated.isEmpty():
        kept = kept.unionByName(having(repeated, "left_semi").dropDuplicates(["doc_id", "text"]))
    return kept.select("row.*")


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in the text."""
    return pii.mask(docs, pii.fit(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it."""
    taken = mixing.mix(packed(docs, "doc_id", "text", "source")).where(F.col("mix_repeats") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("mix_repeats").cast("int")))).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the digests of ids and decoded text of every row."""
    return bpe.digests(bpe.round_trip(docs, ["doc_id", "source"]), ["doc_id", "source"])


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("personal_data", private),
    ("mix", mixed),
    ("token_ids", token_ids),
]

#: No SQL can express the fitted stages; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), shared_dir(spark)
    for name, stage in STAGES:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), name, folder)
    return docs
