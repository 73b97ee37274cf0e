"""Mixing sources to target weights: Efraimidis-Spirakis sampling, in DataFrame operations only.

Every row gets an exponential key ``-ln(u) / quality`` from a hash of its own values, so reruns and
repartitioning agree. Within a source, rows are taken in key order until the source's token budget
is filled; a budget above the source's size is served by complete epochs of all its rows before
the keys decide the fractional rest.

The prefix sum never sorts a source as a whole. Keys fall into ranges by a monotone map; sums by
(source, range), which combine before the shuffle, tell which ranges are taken whole, and only rows
of the one range where the budget ends are ordered. A source may therefore hold any share of the rows.

Defined results: null source is a source of its own, last in order; null or blank text has size 0 and
is never taken; equal rows get equal keys, and row order among them does not matter; an empty table
gives an empty result; input columns travel in one struct, so theirs may have any names but the four that are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrow import check_names
from .common import drop, hash52, shared_dir, stored, table, word_count

#: Rows of one source that a key range holds on average.
ROWS_A_RANGE = 400
#: No document may be repeated more often.
MAX_EPOCHS = 3
PARTS = 2.0**52


def quality_weight(text: Column) -> Column:
    """Weight in [0.1, 1]: the share of letters and blanks in the text, 0.1 for empty text."""
    n = F.length(text)
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\x20\n]", ""))
    return F.when(n > 0, F.greatest(F.lit(0.1), plain / n)).otherwise(F.lit(0.1))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes(src, source_size, n_rows)`` plus ``target``.

    Sources weigh ``weights`` in turn, by code point, null last, and share the whole size. A target
    stops at ``max_epochs`` times the source's size and the excess is shared again by weight until none
    is above. That fixed point is a water level: with sources ordered by cap / weight, those below
    the level stand at their cap and the others at level * weight. The table has one row per source.
    """
    order = W.orderBy(F.col("src").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    weighed = weighed.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("src").asc_nulls_last())
    everything = W.partitionBy()
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything).cast("double")
    capped, freed = F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (total - capped) / (F.sum("weight").over(everything) - freed)
    # While sources fall short of the level it rises from one to the next; from the first that doesn't on, it would only fall.
    levelled = weighed.withColumn("level", level).withColumn("water", F.max("level").over(everything))
    target = F.least(F.col("cap"), F.col("water") * F.col("weight"))
    return levelled.select("src", "source_size", "n_rows", target.alias("target"))


def _measured(docs: DataFrame, doc_id: str, text: str, source: str, seed: str, quality: Column | None) -> DataFrame:
    """``docs`` as a struct ``row`` beside ``src``, ``size`` and the exponential ``key``."""
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(f"`{source}`").alias("src"),
        word_count(F.col(f"`{text}`")).alias("size"),
        ((hash52(F.col(f"`{doc_id}`"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))), seed=seed) + 0.5) / PARTS).alias("u"),
        (quality_weight(F.col(f"`{text}`")) if quality is None else quality).alias("w"),
    ).select("row", "src", "size", (-F.log("u") / F.col("w")).alias("key"))


def source_plan(measured: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """A row per source: size, target, complete epochs, and the key up to which rows are taken once more.

    ``measured(src, size, key)`` should be a stored table, since it is read several times.
    """
    sizes = measured.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = source_targets(sizes, weights).withColumn("epochs", whole).select(
        F.col("src").alias("s_src"), "source_size", "target", "epochs",
        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("budget"),
        F.ceil(F.col("n_rows") / ROWS_A_RANGE).cast("long").alias("ranges"),
    )
    at = F.floor((1 - F.exp(-F.col("key"))) * F.col("ranges"))
    ranged = measured.join(sources, F.col("src").eqNullSafe(F.col("s_src"))).withColumn("range", at)
    upto = W.partitionBy("src").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = ranged.groupBy("src", "range").agg(F.sum("size").alias("range_size"), F.first("budget").alias("budget"), F.max("key").alias("last_key"))
    sums = sums.withColumn("base", F.coalesce(F.sum("range_size").over(upto), F.lit(0)))
    inside = F.col("base") + F.col("range_size") <= F.col("budget")
    full = sums.where(inside).groupBy("src").agg(F.max("last_key").alias("upto"))
    edge = sums.where(~inside & (F.col("base") < F.col("budget"))).select(F.col("src").alias("e_src"), F.col("range").alias("e_range"), "base")
    running = W.partitionBy("src").orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow)
    cut = ranged.join(edge, F.col("src").eqNullSafe(F.col("e_src")) & (F.col("range") == F.col("e_range")))
    cut = cut.groupBy("src", "key", "base", "budget").agg(F.sum("size").alias("size"))
    cut = cut.withColumn("after", F.col("base") + F.sum("size").over(running))
    cut = cut.where(F.col("after") - F.col("size") / 2 <= F.col("budget")).groupBy("src").agg(F.max("key").alias("upto"))
    last = full.unionByName(cut).groupBy(F.col("src").alias("k_src")).agg(F.max("upto").alias("upto"))
    joined = sources.join(last, F.col("s_src").eqNullSafe(F.col("k_src")), "left")
    return joined.select("s_src", "source_size", "target", "epochs", "upto")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", quality: Column | None = None, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """All of ``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target``, ``mix_repeats`` (times the row is taken).

    The sum of size * repeats over a source ends within half a row (or group of equal rows) of its target. Columns of ``docs`` with one of the four names raise ValueError.
    """
    check_names(docs, docs.columns, ["mix_size", "mix_source_size", "mix_target", "mix_repeats"])
    measured = _measured(docs, doc_id, text, source, seed, quality)
    spark = docs.sparkSession
    folder = shared_dir(spark)
    sources = stored(source_plan(stored(measured.select("src", "size", "key"), "measured", folder), weights), "sources", folder)
    drop(spark, folder, "measured")
    placed = measured.join(sources, F.col("src").eqNullSafe(F.col("s_src")), "left")
    return placed.select(
        *(F.col("row").getField(c).alias(c) for c in docs.columns),
        F.col("size").alias("mix_size"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
        (F.col("epochs") + F.coalesce((F.col("key") <= F.col("upto")).cast("long"), F.lit(0))).alias("mix_repeats"),
    )


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_repeats")).cast("long").alias("taken"),
    )


OP5_SQL = r"""
WITH rows AS (
  SELECT doc_id, source AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
         CASE WHEN length(text) > 0 THEN greatest(0.1::DOUBLE, length(regexp_replace(text, '[^\p{L}\x20\n]', '', 'g'))::DOUBLE / length(text)::DOUBLE) ELSE 0.1::DOUBLE END AS w
  FROM documents),
keyed AS (SELECT doc_id, src, size, -ln(u) / w AS key FROM rows),
sizes AS (SELECT src, sum(size)::DOUBLE AS source_size FROM keyed GROUP BY src),
weighed AS (
  SELECT src, source_size, 3 * source_size AS cap,
         (1 + (row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3)::DOUBLE AS weight FROM sizes),
lv AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM weighed WINDOW b AS (ORDER BY cap / weight, src NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT *, max(level) OVER () AS water FROM lv),
targets AS (SELECT src, source_size, least(cap, water * weight) AS target FROM water),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS budget FROM targets),
per_key AS (SELECT src, key, sum(size) AS key_size FROM keyed GROUP BY src, key),
run AS (SELECT src, key, key_size, sum(key_size) OVER (PARTITION BY src ORDER BY key) AS upto FROM per_key)
SELECT k.doc_id, k.size, p.source_size::BIGINT AS source_size, p.target,
       (k.size * (p.epochs + CASE WHEN r.upto - r.key_size / 2 <= p.budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM keyed k JOIN plan p ON k.src IS NOT DISTINCT FROM p.src
JOIN run r ON r.src IS NOT DISTINCT FROM k.src AND r.key = k.key
"""
