"""Running sums over an order, without passing all rows, or all rows of a group, through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows that a range of the order holds on average, and the most ranges of a group; beyond it they get longer.
ROWS_A_RANGE, MAX_RANGES = 50_000, 1024


#: So many groups have their cuts and bases broadcast (at most 1,025 numbers each).
FEW_GROUPS = 100


def range_of(df: DataFrame, order: str, by: Sequence[str] = (), rows: int | None = None, few: bool = False) -> DataFrame:
    """``df`` with ``__range``, which grows with ``order`` within each group of ``by``; nulls come first.

    The cuts are approximate quantiles of each group, as many as its number of rows asks for, found and used in one plan.
    ``few``: the caller knows that there are at most FEW_GROUPS groups, whose cuts are broadcast, so that no group's rows meet on one task.
    """
    rows = rows or ROWS_A_RANGE
    at = ",".join(str(k / MAX_RANGES) for k in range(1, MAX_RANGES))
    groups = df.groupBy(*(F.col(c).alias(f"__by_{c}") for c in by)).agg(F.expr(f"percentile_approx(`{order}`, array({at}), 10000)").alias("q"), F.count(F.lit(1)).alias("n"))
    step = F.greatest(F.lit(1), F.least(F.lit(MAX_RANGES), F.floor(F.lit(MAX_RANGES * rows) / F.col("n")).cast("int")))
    cuts = groups.withColumn("__step", step)
    cuts = cuts.select(*(f"__by_{c}" for c in by), F.array_distinct(F.filter("q", lambda c, i: (i + 1) % F.col("__step") == 0)).alias("__cuts"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    # Without groups the cuts are one row.
    joined = df.join(F.broadcast(cuts) if few else cuts, same, "left") if by else df.join(F.broadcast(cuts))
    passed = F.size(F.filter("__cuts", lambda c: c < F.col(order))) + 1
    return joined.withColumn("__range", F.when(F.col(order).isNull(), 0).otherwise(F.coalesce(passed, F.lit(1)))).drop("__cuts", *(f"__by_{c}" for c in by))


def running_before(df: DataFrame, order: str, values: list[str], by: Sequence[str] = (), rows: int | None = None, few: bool = False, range_col: Column | None = None) -> DataFrame:
    """``df`` with ``<value>_before``: the sum of each value over all rows of the same ``by`` before it in ``order``.

    ``few`` as in ``range_of``; ``range_col`` are ranges that the caller knows, at most MAX_RANGES, growing with ``order``.
    """
    ranged = range_of(df, order, by, rows, few) if range_col is None else df.withColumn("__range", range_col)
    within = W.partitionBy(*by, "__range").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, "__range").agg(*(F.sum(v).alias(f"__{v}") for v in values))
    upto = W.partitionBy(*by).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)  # at most MAX_RANGES + 1 rows a group
    bases = totals.select(*(F.col(c).alias(f"__by_{c}") for c in by), F.col("__range").alias("__of"), *(F.coalesce(F.sum(f"__{v}").over(upto), F.lit(0)).alias(f"__{v}") for v in values))
    same = F.col("__range") == F.col("__of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    out = ranged.join(F.broadcast(bases) if few or not by else bases, same).withColumns({f"{v}_before": F.col(f"__{v}") + F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values})
    return out.drop("__range", "__of", *(f"__by_{c}" for c in by), *(f"__{v}" for v in values))
