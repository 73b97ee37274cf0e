"""Encodings of a category: fitted on training rows as a table, then joined to any rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordered import MAX_RANGES, ROWS_A_RANGE, running_before


def frequency(df: DataFrame, by: str) -> DataFrame:
    """by, share of rows."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).select(by, (F.col("n") / F.sum("n").over(W.partitionBy())).alias("share"))


def smoothed_target(train: DataFrame, by: str, target: str, weight: float = 10.0) -> DataFrame:
    """by, mean target drawn to the overall mean by ``weight`` rows."""
    sums = train.groupBy(by).agg(F.sum(F.col(target).cast("double")).alias("s"), F.count(target).alias("n"))
    everything = W.partitionBy()  # a row per category
    prior = F.sum("s").over(everything) / F.sum("n").over(everything)
    return sums.select(by, ((F.col("s") + weight * prior) / (F.col("n") + weight)).alias("encoded"))


def out_of_fold_target(train: DataFrame, by: str, target: str, fold: str, weight: float = 10.0) -> DataFrame:
    """by, fold, mean target of the category over the other folds: a row's own target never reaches its code."""
    sums = train.groupBy(by, fold).agg(F.sum(F.col(target).cast("double")).alias("s"), F.count(target).alias("n"))
    cat, per_fold, everything = W.partitionBy(by), W.partitionBy(fold), W.partitionBy()
    prior = (F.sum("s").over(everything) - F.sum("s").over(per_fold)) / (F.sum("n").over(everything) - F.sum("n").over(per_fold))
    s, n = F.sum("s").over(cat) - F.col("s"), F.sum("n").over(cat) - F.col("n")
    return sums.select(by, fold, ((s + weight * prior) / (n + weight)).alias("encoded"))


def ordered_target(df: DataFrame, by: str, target: str, order: str, codes: Mapping[str, Column], prior: float, weight: float = 1.0, rows: int | None = None) -> DataFrame:
    """``df`` with a column per entry of ``codes``: the mean target of the rows of the same ``by`` before the row in ``order`` for which the entry's condition holds.

    Means are drawn to ``prior`` by ``weight`` rows. A row for which the condition fails gets the mean over all rows of its category for which it holds. ``order`` is a 52-bit
    hash (``columns.order_hash``), so equal parts of its range hold about equally many rows of every large category, and a hot one is spread over them.
    """
    rows = rows or ROWS_A_RANGE
    ranges = max(1, min(MAX_RANGES, -(-df.count() // rows)))
    y = F.col(target).cast("double")
    parts = {f"__{kind}_{name}": value for name, use in codes.items() for kind, value in (("y", F.when(use, F.coalesce(y, F.lit(0.0))).otherwise(0.0)), ("n", F.when(use, y.isNotNull().cast("double")).otherwise(0.0)))}
    placed = df.withColumns(parts)
    totals = placed.groupBy(F.col(f"`{by}`").alias("__value")).agg(*(F.sum(p).alias(f"{p}_all") for p in parts))
    run = running_before(placed, order, list(parts), [by], range_col=F.floor(F.col(order) / (2.0**52 / ranges)).cast("int"))
    joined = run.join(totals, F.col(f"`{by}`").eqNullSafe(F.col("__value")))

    def code(name: str, use: Column) -> Column:
        s, n = ((F.when(use, F.col(f"__{k}_{name}_before")).otherwise(F.col(f"__{k}_{name}_all"))) for k in "yn")
        return (s + weight * prior) / (n + weight)

    return joined.withColumns({name: code(name, use) for name, use in codes.items()}).select(*df.columns, *codes)


def rare(df: DataFrame, by: str, least: int, other: str = "other") -> DataFrame:
    """by, and the name it goes by: itself if at least ``least`` rows have it."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).select(by, F.when(F.col("n") >= least, F.col(by)).otherwise(other).alias("grouped"))
