"""Scores of a numeric column against a 0/1 target, as relational plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordered import FEW_GROUPS, running_before


def auc(df: DataFrame, score: str, target: str) -> DataFrame:
    """One row ``auc``: the share of (positive, negative) pairs in order, ties half. Null scores are left out; null for one class only.

    Rows are first summed by distinct score; the running count of negatives works on ranges of scores.
    """
    counts = df.where(F.col(score).isNotNull() & F.col(target).isNotNull()).groupBy(F.col(score).alias("x")).agg(F.sum(F.col(target).cast("double")).alias("pos"), F.sum(1 - F.col(target).cast("double")).alias("neg"))
    placed = running_before(counts, "x", ["neg"])
    total = F.sum("pos") * F.sum("neg")
    return placed.agg(F.when(total > 0, F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)) / total).alias("auc"))


def auc_by(df: DataFrame, score: str, target: str, by: list[str], few: bool = False) -> DataFrame:
    """``auc`` per group of ``by``, all groups in one plan; a group's distinct scores are ordered in ranges. ``few`` as in ``ordered.range_of``."""
    counts = df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("x")).agg(F.sum(F.col(target).cast("double")).alias("pos"), F.sum(1 - F.col(target).cast("double")).alias("neg"))
    placed = running_before(counts, "x", ["neg"], by, few=few)
    total = F.sum("pos") * F.sum("neg")
    return placed.groupBy(*by).agg(F.when(total > 0, F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)) / total).alias("auc"))


def gini(value: Column) -> Column:
    return 2 * value - 1


def width_bin(value: Column, width: float, last: int) -> Column:
    """Bins of equal width from 0, the last one open."""
    return F.least(F.floor(value / width), F.lit(last)).cast("long")


def bin_counts(df: DataFrame, bin_col: str, target: str) -> DataFrame:
    y = F.col(target).cast("long")
    return df.groupBy(bin_col).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def woe(df: DataFrame, bin_col: str, target: str, smooth: float = 0.5) -> DataFrame:
    """Per bin: pos, neg, and the smoothed log ratio of its shares of both classes."""
    counts = bin_counts(df, bin_col, target)
    totals = counts.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))  # one row
    p = (F.col("pos") + smooth) / (F.col("all_pos") + smooth)
    q = (F.col("neg") + smooth) / (F.col("all_neg") + smooth)
    return counts.join(F.broadcast(totals)).select(bin_col, "pos", "neg", F.log(p / q).alias("woe"), (p - q).alias("gap"))


def information_value(df: DataFrame, bin_col: str, target: str) -> DataFrame:
    return woe(df, bin_col, target).agg(F.sum(F.col("gap") * F.col("woe")).alias("iv"))


def psi(df: DataFrame, bin_col: str, split: str, smooth: float = 0.5) -> DataFrame:
    """Population stability of bins between rows with ``split`` 0 and 1."""
    return information_value(df, bin_col, split).select(F.col("iv").alias("psi")) if smooth == 0.5 else woe(df, bin_col, split, smooth).agg(F.sum(F.col("gap") * F.col("woe")).alias("psi"))


def mutual_information(df: DataFrame, bin_col: str, target: str) -> DataFrame:
    joint = df.groupBy(bin_col, target).agg(F.count(F.lit(1)).alias("n"))
    by_bin, by_y, everything = W.partitionBy(bin_col), W.partitionBy(target), W.partitionBy()
    n = F.col("n").cast("double")
    total = F.sum(n).over(everything)
    term = n / total * F.log(n * total / (F.sum(n).over(by_bin) * F.sum(n).over(by_y)))
    return joint.select(term.alias("t")).agg(F.sum("t").alias("mi"))


def stratified_folds(df: DataFrame, row_id: str, target: str, k: int = 5) -> DataFrame:
    """``df`` with ``fold``: unshuffled stratified folds in order of ``row_id``, classes in order of first appearance.

    Rows of a class with running number r (over its m rows) fall into consecutive runs whose lengths are the class's counts
    at positions f, f + k, ... of the order by (class, row). Those counts follow from class sizes alone, so only the
    running number within a class needs the rows' order.
    """
    classes = df.groupBy(target).agg(F.min(row_id).alias("__first"), F.count(F.lit(1)).alias("__m"))
    start = F.coalesce(F.sum("__m").over(W.orderBy("__first").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sized = classes.withColumn("__start", start)  # a row per class
    # Positions start .. start+m-1 hold f, modulo k, so often:
    alloc = lambda f: F.floor((F.col("__start") + F.col("__m") - 1 - f + k) / k) - F.floor((F.col("__start") - 1 - f + k) / k)
    ends, total = [], F.lit(0)
    for f in range(k):
        total = total + alloc(f)
        ends.append(total)
    sized = sized.select(F.col(target).alias("__class"), F.array(*ends).alias("__ends"))
    few = df.select(target).distinct().limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
    numbered = running_before(df.withColumn("__one", F.lit(1).cast("long")), row_id, ["__one"], [target], few=few)
    joined = numbered.join(F.broadcast(sized) if few else sized, F.col(target).eqNullSafe(F.col("__class")))
    fold = F.size(F.filter("__ends", lambda e: e <= F.col("__one_before")))
    return joined.withColumn("fold", fold.cast("long")).drop("__class", "__ends", "__one", "__one_before")


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Largest class count over each class's count."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("weight", F.max("n").over(W.partitionBy()) / F.col("n"))
