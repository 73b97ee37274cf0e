"""Joins that add columns to a table of ids without changing its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _family(kind: T.DataType) -> str:
    return "number" if isinstance(kind, T.NumericType) else "text" if isinstance(kind, T.StringType) else kind.simpleString()


def check_key_types(left: DataFrame, right: DataFrame, on: list[str]) -> None:
    """Raise where a key is a number on one side and text on the other: Spark would cast and fail on rows, or match by accident."""
    for c in on:
        a, b = _family(left.schema[c].dataType), _family(right.schema[c].dataType)
        if a != b:
            raise TypeError(f"key {c!r} is {a} on the left and {b} on the right")


def lookup_left(left: DataFrame, right: DataFrame, on: list[str], unique: bool = False) -> DataFrame:
    """Left join where null keys match null keys. Other columns of equal name get the suffixes ``_x`` and ``_y``.

    ``unique`` raises if the right side holds a key twice, which would repeat rows of the left.
    """
    check_key_types(left, right, on)
    if unique:
        twice = right.groupBy(*on).count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"the right side repeats a key: {twice[0].asDict()}")
    both = set(left.columns) & set(right.columns) - set(on)
    a = left.select(*(F.col(f"`{c}`").alias(f"{c}_x" if c in both else c) for c in left.columns))
    b = right.select(*(F.col(f"`{c}`").alias(f"__key_{c}" if c in on else f"{c}_y" if c in both else c) for c in right.columns))
    same: Column = F.lit(True)
    for c in on:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`__key_{c}`"))
    return a.join(b, same, "left").drop(*(f"__key_{c}" for c in on))


def asof_last(left: DataFrame, right: DataFrame, by: list[str], at: str, keep: list[str], strict: bool = True) -> DataFrame:
    """``left`` with the columns ``keep`` of the right side's last row of the same ``by`` before its own ``at`` (``strict``: not at it).

    One union and one window over (by, at) instead of an inequality join: linear in both sides. Of right rows at one time the largest values count.
    """
    tag = lambda df, side: df.withColumn("__side", F.lit(side))
    value = F.struct(*(F.col(f"`{c}`").alias(c) for c in keep))
    a = tag(left.withColumn("__value", F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType)), 0 if strict else 2)
    b = tag(right.select(*by, at, value.alias("__value")), 1)
    order = W.partitionBy(*by).orderBy(F.col(at), F.col("__side"), F.col("__value")).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = a.unionByName(b, allowMissingColumns=True).withColumn("__last", F.last("__value", ignorenulls=True).over(order))
    out = filled.where(F.col("__side") != 1)
    return out.select(*left.columns, *(F.col("__last").getField(c).alias(f"last_{c}") for c in keep))


def range_lookup(left: DataFrame, value: str, bins: DataFrame, low: str, high: str) -> DataFrame:
    """Left join to the bin with low <= value < high. ``bins`` is a short hand-made table of at most 10,000 rows, which is checked, and broadcast."""
    if bins.limit(10_001).count() > 10_000:
        raise ValueError("too many bins to broadcast")
    return left.join(F.broadcast(bins), (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high)), "left")
