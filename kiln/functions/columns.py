"""Column expressions with the semantics that a scorer of mixed frames needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING = -999


def fill_missing(df: DataFrame, columns: list[str], value: int = MISSING) -> DataFrame:
    """Missing (null or NaN) to a constant in columns of any type: numbers as double, all else as its text."""

    def filled(c: str) -> Column:
        kind = df.schema[c].dataType
        col = F.col(f"`{c}`")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return F.coalesce(F.nanvl(col, F.lit(None).cast(kind)).cast("double"), F.lit(float(value)))
        if isinstance(kind, T.NumericType):
            return F.coalesce(col.cast("double"), F.lit(float(value)))
        return F.coalesce(col.cast("string"), F.lit(str(value)))

    return df.withColumns({c: filled(c) for c in columns})


def categorical(df: DataFrame, columns: list[str]) -> list[int]:
    """Positions of the columns that are not numbers; decided once, on the training side."""
    return [i for i, c in enumerate(columns) if not isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))]


def feature_columns(output: list[str], inputs: list[str]) -> list[str]:
    """Columns of an output that its input lacks, in the output's order."""
    return [c for c in output if c not in inputs]


def order_hash(row_id: Column, seed: int | str) -> Column:
    """52 bits of md5 over seed and id as a long: an order that any SQL engine with md5 can make; null ids share one place."""
    joined = F.concat_ws("|", F.lit(str(seed)), F.coalesce(row_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long")


def noise(row_id: Column, seed: int) -> Column:
    """A standard normal number that depends on the row's id and the seed alone."""
    u = lambda k: (order_hash(row_id, f"{seed}|{k}") + 0.5) / float(1 << 52)
    return F.sqrt(-2 * F.log(u(0))) * F.cos(u(1) * 2 * 3.141592653589793)


def tail(text: Column, n: int = 5000) -> Column:
    return F.substring(text, -n, n)
