"""The contract of a submission as a table of violations; all rules are evaluated, none aborts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import feature_columns

SCHEMA = "rule string, column_name string, detail string"


def violations(spark: SparkSession, inputs: dict[str, DataFrame], outputs: dict[str, DataFrame], headers: dict[str, list[str]] | None = None, id_col: str | None = None, least: int = 1, most: int = 5, target: str | None = None) -> DataFrame:
    """A row per broken rule for train and test; one aggregate over each output, one anti join each way for ids.

    With ``target``, outputs hold the id, the target (train only) and features alone: further input columns in them are broken rules too, and needn't be kept.
    """
    if target:
        own = {k: [id_col, *([target] if k == "train" else [])] for k in ("train", "test")}
        extra = [("extra_column", c, k) for k in ("train", "test") for c in outputs[k].columns if c in inputs[k].columns and c not in own[k]]
        inputs = {k: inputs[k].select(*own[k]) for k in ("train", "test")}
    else:
        extra = []
    found: list[tuple[str, str | None, str]] = list(extra)
    features = {k: [c for c in feature_columns(outputs[k].columns, inputs[k].columns) if ("extra_column", c, k) not in extra] for k in ("train", "test")}
    for k in ("train", "test"):
        names = (headers or {}).get(k, outputs[k].columns)
        found += [("missing_input_column", c, k) for c in inputs[k].columns if c not in outputs[k].columns]
        found += [("duplicate_column", c, k) for c in sorted({c for c in names if names.count(c) > 1})]
        if features[k]:
            counts = outputs[k].agg(*(F.count(F.nanvl(F.col(f"`{f}`"), F.lit(None)) if dict(outputs[k].dtypes)[f] in ("double", "float") else F.col(f"`{f}`")).alias(f) for f in features[k])).first()
            found += [("empty_feature", f, k) for f in features[k] if not counts[f]]
    if features["train"] != features["test"]:
        found.append(("feature_names_differ", None, f"{features['train']} {features['test']}"))
    if not least <= len(features["train"]) <= most:
        found.append(("feature_count", None, str(len(features["train"]))))
    table = spark.createDataFrame(found, SCHEMA)
    for k in ("train", "test") if id_col else ():
        a, b = inputs[k].select(id_col), outputs[k].select(id_col)
        for rule, more, fewer in (("id_missing", a, b), ("id_added", b, a)):
            gap = more.exceptAll(fewer).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
            table = table.union(gap.select(F.lit(rule), F.lit(id_col), F.concat(F.lit(f"{k} "), F.col("n").cast("string"))))
    return table
