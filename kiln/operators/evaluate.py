"""Cross-validated scores of feature sets with gradient-boosted symmetric trees."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import fill_missing
from ..functions.metrics import auc, auc_by, stratified_folds
from .boosting import Boosted, BoostParams, fit
from .ordered import FEW_GROUPS
from .select import top_features

__all__ = ["BoostParams", "Score", "cv_scores", "fit_folds", "score"]


@dataclass
class Score:
    roc_auc: float
    gini: float
    primary: float
    details: dict = field(default_factory=dict)


def fit_folds(df: DataFrame, row_id: str, features: list[str], target: str, k: int = 5, params: BoostParams = BoostParams()) -> tuple[Boosted, DataFrame]:
    """The models of all folds and of all rows, grown together, and ``fold, auc`` of each stratified fold by the model that hasn't seen it."""
    rows = stratified_folds(fill_missing(df.select(row_id, target, *features), features), row_id, target, k)
    model, held = fit(rows, row_id, features, target, "fold", k, params)
    return model, auc_by(held, "margin", "y", ["fold"], few=k <= FEW_GROUPS).select(F.col("fold").cast("long").alias("fold"), "auc")


def cv_scores(df: DataFrame, row_id: str, features: list[str], target: str, k: int = 5, params: BoostParams = BoostParams()) -> DataFrame:
    """fold, auc over stratified folds; missing values at the filler, classes balanced, text columns as ordered target codes."""
    return fit_folds(df, row_id, features, target, k, params)[1]


def importance_report(model: Boosted, n: int = 20) -> DataFrame:
    """feature, importance: the n most important, ties by name."""
    rows = SparkSession.active().createDataFrame(list(model.importance().items()), "feature string, importance double")  # a row a feature
    return top_features(rows, n=n)


def score(train: DataFrame, test: DataFrame, labels: DataFrame, id_col: str, target: str, metric: str = "roc_auc", params: BoostParams = BoostParams()) -> Score:
    """Fit on train, score test against its labels (a row per id, checked), with cross-validation and the 20 most important features.

    The model of all training rows and those of the folds are one fit.
    """
    from .joins import lookup_left

    features = [c for c in train.columns if c not in (id_col, target)]
    text = [c for c in features if dict(train.dtypes)[c] == "string"]
    test = test.withColumns({c: F.col(c).cast("string") for c in text}) if text else test
    judged = lookup_left(test.drop(target), labels.select(id_col, target), [id_col], unique=True)
    if judged.where(F.col(target).isNull()).limit(1).count():
        raise ValueError("some test ids have no label")
    model, folds = fit_folds(train, id_col, features, target, params=params)
    # One aggregate for the test score with its rows, one for the folds with theirs.
    value = auc(model.margin(fill_missing(judged, features)), "margin", target).first()["auc"]
    cv = folds.agg(F.round(F.avg("auc"), 6).alias("cv_mean_auc"), F.round(F.stddev_pop("auc"), 6).alias("cv_std_auc")).first().asDict()
    rows = train.agg(F.count(F.lit(1)).alias("train_rows")).join(F.broadcast(judged.agg(F.count(F.lit(1)).alias("test_rows")))).first().asDict()  # one row each
    top = {r.feature: r.importance for r in importance_report(model).collect()}
    gini = 2 * value - 1
    return Score(round(value, 6), round(gini, 6), round(value if metric == "roc_auc" else gini, 6), {**cv, "n_features": len(features), **rows, "top_features": top})
