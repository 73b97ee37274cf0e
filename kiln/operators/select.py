"""Choice of at most five features: singly, or as a set judged by cross-validation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import FEW_GROUPS

MAX_FEATURES = 5
#: Features that forward selection tries, the best by single AUC; bins of a feature.
SHORTLIST, BINS = 20, 16
#: Codes of all features, bins and folds that are broadcast, at most.
MAX_CODES = 100_000


def feature_scores(df: DataFrame, features: list[str], target: str, filler: float = -999.0) -> DataFrame:
    """feature, auc of each: all features in one pass of (feature, value) sums, missing values (null or NaN) at the filler.

    The distinct values of a feature are ordered in ranges, so a feature with a value of its own in every row is no task of its own.
    """
    from ..functions.metrics import auc_by

    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.coalesce(F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None)), F.lit(filler)).alias("value")) for f in features)))
    long = df.select(F.col(target).alias("y"), each.alias("e")).select("y", "e.feature", "e.value")
    return auc_by(long, "value", "y", ["feature"], few=len(features) <= FEW_GROUPS)


def top_features(scores: DataFrame, by: str = "importance", name: str = "feature", n: int = 20) -> DataFrame:
    """The n best, ties by name."""
    return scores.orderBy(F.desc(by), name).limit(n)


def correlations(df: DataFrame, features: list[str]) -> DataFrame:
    """feature_a, feature_b, corr for every pair, in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    row = df.agg(F.array(*(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.corr(a, b).alias("corr")) for a, b in pairs)).alias("p"))
    return row.select(F.explode("p").alias("p")).select("p.*")


def ranked(df: DataFrame, features: list[str], target: str, most_null: float = 0.99) -> list[str]:
    """Features that vary and aren't near-empty, by distance of the AUC from one half, ties by name."""
    least, greatest = (lambda f: F.min(F.col(f"`{f}`"))), (lambda f: F.max(F.col(f"`{f}`")))
    facts = df.agg(F.count(F.lit(1)).alias("n"), *(F.struct(F.count(F.col(f"`{f}`")).alias("some"), (least(f) < greatest(f)).alias("varies")).alias(f) for f in features)).first()
    usable = [f for f in features if facts[f]["varies"] and facts[f]["some"] >= (1 - most_null) * facts["n"]]
    if not usable:
        return []
    return [r.feature for r in feature_scores(df, usable, target).orderBy(F.desc(F.abs(F.col("auc") - 0.5)), "feature").collect()]  # a row per feature


def spread(scored: list[str], near: Callable[[list[str]], set[frozenset[str]]], limit: int = MAX_FEATURES, block: int = SHORTLIST) -> list[str]:
    """The first ``limit`` of ``scored`` (best first), without near copies of a better one. ``near`` gives the pairs of near copies among some features; it is asked block by block, as far as needed."""
    chosen: list[str] = []
    for start in range(0, len(scored), block):
        same = near([*chosen, *scored[start : start + block]])
        for f in scored[start : start + block]:
            if len(chosen) < limit and not any(frozenset((f, c)) in same for c in chosen):
                chosen.append(f)
        if len(chosen) == limit:
            break
    return chosen


def choose(df: DataFrame, features: list[str], target: str, limit: int = MAX_FEATURES, redundant: float = 0.95, most_null: float = 0.99) -> list[str]:
    """Greedy, one feature at a time: by distance of the AUC from one half, leaving out constants, near-empty ones and near copies of a better one; ties by name."""

    def near(some: list[str]) -> set[frozenset[str]]:
        filled = df.select(*(F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(-999.0)).alias(f"c{i:04}") for i, f in enumerate(some)))
        pairs = correlations(filled, filled.columns).collect() if len(some) > 1 else []  # a row a pair
        return {frozenset((some[int(r.feature_a[1:])], some[int(r.feature_b[1:])])) for r in pairs if r["corr"] is not None and abs(r["corr"]) > redundant}

    return spread(ranked(df, features, target, most_null), near, limit)


def woe_codes(df: DataFrame, bins: dict[str, str], target: str, fold: str, smooth: float = 0.5) -> DataFrame:
    """``df`` with ``__w_<feature>``: the smoothed log ratio of class shares in the row's bin, from the rows of all other folds; null is a bin named "null".

    ``bins`` names the bin column of each feature. One aggregate counts (feature, bin, fold). Up to MAX_CODES of these are broadcast; more (of text columns with many values) are joined by a shuffle.
    """
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f"`{b}`").cast("string"), F.lit("null")).alias("bin")) for f, b in bins.items())))
    y = F.col(target).cast("double")
    counts = df.select(y.alias("y"), F.col(fold).cast("string").alias("fold"), each.alias("e")).groupBy("e.feature", "e.bin", "fold").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    over = counts.groupBy("feature", "bin").agg(F.sum("pos").alias("bin_pos"), F.sum("neg").alias("bin_neg"))
    folds = counts.groupBy("feature", "fold").agg(F.sum("pos").alias("fold_pos"), F.sum("neg").alias("fold_neg"))
    total = folds.groupBy("feature").agg(F.sum("fold_pos").alias("all_pos"), F.sum("fold_neg").alias("all_neg"))
    facts = counts.join(over, ["feature", "bin"]).join(folds, ["feature", "fold"]).join(total, "feature")
    p = (F.col("bin_pos") - F.col("pos") + smooth) / (F.col("all_pos") - F.col("fold_pos") + smooth)
    q = (F.col("bin_neg") - F.col("neg") + smooth) / (F.col("all_neg") - F.col("fold_neg") + smooth)
    coded = facts.select("feature", F.concat_ws("|", "bin", "fold").alias("at"), F.log(p / q).alias("woe"))
    key = lambda b: F.concat_ws("|", F.coalesce(F.col(f"`{b}`").cast("string"), F.lit("null")), F.col(fold).cast("string"))
    few = coded.limit(MAX_CODES + 1).count() <= MAX_CODES
    out = df
    for i, (f, b) in enumerate(bins.items()):
        own = coded.where(F.col("feature") == f).select(F.col("at").alias(f"__at_{i}"), F.col("woe").alias(f"__w_{f}"))
        out = out.join(F.broadcast(own) if few else own, key(b) == F.col(f"__at_{i}"), "left").drop(f"__at_{i}")
    return out


def set_scores(coded: DataFrame, sets: dict[str, list[str]], target: str, fold: str) -> DataFrame:
    """set_id, mean_auc over folds: a set's score is the sum of its features' codes, all sets in one plan."""
    from ..functions.metrics import auc_by

    each = F.explode(F.array(*(F.struct(F.lit(s).alias("set_id"), F.round(sum((F.col(f"`__w_{f}`") for f in some), F.lit(0.0)), 9).alias("x")) for s, some in sets.items())))
    long = coded.select(F.col(fold).alias("fold"), F.col(target).alias("y"), each.alias("e")).select("fold", "y", "e.set_id", "e.x")
    return auc_by(long, "x", "y", ["set_id", "fold"]).groupBy("set_id").agg(F.avg("auc").alias("mean_auc"))


def grow(coded: DataFrame, features: list[str], target: str, fold: str, limit: int = MAX_FEATURES, least_gain: float = 1e-3, late: Callable[[], bool] = lambda: False) -> list[tuple[str, float]]:
    """Forward selection over coded features: at each step the one that raises the set's mean AUC most, ties by name, until none adds ``least_gain``."""
    chosen: list[tuple[str, float]] = []
    while len(chosen) < limit and not late():
        names = [f for f, _ in chosen]
        sets = {f: [*names, f] for f in features if f not in names}
        if not sets:
            break
        best = min(set_scores(coded, sets, target, fold).where("mean_auc is not null").collect(), key=lambda r: (-round(r.mean_auc, 9), r.set_id), default=None)  # a row per feature
        if best is None or (chosen and best.mean_auc - chosen[-1][1] < least_gain):
            break
        chosen.append((best.set_id, best.mean_auc))
    return chosen


def quantile_bins(df: DataFrame, features: list[str], n: int = BINS) -> DataFrame:
    """``df`` with ``__b_<feature>``: the number of approximate n-quantiles below the value, null for null."""
    cuts = df.agg(*(F.percentile_approx(F.col(f"`{f}`").cast("double"), [k / n for k in range(1, n)], 1000).alias(f) for f in features)).first()
    count = lambda f: sum((F.col(f"`{f}`").cast("double") > c).cast("int") for c in sorted(set(cuts[f] or [])))
    return df.withColumns({f"__b_{f}": count(f) if cuts[f] else F.lit(None).cast("int") for f in features})


def forward(df: DataFrame, features: list[str], target: str, row_id: str, limit: int = MAX_FEATURES, folds: int = 5, late: Callable[[], bool] = lambda: False) -> list[str]:
    """The set that forward selection grows from ``features``, by stratified cross-validation over all rows."""
    from ..functions.metrics import stratified_folds

    if not features:
        return []
    rows = stratified_folds(quantile_bins(df.select(row_id, target, *features), features), row_id, target, folds)
    coded = woe_codes(rows, {f: f"__b_{f}" for f in features}, target, "fold").select("fold", target, *(f"__w_{f}" for f in features)).cache()
    try:
        return [f for f, _ in grow(coded, features, target, "fold", limit, late=late)]
    finally:
        coded.unpersist()
