"""Search for a feature set: bounds on every feature's score from one pass, then sets in rungs of growing rows and folds.

Scores. Cuts come from a bounded sample of rows (``SEARCH_ROWS``, by a hash of the ids), and one pass over all rows counts both classes between them,
a table of fixed size a task. Whatever the cuts, the counts bound a feature's AUC from both sides, so only features whose bounds leave their place
open are scored exactly.

Sets. The sample, binned, is small enough to be broadcast; a task fits the booster for one set and fold. All pairs are tried on few rows first, so two features
that say something only together are found; what survives is tried on more rows and folds (successive halving). Then the best sets grow and shrink by one feature
at a time, and a change is kept only if its gain over the folds exceeds its standard error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import order_hash
from .boosting import BoostParams, fit_rows, margins
from .select import MAX_FEATURES, SHORTLIST, feature_scores
from .store import ship

#: Rows that the search of sets sees at most; bins of a feature; features whose pairs are all tried, the best by bounds where there are more.
SEARCH_ROWS, BINS, PAIR_FEATURES = 20_000, 64, 60
#: (rows, folds, rounds, share of sets that goes on) of each rung.
RUNGS = ((1_500, 2, 12, 0.1), (6_000, 3, 25, 0.3), (SEARCH_ROWS, 5, 40, 1.0))
FILLER = -999.0
Set = tuple[str, ...]


class Sample:
    """Binned rows of a bounded sample in hash order, with the cuts they are binned by."""

    def __init__(self, y: np.ndarray, values: np.ndarray, features: list[str], bins: int = BINS):
        self.features, self.y, self.values = features, y, values
        at = np.arange(1, bins) / bins
        self.cuts = [np.unique(np.quantile(v, at, method="lower")) if len(v) else np.zeros(0) for v in values.T]
        self.codes = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, values.T, strict=True)], 1).astype(np.uint8) if len(features) else np.zeros((len(y), 0), np.uint8)

    @staticmethod
    def of(df: DataFrame, row_id: str, features: list[str], target: str, rows: int = SEARCH_ROWS) -> Sample:
        """At most about ``rows`` of the labelled rows of ``df``, those whose ids hash lowest; missing values at the filler."""
        known = df.where(F.col(target).isNotNull())
        n = known.count()
        hashed = known.select(order_hash(F.col(f"`{row_id}`"), "search").alias("o"), F.col(target).cast("double").alias("y"), *(filled(f).alias(f"f{i}") for i, f in enumerate(features)))
        hashed = hashed.where(F.col("o") < int(min(1.0, rows / max(1, n)) * 2**52))
        table = hashed.toArrow()
        order = np.argsort(table.column("o").to_numpy(), kind="stable")
        values = np.stack([table.column(f"f{i}").to_numpy() for i in range(len(features))], 1)[order] if features else np.zeros((len(order), 0))
        return Sample(table.column("y").to_numpy()[order], values, features)

    def near(self, some: list[str], redundant: float = 0.95) -> set[frozenset[str]]:
        """Pairs of ``some`` whose values in the sample correlate more."""
        at = [self.features.index(f) for f in some]
        own = self.values[:, at] - self.values[:, at].mean(0)
        length = np.sqrt((own**2).sum(0))
        with np.errstate(invalid="ignore", divide="ignore"):
            corr = np.abs(own.T @ own / np.outer(length, length))
        return {frozenset((some[i], some[j])) for i, j in zip(*np.nonzero(np.nan_to_num(corr) > redundant), strict=True) if i < j}


def filled(feature: str):
    value = F.col(f"`{feature}`").cast("double")
    return F.coalesce(F.nanvl(value, F.lit(None)), F.lit(FILLER))


def auc_bounds(df: DataFrame, target: str, sample: Sample) -> dict[str, tuple[float, float]]:
    """(least, largest) possible AUC of each feature that varies, over all labelled rows, from one pass; the two are equal where every bin holds one value or one class."""
    features, cuts = sample.features, sample.cuts
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros((len(c) + 1, 2), np.int64) for c in cuts]
        low, high = [np.full(len(c) + 1, np.inf) for c in cuts], [np.full(len(c) + 1, -np.inf) for c in cuts]
        for batch in batches:
            y = batch.column("y").to_numpy().astype(np.int64)
            for i, c in enumerate(cuts):
                v = batch.column(f"f{i}").to_numpy()
                at = np.searchsorted(c, v, side="left")
                counts[i] += np.bincount(2 * at + y, minlength=2 * len(c) + 2).reshape(-1, 2)
                np.minimum.at(low[i], at, v)
                np.maximum.at(high[i], at, v)
        rows = [(i, b, int(n), int(p), low[i][b], high[i][b]) for i, c in enumerate(counts) for b, (n, p) in enumerate(c.tolist()) if n + p]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["feature", "bin", "neg", "pos", "low", "high"])

    if not features:
        return {}
    rows = df.where(F.col(target).isNotNull()).select(F.col(target).cast("double").alias("y"), *(filled(f).alias(f"f{i}") for i, f in enumerate(features)))
    made = rows.mapInArrow(run, "feature long, bin long, neg long, pos long, low double, high double")
    sums = made.groupBy("feature", "bin").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("feature", "bin").collect()  # features times bins
    out: dict[str, tuple[float, float]] = {}
    for i, f in enumerate(features):
        own = [r for r in sums if r.feature == i]
        neg, pos = (np.array([r[c] for r in own], float) for c in ("neg", "pos"))
        whole = neg.sum() * pos.sum()
        if whole and min(r.low for r in own) < max(r.high for r in own):
            below = np.concatenate([[0.0], neg.cumsum()[:-1]])
            ties = np.array([0.5 if r.low == r.high else 0.0 for r in own])  # a bin with one value is half a pair, for certain
            out[f] = (float((pos * (below + neg * ties)).sum() / whole), float((pos * (below + neg * (1 - ties))).sum() / whole))
    return out


def distance(bounds: tuple[float, float]) -> tuple[float, float]:
    """Least and largest distance of the AUC from one half."""
    low, high = bounds
    return (0.0 if low <= 0.5 <= high else min(abs(low - 0.5), abs(high - 0.5))), max(abs(low - 0.5), abs(high - 0.5))


def best_features(df: DataFrame, target: str, bounds: dict[str, tuple[float, float]], n: int) -> list[str]:
    """The ``n`` features with the AUC farthest from one half, ties by name: those of an exact ranking of all. Only features that bounds leave in question are scored."""
    apart = {f: distance(b) for f, b in bounds.items()}
    limit = sorted((low for low, _ in apart.values()), reverse=True)[n - 1] if len(apart) >= n else 0.0
    asked = sorted(f for f, (_, high) in apart.items() if high >= limit)
    if not asked:
        return []
    exact = {r.feature: abs(r.auc - 0.5) for r in feature_scores(df.where(F.col(target).isNotNull()), asked, target).collect()}  # a row a feature
    return sorted(asked, key=lambda f: (-exact[f], f))[:n]


def rank_auc(score: np.ndarray, y: np.ndarray) -> float:
    """Mann-Whitney with mean ranks; one half where a class is missing."""
    _, at, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = (n.cumsum() - (n - 1) / 2)[at]
    pos = y.sum()
    neg = len(y) - pos
    return float((rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)) if pos and neg else 0.5


def fold_auc(codes: np.ndarray, y: np.ndarray, fold: int, folds: int, params: BoostParams) -> float:
    """AUC on every ``folds``-th row of a class by the booster fitted on the others."""
    turn = np.zeros(len(y), np.int64)
    for k in (0, 1):
        turn[y == k] = np.arange((y == k).sum()) % folds
    learn = turn != fold
    count = np.array([max(1, (y[learn] == k).sum()) for k in (0, 1)])
    trees = fit_rows(codes[learn].astype(np.int64), y[learn], (count.max() / count)[y[learn].astype(int)], params)
    return rank_auc(margins(trees, codes[~learn].astype(np.int64)), y[~learn])


class SetScores:
    """Scores of sets over one broadcast sample; a task a set and fold, each scored once."""

    def __init__(self, spark, sample: Sample, depth: int = 4):
        ship(spark)
        self.spark, self.sample, self.depth = spark, sample, depth
        self.shared = spark.sparkContext.broadcast((sample.codes, sample.y))
        self.known: dict[tuple[Set, int], list[float]] = {}
        #: (step, set, rung, mean AUC) of all that was tried.
        self.trace: list[tuple[str, Set, int, float]] = []

    def scores(self, sets: Sequence[Set], rung: int, step: str) -> dict[Set, list[float]]:
        """The AUC of each fold."""
        rows, folds, rounds, _ = RUNGS[rung]
        rows = min(rows, len(self.sample.y))
        place = {f: i for i, f in enumerate(self.sample.features)}
        new = [s for s in dict.fromkeys(sets) if (s, rung) not in self.known]
        params, shared = BoostParams(rounds=rounds, rate=0.2, depth=self.depth, bins=BINS), self.shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, y = shared.value
            for batch in batches:
                out = [fold_auc(codes[:rows, at], y[:rows], f, folds, params) for at, f in zip(batch.column("columns").to_pylist(), batch.column("fold").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("number"), batch.column("fold"), pa.array(out, pa.float64())], names=["number", "fold", "auc"])

        if new:
            work = [(n, f, [place[x] for x in s]) for n, s in enumerate(new) for f in range(folds)]
            tasks = max(1, min(len(work), 4 * self.spark.sparkContext.defaultParallelism))
            dealt = self.spark.createDataFrame(work, "number long, fold long, columns array<int>").repartition(tasks)
            for s in new:
                self.known[s, rung] = [0.0] * folds
            for r in dealt.mapInArrow(run, "number long, fold long, auc double").collect():  # sets times folds
                self.known[new[r.number], rung][r.fold] = r.auc
            self.trace += [(step, s, rung, float(np.mean(self.known[s, rung]))) for s in new]
        return {s: self.known[s, rung] for s in sets}

    def halved(self, sets: Sequence[Set], step: str, least: int = 8, late: Callable[[], bool] = lambda: False) -> list[Set]:
        """The sets that come through all rungs, best first, ties by name; where time runs out, as far as they came."""
        left = list(dict.fromkeys(sets))
        for rung, (*_, share) in enumerate(RUNGS):
            if rung and late():
                break
            scored = self.scores(left, rung, step)
            left = sorted(left, key=lambda s: (-round(float(np.mean(scored[s])), 9), s))
            if share < 1:
                left = left[: max(least, int(np.ceil(share * len(left))))]
        return left


def gains(new: list[float], old: list[float]) -> bool:
    """True if the paired differences over the folds are above zero by more than their standard error, and by a thousandth on the mean."""
    apart = np.array(new) - np.array(old)
    return bool(apart.mean() > 1e-3 and apart.mean() > apart.std(ddof=1) / np.sqrt(len(apart)))


def search_sets(scores: SetScores, single: Set, short: list[str], pairs_of: list[str], limit: int = MAX_FEATURES, late: Callable[[], bool] = lambda: False) -> Set:
    """The best set found: it starts as the better of ``single`` and the best pair, then grows by a feature of ``short`` (or of a pair that did well) or loses one while that gains."""
    last = len(RUNGS) - 1
    best = single
    starts = [tuple(sorted(p)) for p in combinations(pairs_of, 2)] if limit > 1 else []
    if late():
        return best
    good = scores.halved([*starts, *((f,) for f in short), single], "start", late=late)
    if late():
        return best
    final = scores.scores([*good[:8], best], last, "start")
    top = max(good[:8], key=lambda s: (float(np.mean(final[s])), s))
    if top != best and gains(final[top], final[best]):
        best = top
    pool = list(dict.fromkeys([*short, *(f for s in good[:8] for f in s)]))
    # Both starts grow, since the best pair may lead further than the single choices.
    done: list[Set] = []
    for start in dict.fromkeys((best, top)):
        now = start
        while not late():
            steps = [tuple(sorted((*now, f))) for f in pool if f not in now] if len(now) < limit else []
            steps += [tuple(x for x in now if x != f) for f in now] if len(now) > 2 else []
            if not steps:
                break
            came = scores.halved(steps, "change", 4, late)
            if late():
                break
            tried = scores.scores([came[0], now], last, "change")
            shorter = len(came[0]) < len(now)
            # One feature less needs no gain, only no loss.
            if not (gains(tried[came[0]], tried[now]) or shorter and np.mean(tried[came[0]]) >= np.mean(tried[now])):
                break
            now = came[0]
        done.append(now)
    if late():
        return best
    tried = scores.scores(done, last, "end")
    return max(done, key=lambda s: (round(float(np.mean(tried[s])), 9), -len(s), s))
