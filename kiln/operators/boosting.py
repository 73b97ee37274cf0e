"""Gradient boosting with symmetric trees on binned features: Newton leaves with a penalty, balanced classes, ordered category codes.

A tree of this kind asks one question a level, (feature, bin), of all its nodes, so all that a level needs are sums of gradients
and curvatures by (node, feature, bin). One model per fold and one for all rows are grown together: model ``m`` learns from the rows
of all folds but ``m``, and each pass over the rows serves all of them.

The sums are whole numbers (gradients in units of 2**-20), so they, and with them the trees, don't depend on how rows are dealt out.
That allows two ways with equal results. Up to ``local_rows`` rows, each model's binned rows (a byte a feature) go to one task, which grows all
its trees. Beyond, every level is a Spark job over the binned table: tasks return sums of fixed size, and every few rounds the
margins of all rows are checkpointed, so that a lost executor costs a few trees' work on its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import order_hash
from ..functions.encoders import ordered_target
from .store import cut, ship

UNIT = 1 << 20


@dataclass(frozen=True)
class BoostParams:
    """The scorer's settings; ``bins`` a feature (at most 256), rows that one task may hold, rounds between checkpoints of the other way."""

    rounds: int = 300
    rate: float = 0.05
    depth: int = 6
    l2: float = 3.0
    seed: int = 42
    bins: int = 64
    local_rows: int = 200_000
    refresh: int = 10


@dataclass
class Tree:
    splits: list[tuple[int, int]] = field(default_factory=list)
    #: Value of each leaf; bits of its number are the answers, the first question's highest.
    values: np.ndarray = field(default_factory=lambda: np.zeros(1))
    gains: list[float] = field(default_factory=list)

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(codes), np.int64)
        for f, b in self.splits:
            leaf = 2 * leaf + (codes[:, f] > b)
        return leaf


def gradients(y: np.ndarray, margin: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the log-likelihood in whole UNITs."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint(weight * (y - p) * UNIT), np.rint(weight * p * (1 - p) * UNIT)


def sums(codes: np.ndarray, leaf: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: int, bins: int) -> np.ndarray:
    """(node, feature, bin, 2) whole sums; exact, since floats below 2**53 are."""
    n, f = codes.shape
    at = ((leaf[:, None] * f + np.arange(f)) * bins + codes).ravel()
    return np.stack([np.bincount(at, np.repeat(x, f), nodes * f * bins) for x in (g, h)], -1).astype(np.int64).reshape(nodes, f, bins, 2)


def _quality(total: np.ndarray, l2: float) -> np.ndarray:
    return (total[..., 0] / UNIT) ** 2 / (total[..., 1] / UNIT + l2)


def best_split(held: np.ndarray, l2: float) -> tuple[tuple[int, int], float] | None:
    """The (feature, bin) that all nodes ask, by summed gain, ties to the first; None where nothing is gained."""
    left = held.cumsum(2)
    whole = left[:, :1, -1:]
    gain = (_quality(left, l2) + _quality(whole - left, l2) - _quality(whole, l2)).sum(0)
    gain[:, -1] = 0
    at = int(gain.argmax())
    best = float(gain.ravel()[at])
    return ((at // gain.shape[1], at % gain.shape[1]), best) if best > 1e-9 else None


def grow(level_sums: Callable[[list[tuple[int, int]]], np.ndarray], params: BoostParams) -> Tree:
    """One tree from the sums that ``level_sums(splits so far)`` gives for each level."""
    growing = Growing(params)
    while not growing.done:
        growing.take(level_sums(growing.tree.splits))
    return growing.tree


class Growing:
    """A tree that grows by a level for each table of sums it takes."""

    def __init__(self, params: BoostParams):
        self.tree, self.params, self.done = Tree(), params, False

    def take(self, held: np.ndarray) -> None:
        found = best_split(held, self.params.l2) if self.params.depth else None
        leaves = held[:, 0].sum(1)
        if found:
            (f, b), gain = found
            self.tree.splits.append((f, b))
            self.tree.gains.append(gain)
            left = held[:, f, : b + 1].sum(1)
            leaves = np.stack([left, leaves - left], 1).reshape(-1, 2)
        self.tree.values = self.params.rate * (leaves[:, 0] / UNIT) / (leaves[:, 1] / UNIT + self.params.l2)
        self.done = not found or len(self.tree.splits) == self.params.depth


def fit_rows(codes: np.ndarray, y: np.ndarray, weight: np.ndarray, params: BoostParams) -> list[Tree]:
    """All trees of one model from its rows."""
    margin, trees = np.zeros(len(y)), []
    for _ in range(params.rounds):
        g, h = gradients(y, margin, weight)
        tree = grow(lambda splits, g=g, h=h: sums(codes, Tree(splits).leaves(codes), g, h, 1 << len(splits), params.bins), params)
        margin = margin + tree.values[tree.leaves(codes)]
        trees.append(tree)
    return trees


def margins(trees: list[Tree], codes: np.ndarray, start: np.ndarray | float = 0.0) -> np.ndarray:
    out = np.zeros(len(codes)) + start
    for tree in trees:
        out = out + tree.values[tree.leaves(codes)]
    return out


class Batch:
    """Binned rows of an Arrow batch: ``codes(m)`` are model m's, whose category codes are its own."""

    def __init__(self, batch: pa.RecordBatch, n_numbers: int, n_texts: int, models: int):
        n = batch.num_rows
        self.y = batch.column("y").to_numpy().astype(float)
        self.fold = batch.column("fold").to_numpy()
        self.numbers = batch.column("numbers").flatten().to_numpy(zero_copy_only=False).reshape(n, n_numbers)
        self.texts = batch.column("texts").flatten().flatten().to_numpy(zero_copy_only=False).reshape(n, models, n_texts)

    def codes(self, m: int) -> np.ndarray:
        return np.concatenate([self.numbers, self.texts[:, m]], 1).astype(np.int64)


@dataclass
class Boosted:
    """Fitted models: those of the folds, then the one of all rows."""

    features: list[str]
    numbers: list[str]
    texts: list[str]
    cuts: dict[str, list[float]]
    #: Per text column a table ``value, s, n`` of the target's sum and count over all rows, and the overall mean.
    tables: dict[str, DataFrame]
    prior: float
    models: list[list[Tree]]
    params: BoostParams

    def importance(self) -> dict[str, float]:
        """Share of each feature in the gain of the model of all rows."""
        total = dict.fromkeys(self.features, 0.0)
        order = [*self.numbers, *self.texts]
        for tree in self.models[-1]:
            for (f, _), gain in zip(tree.splits, tree.gains, strict=True):
                total[order[f]] += gain
        whole = sum(total.values()) or 1.0
        return {f: v / whole for f, v in total.items()}

    def margin(self, rows: DataFrame, name: str = "margin") -> DataFrame:
        """``rows`` with the margin of the model of all rows; categories that it hasn't seen get the overall mean."""
        out = rows
        for i, c in enumerate(self.texts):
            table = self.tables[c].select(F.col("value").alias(f"__v{i}"), ((F.col("s") + self.prior) / (F.col("n") + 1)).alias(f"__t{i}"))
            out = out.join(table, F.col(f"`{c}`").eqNullSafe(F.col(f"__v{i}")), "left")
        coded = [F.coalesce(bin_of(F.coalesce(f"__t{i}", F.lit(self.prior)), self.params.bins), F.lit(0)) for i in range(len(self.texts))]
        packed = out.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"), F.lit(0).alias("y"), F.lit(-1).alias("fold"), numbers_of(self.cuts, self.numbers), F.array(as_array(coded)).alias("texts"))
        trees, shape = self.models[-1], (len(self.numbers), len(self.texts), 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(margins(trees, Batch(batch, *shape).codes(0)))], names=["row", "margin"])

        made = packed.mapInArrow(run, packed.select("row", F.lit(0.0).alias("margin")).schema)
        return made.select("row.*", F.col("margin").alias(name))


def as_array(columns: list[Column]) -> Column:
    return F.array(*columns).cast("array<int>")


def bin_of(share: Column, bins: int) -> Column:
    """Equal bins of [0, 1]."""
    return F.least(F.lit(bins - 1), F.floor(share * bins)).cast("int")


def quantile_cuts(df: DataFrame, columns: list[str], bins: int) -> dict[str, list[float]]:
    """At most ``bins - 1`` cuts a column, between its approximate quantiles."""
    if not columns:
        return {}
    at = [k / bins for k in range(1, bins)]
    found = df.agg(*(F.percentile_approx(F.col(f"`{c}`").cast("double"), at, 10_000).alias(c) for c in columns)).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def numbers_of(cuts: dict[str, list[float]], columns: list[str]) -> Column:
    """The number of cuts below each value."""

    def code(c: str) -> Column:
        value, some = F.col(f"`{c}`").cast("double"), cuts[c]
        # Bisection over the cuts: a few comparisons a value.
        def within(a: int, b: int) -> Column:
            if a == b:
                return F.lit(a)
            mid = (a + b) // 2
            return F.when(value > some[mid], within(mid + 1, b)).otherwise(within(a, mid))

        return within(0, len(some))

    return as_array([code(c) for c in columns]).alias("numbers")


def binned(rows: DataFrame, row_id: str, features: list[str], target: str, fold: str, folds: int, params: BoostParams) -> tuple[DataFrame, Boosted]:
    """``id, y, fold, numbers, texts`` of every row, and a model without trees.

    A text column becomes, for each model, the smoothed mean target of the rows of its category that come before the row in a hash order of the ids and that the
    model learns from, so a row's own target never reaches its code; rows that the model is tested on get the mean over all rows it learns from.
    """
    kinds = dict(rows.dtypes)
    texts = [f for f in features if kinds[f] == "string"]
    numbers = [f for f in features if f not in texts]
    y = F.col(target).cast("int")
    mean = rows.agg(F.avg(y)).first()[0] or 0.5
    out = rows.select(F.col(f"`{row_id}`").alias("id"), y.alias("y"), F.col(fold).cast("int").alias("fold"), *(F.col(f"`{f}`") for f in features))
    cuts = quantile_cuts(out, numbers, params.bins)
    tables, coded = {}, []
    if texts:
        out = out.withColumn("__order", order_hash(F.col("id"), params.seed))
        learns = {m: F.col("fold") != m for m in range(folds + 1)}
        for i, c in enumerate(texts):
            tables[c] = rows.groupBy(F.col(f"`{c}`").alias("value")).agg(F.sum(y).alias("s"), F.count(F.lit(1)).alias("n"))
            out = ordered_target(out, c, "y", "__order", {f"__c{i}_{m}": x for m, x in learns.items()}, mean)
    for m in range(folds + 1):
        coded.append(as_array([bin_of(F.col(f"__c{i}_{m}"), params.bins) for i in range(len(texts))]))
    out = out.select("id", "y", "fold", numbers_of(cuts, numbers), F.array(*coded).alias("texts"))
    return out, Boosted(features, numbers, texts, cuts, tables, mean, [], params)


def class_weight(counts: dict[tuple[int, int], int], m: int) -> np.ndarray:
    """Weight of classes 0 and 1 for model ``m``: the larger class's rows over the class's own."""
    own = [sum(n for (f, y), n in counts.items() if y == k and f != m) for k in (0, 1)]
    return np.array([max(own) / n if n else 0.0 for n in own])


def _local(data: DataFrame, shape: tuple[int, int, int], weights: list[np.ndarray], params: BoostParams) -> list[list[Tree]]:
    """A task a model, with that model's rows: at most ``local_rows`` of them."""
    models = shape[2]
    each = data.where("y is not null").select("y", "fold", "numbers", "texts", F.explode(F.sequence(F.lit(0), F.lit(models - 1))).alias("model")).where("fold <> model")
    each = each.select("y", "fold", "numbers", F.array(F.col("texts")[F.col("model")]).alias("texts"), "model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            rows, model = Batch(batch, shape[0], shape[1], 1), batch.column("model").to_numpy()
            codes = rows.codes(0).astype(np.uint8)
            for m in np.unique(model).tolist():
                held.setdefault(m, []).append((codes[model == m], rows.y[model == m]))
        for m, some in held.items():
            codes, y = (np.concatenate(x) for x in zip(*some, strict=True))
            trees = fit_rows(codes.astype(np.int64), y, weights[m][y.astype(int)], params)
            yield pa.RecordBatch.from_arrays(
                [pa.array([m] * len(trees)), pa.array(range(len(trees))), pa.array([[f for f, _ in t.splits] for t in trees], pa.list_(pa.int32())), pa.array([[b for _, b in t.splits] for t in trees], pa.list_(pa.int32())), pa.array([t.values for t in trees], pa.list_(pa.float64())), pa.array([t.gains for t in trees], pa.list_(pa.float64()))],
                names=["model", "round", "feature", "bin", "value", "gain"],
            )

    dealt = each.repartitionByRange(models, "model")
    out: list[list[Tree]] = [[] for _ in range(models)]
    found = dealt.mapInArrow(run, "model long, round long, feature array<int>, bin array<int>, value array<double>, gain array<double>").collect()  # models times rounds
    for r in sorted(found, key=lambda r: (r.model, r["round"])):
        out[r.model].append(Tree(list(zip(r.feature, r.bin, strict=True)), np.array(r.value), list(r.gain)))
    return out


def _distributed(data: DataFrame, shape: tuple[int, int, int], weights: list[np.ndarray], params: BoostParams) -> list[list[Tree]]:
    """A job a level, whose tasks return sums of fixed size for all models."""
    models, width = shape[2], shape[0] + shape[1]
    out: list[list[Tree]] = [[] for _ in range(models)]

    def passed(held: DataFrame, since: int, splits: list[list[tuple[int, int]] | None]) -> list[np.ndarray]:
        """Sums of every model that still grows, at the nodes of its splits so far; margins are ``since`` rounds old."""
        recent = [t[since:] for t in out]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                rows = Batch(batch, *shape)
                start = batch.column("margins").flatten().to_numpy(zero_copy_only=False).reshape(-1, models)
                for m, some in enumerate(splits):
                    use = rows.fold != m
                    if some is not None and use.any():
                        codes, y = rows.codes(m)[use], rows.y[use]
                        g, h = gradients(y, margins(recent[m], codes, start[use, m]), weights[m][y.astype(int)])
                        add = sums(codes, Tree(some).leaves(codes), g, h, 1 << len(some), params.bins)
                        total[m] = total[m] + add if m in total else add
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["model", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for m, raw in zip(batch.column("model").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                    x = np.frombuffer(raw, np.int64)
                    total[m] = total[m] + x if m in total else x
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["model", "sums"])

        made = [np.zeros((1 << len(s or ()), width, params.bins, 2), np.int64) for s in splits]
        for r in held.mapInArrow(run, "model int, sums binary").repartition(models, "model").mapInArrow(add, "model int, sums binary").collect():  # a row a model
            made[r.model] = np.frombuffer(r.sums, np.int64).reshape(made[r.model].shape)
        return made

    def moved(held: DataFrame, since: int) -> DataFrame:
        recent = [t[since:] for t in out]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = Batch(batch, *shape)
                start = batch.column("margins").flatten().to_numpy(zero_copy_only=False).reshape(-1, models)
                now = np.stack([margins(recent[m], rows.codes(m), start[:, m]) for m in range(models)], 1)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("y", "fold", "numbers", "texts")), pa.array(list(now), pa.list_(pa.float64()))], names=["y", "fold", "numbers", "texts", "margins"])

        return held.mapInArrow(run, held.schema)

    held, since = cut(data.where("y is not null").select("y", "fold", "numbers", "texts", F.array(*[F.lit(0.0)] * models).alias("margins"))), 0
    for done in range(params.rounds):
        if done - since == params.refresh:
            held, since = cut(moved(held, since)), done
        growing = [Growing(params) for _ in range(models)]
        while not all(x.done for x in growing):
            for x, held_sums in zip(growing, passed(held, since, [None if x.done else x.tree.splits for x in growing]), strict=True):
                if not x.done:
                    x.take(held_sums)
        for m, x in enumerate(growing):
            out[m].append(x.tree)
    return out


def fit(rows: DataFrame, row_id: str, features: list[str], target: str, fold: str | None = None, folds: int = 0, params: BoostParams = BoostParams()) -> tuple[Boosted, DataFrame]:
    """Models of all folds and of all rows, and ``id, y, fold, margin`` with each row's margin by the model that hasn't seen it (null without folds).

    ``rows`` have no missing features (``fill_missing``); rows without a target are not learnt from. Ids must be unique for codes of text columns to be repeatable.
    """
    if not features:
        raise ValueError("no features")
    ship(rows.sparkSession)
    rows = rows if fold else rows.withColumn("__fold", F.lit(-1))
    data, model = binned(rows, row_id, features, target, fold or "__fold", folds, params)
    data = cut(data)
    counts = {(r.fold, r.y): r["count"] for r in data.where("y is not null").groupBy("fold", "y").count().collect()}  # folds times classes
    shape = (len(model.numbers), len(model.texts), folds + 1)
    weights = [class_weight(counts, m) for m in range(folds + 1)]
    way = _local if sum(counts.values()) <= params.local_rows else _distributed
    model.models = way(data, shape, weights, params)
    if any(not t for t in model.models):
        raise ValueError("a fold leaves no rows to learn from")
    trees = model.models

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got, out = Batch(batch, *shape), np.full(batch.num_rows, np.nan)
            for m in range(folds):
                use = got.fold == m
                if use.any():
                    out[use] = margins(trees[m], got.codes(m)[use])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "y", "fold")), pa.array(out, mask=np.isnan(out))], names=["id", "y", "fold", "margin"])

    used = data.where("y is not null")
    return model, used.mapInArrow(run, used.select("id", "y", "fold", F.lit(None).cast("double").alias("margin")).schema)
