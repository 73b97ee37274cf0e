"""From a folder of tables and a task to matching train and test feature tables."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import noise
from ..operators.evaluate import BoostParams, cv_scores
from ..operators.features import FeatureSpec, column_specs, compile_features, grammar
from ..operators.joins import lookup_left
from ..operators.profile import common_values, join_graph, key_check, last_days
from ..operators.search import PAIR_FEATURES, Sample, SetScores, auc_bounds, best_features, distance, search_sets
from ..operators.select import SHORTLIST, spread
from ..sources.catalog import TableCatalog, descriptions, join_hints, prose_hints
from ..sources.csv import write_csv


@dataclass(frozen=True)
class TaskSpec:
    id_col: str
    target_col: str
    metric: str = "roc_auc"
    max_features: int = 5
    #: Seconds of the whole run; the search gets ``search_share`` of them, the rest is for writing.
    budget_s: float = 600.0
    search_share: float = 0.8
    #: The booster that compares the last sets over all rows.
    judge: BoostParams = BoostParams(rounds=50)
    #: True: columns of train or test beside id and target raise. False: they are read, may become features, and aren't written through.
    strict: bool = False


@dataclass(frozen=True)
class RunRecord:
    """What a run did: the chosen features, seconds, and the facts of the written rows."""

    chosen: list[str]
    seconds: float
    candidates: int
    stopped: bool
    train_rows: int
    test_rows: int

    def table(self, spark: SparkSession) -> DataFrame:
        """The record as one row."""
        return spark.createDataFrame([(self.chosen, round(self.seconds, 3), self.candidates, self.stopped, self.train_rows, self.test_rows)], "chosen array<string>, seconds double, candidates long, stopped boolean, train_rows long, test_rows long")


@contextmanager
def within(spark: SparkSession, seconds: float) -> Iterator[None]:
    """A block of ``seconds``: from then on its Spark jobs are cancelled, again and again while it lasts, and it ends with ``TimeoutError``, whatever it was doing."""
    if seconds <= 0:
        raise TimeoutError("no time left")
    tag, over, done = f"kiln-{uuid.uuid4().hex}", threading.Event(), threading.Event()

    def guard() -> None:
        if not done.wait(seconds):
            over.set()
            while True:
                spark.sparkContext.cancelJobsWithTag(tag)
                if done.wait(0.1):
                    break

    watch = threading.Thread(target=guard, daemon=True)
    spark.sparkContext.addJobTag(tag)
    watch.start()
    try:
        yield
    except Exception as e:
        if over.is_set():
            raise TimeoutError(f"stopped after {seconds:.0f} s") from e
        raise
    finally:
        done.set()
        spark.sparkContext.removeJobTag(tag)
    if over.is_set():
        raise TimeoutError(f"stopped after {seconds:.0f} s")


def _names(key: str | tuple[str, ...]) -> tuple[str, ...]:
    return (key,) if isinstance(key, str) else key


def _meant(child: tuple[str, ...], parent: tuple[str, ...]) -> bool:
    """Ends like "id" say nothing of what is meant, so such columns must have equal names; of several columns, each."""
    return all(c == k or c.partition("_")[2].lower() not in ("id", "key", "no", "code") for c, k in zip(child, parent, strict=True))


def history_tables(catalog: TableCatalog, id_col: str) -> dict[str, DataFrame]:
    """Side tables with the id: those that carry it, then those that joins lead to, over any number of hops, each by its shortest way.

    A child of the ids takes them under its own key's place; a child of a table takes the ids of its parent row; a parent takes those of its child rows.
    """
    sides = {n: catalog[n] for n in catalog if n not in ("train", "test", "readme")}
    found = {n: df for n, df in sides.items() if id_col in df.columns}
    if len(found) == len(sides):
        return found
    ids = catalog["train"].select(id_col).union(catalog["test"].select(id_col)).distinct()
    columns = {n: df.columns for n, df in sides.items()} | {"train": [id_col], "test": [id_col]}
    text = catalog.readme()
    said = {("__ids" if a in ("train", "test") else a, b, "__ids" if c in ("train", "test") else c, k) for a, b, c, k in {*join_hints(descriptions(text, list(columns)), columns), *(link for link, _ in prose_hints(text, columns))}}
    links = [(t, _names(c), p, _names(k)) for t, c, p, k in join_graph({**sides, "__ids": ids}, hints=said)]
    said = {(t, (c,), p, (k,)) for t, c, p, k in said}
    links = [x for x in links if x in said or _meant(x[1], x[3])]
    near = {"__ids": ids, **found}

    def joined(df: DataFrame, own: tuple[str, ...], other: DataFrame, theirs: tuple[str, ...]) -> DataFrame | None:
        """``df`` with the ids of the rows of ``other`` that it meets; None where a key column is gone."""
        if id_col in theirs:
            return df.withColumnRenamed(own[theirs.index(id_col)], id_col)
        if not set(theirs) <= set(other.columns) or id_col in own:
            return None
        return df.join(other.select(*(F.col(f"`{k}`").alias(c) for c, k in zip(own, theirs, strict=True)), id_col).distinct(), list(own))

    while near:
        new: dict[str, DataFrame] = {}
        for child, c, parent, k in links:
            for one, a, other, b in ((child, c, parent, k), (parent, k, child, c)):
                if other in near and (other != "__ids" or one == child) and one in sides and one not in found and one not in new:
                    made = joined(sides[one], a, near[other], b)
                    if made is not None:
                        new[one] = made
                        break
        found.update(new)
        near = new
    return found


def candidate_specs(tables: dict[str, DataFrame], id_col: str, target: str) -> list[FeatureSpec]:
    """Lookups of tables with one row an id, the grammar's aggregates of the others."""
    specs: list[FeatureSpec] = []
    for name, df in tables.items():
        values = common_values(df.drop(id_col, target))
        if key_check(df, [id_col]).first().is_key:
            specs += column_specs(name, "lookup", df, id_col, (target,), values)
        else:
            specs += grammar(name, df, id_col, (target,), values, last_days(df.drop(id_col, target)))
    return specs


def own_specs(train: DataFrame, test: DataFrame, id_col: str, target: str) -> list[FeatureSpec]:
    """The columns that train and test share besides the id."""
    shared = [c for c, kind in train.dtypes if c not in (id_col, target) and (c, kind) in test.dtypes]
    both = train.select(*shared).union(test.select(*shared))
    return column_specs("own", "own", both, id_col, (target,), common_values(both)) if shared else []


def ensure_target(train: DataFrame, source: DataFrame, spec: TaskSpec) -> DataFrame:
    """``train`` with its target, looked up by id where it lacks it."""
    if spec.target_col in train.columns:
        return train
    return lookup_left(train, source.select(spec.id_col, spec.target_col), [spec.id_col], unique=True)


def noise_features(ids: DataFrame, id_col: str, n: int = 5, seed: int = 42) -> DataFrame:
    """The baseline: ``ft_1`` .. ``ft_n``, standard normal numbers that follow from the id."""
    return ids.withColumns({f"ft_{i + 1}": noise(F.col(id_col), seed + i) for i in range(n)})


def search(made: DataFrame, names: list[str], spec: TaskSpec, target: str, until: float) -> tuple[list[str], bool]:
    """The best set found until then, and whether time ran out.

    First the best features by bounds, which one pass gives: from then on there is a set to fall back on. Then single choice, pairs and growing sets on a sample,
    then the booster over all rows between the two. Each step is cut when its time is over, and the last set that was finished stands; without any, ``TimeoutError``.
    """
    spark = made.sparkSession
    left = lambda: until - time.perf_counter()
    with within(spark, left()):
        sample = Sample.of(made, spec.id_col, names, target)
        bounds = auc_bounds(made, target, sample)
    if not bounds:
        raise ValueError("no candidate feature varies")
    best = sorted(bounds, key=lambda f: (-sum(distance(bounds[f])), f))[: spec.max_features]
    try:
        with within(spark, left()):
            usable = [f for f in sorted(bounds, key=lambda f: (-distance(bounds[f])[1], f))]
            short = best_features(made, target, bounds, max(SHORTLIST, spec.max_features))
            best = spread(short, sample.near, spec.max_features)
            scores = SetScores(spark, sample)
            grown = search_sets(scores, tuple(sorted(best)), short, usable[:PAIR_FEATURES], spec.max_features, late=lambda: left() <= 0)
        if set(grown) != set(best):
            with within(spark, left()):
                sets = {"grown": list(grown), "single": best}
                mean = {k: cv_scores(made.select(spec.id_col, target, *some), spec.id_col, some, target, params=spec.judge).agg(F.avg("auc")).first()[0] or 0.0 for k, some in sets.items()}
            best = list(grown) if mean["grown"] >= mean["single"] else best
    except TimeoutError:
        return best, True
    return best, False


def outputs(train: DataFrame, test: DataFrame, spec: TaskSpec, tables: dict[str, DataFrame], kept: list[FeatureSpec], chosen: list[str]) -> dict[str, DataFrame]:
    """Both results in one schema: id, target (train only), the chosen features, and nothing else."""
    made = {k: compile_features(df, spec.id_col, tables, kept) for k, df in (("train", train), ("test", test))}
    return {k: df.select(spec.id_col, *([spec.target_col] if k == "train" else []), *chosen) for k, df in made.items()}


def written(df: DataFrame, ids: DataFrame, id_col: str, features: list[str], path: str) -> tuple[int, list[str]]:
    """Writes one output and returns its rows and what is wrong with them, from facts observed while the rows were written: no pass of its own.

    Ids are compared as multisets by their number and the sum of their hashes.
    """
    mark = lambda c: F.sum(F.xxhash64(F.col(f"`{c}`")).cast("decimal(38,0)"))
    facts = Observation()
    kinds = dict(df.dtypes)
    some = [F.count(F.nanvl(F.col(f"`{f}`"), F.lit(None)) if kinds[f] in ("double", "float") else F.col(f"`{f}`")).alias(f"some_{i}") for i, f in enumerate(features)]
    write_csv(df.observe(facts, F.count(F.lit(1)).alias("n"), mark(id_col).alias("ids"), *some), path)
    got, want = facts.get, ids.agg(F.count(F.lit(1)).alias("n"), mark(id_col).alias("ids")).first()
    broken = [f"{path}: feature {f} is empty" for i, f in enumerate(features) if not got[f"some_{i}"]]
    if (got["n"], got["ids"]) != (want.n, want.ids):
        broken.append(f"{path}: {got['n']} rows for {want.n} ids, or other ids")
    return got["n"], broken


def run_recorded(spark: SparkSession, data_dir: str, out_dir: str, spec: TaskSpec) -> RunRecord:
    """Read the folder, choose at most ``max_features`` features on train, write ``train.csv`` and ``test.csv``, all within ``budget_s`` seconds."""
    began = time.perf_counter()
    until = began + spec.budget_s * spec.search_share
    with within(spark, spec.budget_s * spec.search_share):
        catalog = TableCatalog(spark, data_dir)
        train, test = catalog["train"], catalog["test"]
        if spec.target_col not in train.columns:
            known = [n for n in catalog if n not in ("train", "test", "readme") and {spec.id_col, spec.target_col} <= set(catalog[n].columns)]
            if not known:
                raise ValueError(f"no table has {spec.id_col} and {spec.target_col}")
            train = ensure_target(train, catalog[known[0]], spec)
        extra = [c for c in dict.fromkeys([*train.columns, *test.columns]) if c not in (spec.id_col, spec.target_col)]
        if spec.strict and extra:
            raise ValueError(f"columns beside id and target: {extra}")
        values = train.select(spec.target_col).distinct().limit(3).collect()
        if len(values) != 2:
            raise ValueError("the target needs exactly two values")
        tables = history_tables(catalog, spec.id_col)
        specs = candidate_specs(tables, spec.id_col, spec.target_col) + own_specs(train, test, spec.id_col, spec.target_col)
    if not specs:
        raise ValueError("no table can be joined to the ids")
    high = max(v[0] for v in values)
    labelled = train.withColumn("__y", (F.col(spec.target_col) == F.lit(high)).cast("int"))
    made = compile_features(labelled, spec.id_col, tables, specs).cache()
    try:
        chosen, stopped = search(made, [s.name for s in specs], spec, "__y", until)
    finally:
        made.unpersist()
    out = outputs(train, test, spec, tables, [s for s in specs if s.name in chosen], chosen)
    with within(spark, began + spec.budget_s - time.perf_counter()):
        wrote = {k: written(out[k], df, spec.id_col, chosen, f"{out_dir}/{k}.csv") for k, df in (("train", train), ("test", test))}
        if broken := [x for _, some in wrote.values() for x in some]:
            raise ValueError(f"output contract: {broken}")
    return RunRecord(chosen, time.perf_counter() - began, len(specs), stopped, wrote["train"][0], wrote["test"][0])


def run(spark: SparkSession, data_dir: str, out_dir: str, spec: TaskSpec) -> list[str]:
    """``run_recorded``, of which only the chosen names come back."""
    return run_recorded(spark, data_dir, out_dir, spec).chosen
