"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a few counts and shares. Each is cut into bins at quantiles of the training rows. Boosting goes round
the features: in every round each feature in turn gets a shallow tree over its bins, fitted to the gradient of the
logistic loss and added, at a low rate, to that feature's lookup table. Then the pairs of features whose coarse
grid explains most of what is left are boosted the same way. A score is the sum of one entry of each table.

Fitting takes at most ``TRAIN_ROWS`` labelled rows, those whose doc_id hashes lowest; only their bin numbers come to the driver. All
documents are scored, whole.

Defined results: null text counts as empty and is scored like it; labels null or other than 0 and 1, and labels without a
document, are not learnt from; with one class or no label at all the score is the smoothed share of label 1 for every
text; repeated rows of labels and documents count as often as they occur, up to ``TRAIN_ROWS`` rows in all; an empty table gives no rows; further columns of the table are kept by ``score``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import add_columns, beside, together
from .common import mix64, table

#: The most labelled rows that a fit takes.
TRAIN_ROWS = 20_000
BINS = 32
GRID = 6
PAIRS = 8
ROUNDS = 120
PAIR_ROUNDS = 60
RATE = 0.1
MIN_LEAF = 10.0

FEATURES = (
    "log_bytes", "letter", "upper", "digit", "blank", "comma_stop", "exclaim", "pipe", "symbol", "symbol_run",
    "high_byte", "mean_word", "long_word", "distinct_words", "distinct_lines", "top_word", "newline", "quote",
)

_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b",.", b"!", b"|", b"#$%&*@^~=+<>_\\/{}[]", bytes(range(128, 256)), b"\n", b"'\"();:?-"), 1):
    _CLASS[list(_chars)] = _k


def features(texts: list[str]) -> np.ndarray:
    """One row of FEATURES per text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        raw = text.encode()
        if not raw:
            continue
        n = len(raw)
        kinds = _CLASS[np.frombuffer(raw, np.uint8)]
        c = np.bincount(kinds, minlength=12) / n
        symbols = kinds == 8
        words = raw.split()
        w = len(words) or 1
        distinct = len(set(words))
        lines = raw.split(b"\n")
        lower = c[1] + c[9]
        out[i] = (
            np.log1p(n), lower + c[2], c[2] / (lower + c[2] + 1e-9), c[3], c[4], c[5], c[6], c[7], c[8],
            np.count_nonzero(symbols[1:] & symbols[:-1]) / n, c[9], (n - w) / w, max(map(len, words), default=0) / (10 + w),
            distinct / w, len(set(lines)) / len(lines), (w - distinct) / (1 + distinct), c[10], c[11],
        )
    return out


def tree(grad: np.ndarray, hess: np.ndarray, depth: int = 2) -> np.ndarray:
    """A step per bin: a tree of ``depth`` cuts on the ordered bins, leaves valued by the Newton step."""
    out = np.zeros(len(grad))

    def grow(lo: int, hi: int, d: int) -> None:
        g, h = grad[lo:hi].sum(), hess[lo:hi].sum()
        if d and hi - lo > 1:
            lg, lh = np.cumsum(grad[lo : hi - 1]), np.cumsum(hess[lo : hi - 1])
            fit = lg**2 / (lh + 1) + (g - lg) ** 2 / (h - lh + 1)
            fit[(lh < MIN_LEAF / 4) | (h - lh < MIN_LEAF / 4)] = -1
            k = int(np.argmax(fit))
            if fit[k] > g**2 / (h + 1) + 1e-9:
                grow(lo, lo + k + 1, d - 1)
                grow(lo + k + 1, hi, d - 1)
                return
        out[lo:hi] = g / (h + 1)

    grow(0, len(grad), depth)
    return out


def grid_tree(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """A step per cell of a grid: the best cut of one axis, then of the other within each part."""
    best, out = -1.0, np.zeros(grad.shape)
    for axis in (0, 1):
        g, h = (grad, hess) if axis == 0 else (grad.T, hess.T)
        for k in range(1, g.shape[0]):
            made, gain = np.zeros(g.shape), 0.0
            for part in (slice(0, k), slice(k, None)):
                row = tree(g[part].sum(0), h[part].sum(0), 1)
                made[part] = row
                gain += (row * (2 * g[part].sum(0) - row * (h[part].sum(0) + 1e-9))).sum()
            if gain > best:
                best, out = gain, made if axis == 0 else made.T
    return out


class Additive:
    """Bin edges, a table per feature, a grid per pair, and the intercept."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.coarse = [np.minimum(np.arange(len(e) + 1) * GRID // (len(e) + 1), GRID - 1) for e in self.edges]
        self.pairs: list[tuple[int, int]] = []
        self.grids: list[np.ndarray] = []
        if len(np.unique(y)) == 2:
            self._fit(self.bins(x), y)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def _fit(self, bins: np.ndarray, y: np.ndarray) -> None:
        raw = np.full(len(y), self.base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-raw))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for j, t in enumerate(self.tables):
                g, h = slopes()
                step = RATE * tree(np.bincount(bins[:, j], g, len(t)), np.bincount(bins[:, j], h, len(t)))
                t += step
                raw += step[bins[:, j]]
        coarse = np.stack([c[bins[:, j]] for j, c in enumerate(self.coarse)], 1)
        cell = lambda a, b: coarse[:, a] * GRID + coarse[:, b]
        g, h = slopes()
        gains = []
        for a in range(bins.shape[1]):
            for b in range(a + 1, bins.shape[1]):
                gg, hh = np.bincount(cell(a, b), g, GRID**2), np.bincount(cell(a, b), h, GRID**2)
                gains.append((-(gg**2 / (hh + 1)).sum(), a, b))
        self.pairs = [(a, b) for _, a, b in sorted(gains)[:PAIRS]]
        self.grids = [np.zeros((GRID, GRID)) for _ in self.pairs]
        cells = [cell(a, b) for a, b in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for at, grid in zip(cells, self.grids, strict=True):
                g, h = slopes()
                shape = (GRID, GRID)
                step = RATE * grid_tree(np.bincount(at, g, GRID**2).reshape(shape), np.bincount(at, h, GRID**2).reshape(shape))
                grid += step
                raw += step.ravel()[at]

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        raw = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            raw += t[bins[:, j]]
        for (a, b), grid in zip(self.pairs, self.grids, strict=True):
            raw += grid[self.coarse[a][bins[:, a]], self.coarse[b][bins[:, b]]]
        return 1 / (1 + np.exp(-raw))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """True where crc32 of the id's text leaves 1 by 3; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Additive:
    """Fit on the labelled, not held-out documents whose ids hash lowest, at most ``train_rows`` of them."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("l_id"), "quality")
    chosen = known.where(~held_out("l_id")).orderBy(F.xxhash64("l_id"), "quality").limit(train_rows)
    # At most train_rows rows of two numbers are broadcast, so texts are not shuffled. Ids may repeat in documents too, so rows are limited again.
    rows = docs.select(F.col("doc_id").alias("d_id"), "text").join(F.broadcast(chosen), F.col("d_id") == F.col("l_id"))
    rows = rows.select("text", "quality", F.xxhash64("d_id", "text", "quality").alias("turn"))
    if rows.select("turn").limit(train_rows + 1).count() > train_rows:
        last = rows.select("turn").orderBy("turn").limit(train_rows).agg(F.max("turn")).first()[0]
        rows = rows.where(F.col("turn") <= last).limit(train_rows)
    measured = add_columns(rows, "text", ["quality"], T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))]), lambda: lambda texts: [pa.array(list(features(texts)), pa.list_(pa.float64()))])
    got = measured.toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    y = got["quality"].to_numpy(float)
    # Rows arrive in any order; sums of floating point numbers should not depend on it.
    with np.errstate(over="ignore"):
        key = mix64(np.ascontiguousarray(x).view(np.uint64)).sum(1, dtype=np.uint64)
    order = np.lexsort((y, key))
    return Additive(x[order], y[order])


def score(docs: DataFrame, model: Additive, keep: list[str]) -> DataFrame:
    """``keep`` and ``score``, from 0 to 1; higher: quality 1 is likelier. The model is a few small tables."""
    added = T.StructType([T.StructField("score", T.DoubleType())])
    return add_columns(docs, "text", keep, added, lambda: lambda texts: [pa.array(model.score(features(texts)))])


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """The pipeline's stage: documents scored at least ``least``, with their columns. Held-out labels are not learnt from here either."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(beside(docs, "text", "row", "text"), model, ["row", "text"])
    return scored.where(F.col("score") >= least).select(*together(docs.columns, "text", "row", F.col("text")))
