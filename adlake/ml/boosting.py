"""ML9: multiclass boosted trees by softmax gradients and grouped histograms.

Every round grows one tree of each class on the gradients of the log-loss.  A
level is one aggregate over the rows: gradients and hessians summed by model,
class, node, feature and bin, first in each task (a row goes no further than
the task that reads it), then over the tasks: a table whose size the bins bound
and the only thing that comes to the driver, which picks the best split of each
node from it.  Rows go left or right by column expressions.  Sums are taken over
integers (gradients in units of 2^-32), so a fit is the same whatever the
partitioning.

Cross-validation grows the models of all folds in the same passes: a row is
repeated for each model, and trains those of other folds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from adlake.session import materialise

UNIT = 1 << 32
MOST_CATEGORIES = 256
MOST_AT_ONCE = 1 << 20  # rows whose integers are summed as doubles, exactly


@dataclass(frozen=True)
class Bins:
    """Features as small integers: a number's place among its cut points (0 for
    NULL and NaN), and for each category 1 or 0.  Categories not listed, and
    NULL, are 0 everywhere."""

    numeric: dict[str, list[float]]
    categorical: dict[str, list[str]]

    def column(self) -> Column:
        out = []
        for name, cuts in self.numeric.items():
            x = F.col(f"`{name}`").cast("double")
            place = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>"), lambda c: c < x)) + 1
            out.append(F.when(x.isNull() | F.isnan(x), 0).otherwise(place))
        for name, values in self.categorical.items():
            out += [F.col(f"`{name}`").eqNullSafe(F.lit(v)).cast("int") for v in values]
        return F.array(*out).cast("array<int>")


def fit_bins(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int = 32) -> Bins:
    """Cut points at approximate quantiles, and the most frequent categories,
    MOST_CATEGORIES at most for a column."""
    shares = [i / bins for i in range(1, bins)]
    cuts = {}
    for name in numeric:
        x = F.col(f"`{name}`").cast("double")
        found = df.where(~F.isnan(x)).agg(F.percentile_approx(x, shares, 10_000)).first()[0] or []
        cuts[name] = sorted({float(v) for v in found})
    values = {}
    for name in categorical:
        counts = df.where(F.col(f"`{name}`").isNotNull()).groupBy(F.col(f"`{name}`").cast("string").alias("v")).agg(F.count("*").alias("n"))
        values[name] = sorted(r["v"] for r in counts.orderBy(F.desc("n"), "v").limit(MOST_CATEGORIES).collect())
    return Bins(cuts, values)


@dataclass
class Boosted:
    """Trees by round, model and class: for each inner node, numbered from 1 as
    in a heap, the feature (-1: all go left) and the last bin that goes left;
    the leaves' scores."""

    classes: int
    models: int
    depth: int
    feature: list[np.ndarray] = field(default_factory=list)  # each models x classes x 2^depth
    last: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)  # models x classes x 2^depth

    def probabilities(self, bins: Column, model: int = 0) -> Column:
        """Array of class probabilities of a column of bins."""
        trees = [(self.feature[r][model], self.last[r][model], self.leaf[r][model]) for r in range(len(self.leaf))]
        classes, depth = self.classes, self.depth

        @arrow_udf("array<double>")
        def scored(col: pa.Array) -> pa.Array:
            width = len(col[0]) if len(col) else 0
            x = col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), width)
            scores = np.zeros((len(x), classes))
            for feature, last, leaf in trees:
                for k in range(classes):
                    node = np.ones(len(x), np.int64)
                    for _ in range(depth):
                        f = feature[k][node]
                        node = 2 * node + ((f >= 0) & (x[np.arange(len(x)), np.maximum(f, 0)] > last[k][node]))
                    scores[:, k] += leaf[k][node - (1 << depth)]
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            return pa.array(list(scores / scores.sum(axis=1, keepdims=True)), pa.list_(pa.float64()))

        return scored(bins)


def softmax(scores: Column) -> Column:
    def once(value: Column, then) -> Column:  # a lambda's variable is evaluated once, an expression in a lambda for every element
        return F.get(F.transform(F.array(value), then), 0)

    powers = once(F.array_max(scores), lambda most: F.transform(scores, lambda s: F.exp(s - most)))
    shares = lambda powers: once(F.aggregate(powers, F.lit(0.0), lambda a, b: a + b), lambda whole: F.transform(powers, lambda e: e / whole))
    return once(powers, shares)


def best_split(g: np.ndarray, h: np.ndarray, reg: float, least: float) -> tuple[float, int, int]:
    """(gain, feature, last bin to the left) of a node from its sums by feature
    and bin; feature -1 if no split gains.  Ties go to the first feature and bin."""
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    all_g, all_h = g[0].sum(), h[0].sum()
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g ** 2 / (left_h + reg) + right_g ** 2 / (right_h + reg) - all_g ** 2 / (all_h + reg)
    gain = np.where((left_h >= least) & (right_h >= least), np.round(gain, 9), -math.inf)
    if not gain.size or gain.max() <= 0:
        return 0.0, -1, 0
    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return float(gain[f, b]), int(f), int(b)


def _table(values: np.ndarray, kind: str) -> Column:
    """A literal array by model, class and node."""
    return F.lit(values.ravel().tolist()).cast(f"array<{kind}>")


def _histograms(rows: DataFrame, feature: np.ndarray, last: np.ndarray, level: int, features: int, highest: int) -> DataFrame:
    """(cell, g, h): sums of the classes' `g` and `h` over rows (model, b, g, h)
    at a level, by cell: model, class, node, feature and bin as one number.  The
    levels above are in `feature` and `last`, each models x classes x 2^depth."""
    models, classes, _ = feature.shape
    first, width = 1 << level, features * (highest + 1)
    size = models * first * width  # cells of a class

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, classes, size), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, MOST_AT_ONCE):
                batch = whole.slice(at, MOST_AT_ONCE)
                n, b = batch.num_rows, batch.column("b")
                sizes = pc.fill_null(pc.list_value_length(b), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                row, bins = np.repeat(np.arange(n), sizes), b.flatten().to_numpy(zero_copy_only=False)
                f = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                table = np.full((n, features), -1)  # no bin goes left, as a missing one does
                table[row, f] = bins
                cell = f * (highest + 1) + bins
                parts = [batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(n, classes) for c in ("g", "h")]
                model = batch.column("model").to_numpy(zero_copy_only=False).astype(np.int64)
                for k in range(classes):
                    node = np.ones(n, np.int64)
                    for _ in range(level):
                        at = feature[model, k, node]
                        node = 2 * node + ((at >= 0) & (table[np.arange(n), np.maximum(at, 0)] > last[model, k, node]))
                    cells = ((model * first + node - first) * width)[row] + cell
                    for i, part in enumerate(parts):
                        sums[i, k] += np.bincount(cells, weights=part[row, k], minlength=size).astype(np.int64)
        k, cell = np.nonzero(sums.any(axis=0))
        model, rest = np.divmod(cell, first * width)
        yield pa.RecordBatch.from_arrays([pa.array((model * classes + k) * first * width + rest), pa.array(sums[0, k, cell]), pa.array(sums[1, k, cell])], names=["cell", "g", "h"])

    return rows.mapInArrow(summed, "cell bigint, g bigint, h bigint").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def boost(rows: DataFrame, label: str, bins: str, classes: int, models: int = 1, rounds: int = 100, depth: int = 3, eta: float = 0.3,
          reg: float = 1.0, least: float = 1.0, held_out: str | None = None) -> tuple[Boosted, DataFrame]:
    """Fit on `rows`, with a class number `label` (0..classes-1) and an array of
    `bins`.  With `held_out`, a column of fold numbers 0..models-1, model m
    trains on the rows of other folds.  Returns the trees, and the rows with
    `model` and `scores` for every model.  NULL labels train nothing."""
    spark: SparkSession = rows.sparkSession
    trains = F.col(label).isNotNull() & (F.lit(True) if held_out is None else ~F.col(held_out).eqNullSafe(F.col("model")))
    state = rows.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(models - 1)))).withColumn("trains", trains)
    state = state.withColumn("scores", F.array_repeat(F.lit(0.0), classes))

    def stepped(state: DataFrame) -> DataFrame:
        """With the gradients and hessians of the scores, evaluated once a round."""
        g = F.transform("p", lambda p, k: F.round((p - (F.col(label) == k).cast("double")) * UNIT).cast("bigint"))
        h = F.transform("p", lambda p: F.round(p * (1 - p) * UNIT).cast("bigint"))
        return materialise(state.withColumn("p", softmax(F.col("scores"))).withColumn("g", g).withColumn("h", h).drop("p"), "boost-rows")

    state = stepped(state)
    width = state.agg(F.max(F.size(bins)), F.max(F.array_max(bins))).first()  # two numbers
    features, highest = (width[0] or 0), (width[1] or 0)
    out = Boosted(classes, models, depth)
    if not features:
        return out, state.drop("trains", "g", "h")
    size = 1 << depth
    for _ in range(rounds):
        feature, last = np.full((models, classes, size), -1), np.zeros((models, classes, size), int)
        weight = np.zeros((models, classes, size, 2))  # sums of a node at the level below
        for level in range(depth):
            trained = state.where("trains").select("model", F.col(bins).alias("b"), "g", "h")
            sums = _histograms(trained, feature, last, level, features, highest).toArrow()
            first = 1 << level
            grid = np.zeros((2, models, classes, first, features, highest + 1))
            for i, c in enumerate(("g", "h")):
                grid[i].ravel()[sums.column("cell").to_numpy()] = sums.column(c).to_numpy() / UNIT
            below = np.zeros((models, classes, size, 2))
            for i in range(models):
                for c in range(classes):
                    for n in range(first):
                        gg, hh = grid[0, i, c, n], grid[1, i, c, n]
                        _, at, to = best_split(gg, hh, reg, least)
                        feature[i, c, first + n], last[i, c, first + n] = at, to
                        whole = np.array([gg[0].sum(), hh[0].sum()])
                        left = whole if at < 0 else np.array([gg[at, : to + 1].sum(), hh[at, : to + 1].sum()])
                        below[i, c, 2 * n], below[i, c, 2 * n + 1] = left, whole - left
            weight = below
        fs, bs = _table(feature, "int"), _table(last, "int")

        def place(k: Column, node: Column) -> Column:
            return (F.col("model") * classes + k) * size + node

        def goes(node: Column, k: Column) -> Column:
            at = F.get(fs, place(k, node))
            return 2 * node + F.when((at >= 0) & (F.get(bins, at) > F.get(bs, place(k, node))), 1).otherwise(0)

        state = state.withColumn("nodes", F.array_repeat(F.lit(1), classes))
        for _ in range(depth):
            state = state.withColumn("nodes", F.transform("nodes", goes))
        leaf = -eta * weight[..., 0] / (weight[..., 1] + reg)
        leaves = _table(leaf, "double")
        raised = F.transform("scores", lambda s, k: s + F.get(leaves, (F.col("model") * classes + k) * size + F.get("nodes", k) - size))
        state = stepped(state.withColumn("scores", raised).drop("nodes"))
        out.feature.append(feature)
        out.last.append(last)
        out.leaf.append(leaf)
    return out, state.drop("trains", "g", "h")


def log_loss(scored: DataFrame, label: str, by: Sequence[str] = ("model",)) -> DataFrame:
    """Rows and mean log-loss of scored rows with a label."""
    p = F.get(softmax(F.col("scores")), F.col(label))
    return scored.where(F.col(label).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("log_loss"),
        F.avg((F.array_position(F.col("scores"), F.array_max("scores")) - 1 == F.col(label)).cast("double")).alias("accuracy"))
