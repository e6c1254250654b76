"""Feature pipeline, split, tree models and evaluation on Spark ML (ML3-ML9).

Fitting is distributed over the rows of the fit table, and only the trees come
to the driver.  The registered queries fit on all their rows; a caller may bound its
own fits by ``fit_rows`` (rows in hash order, so the choice is repeatable).  Scoring
and evaluation always cover all rows.
"""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Sequence

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.ml.boosting import Bins, Boosted, boost, fit_bins
from adlake.session import materialise

MAX_DEPTH = 30  # the deepest tree Spark builds; the source asks for 35
MAX_FIT_ROWS = 1_000_000


def feature_stages(categorical: Sequence[str], numeric: Sequence[str] = (), out: str = "features") -> list:
    """ML3: index, one-hot and assemble; categories unseen in the fit, and
    NULL, get a code of their own.  NULL numbers are kept as NaN."""
    index = StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep", stringOrderType="alphabetAsc")
    onehot = OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_onehot" for c in categorical], handleInvalid="keep", dropLast=False)
    assemble = VectorAssembler(inputCols=[f"{c}_onehot" for c in categorical] + list(numeric), outputCol=out, handleInvalid="keep")
    return [index, onehot, assemble]


def label_indexer(label: str, out: str = "label_index") -> StringIndexer:
    return StringIndexer(inputCol=label, outputCol=out, handleInvalid="error", stringOrderType="alphabetAsc")


def hash_slot(key: str, slots: int) -> Column:
    """0..slots-1 by the MD5 of a key's text: repeatable, whatever the
    partitioning, and the same in any SQL engine.  A NULL key has slot 0."""
    return F.coalesce(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % slots, F.lit(0)).cast("int")


def hash_split(df: DataFrame, key: str, train_percent: int = 70) -> tuple[DataFrame, DataFrame]:
    """ML4: a split by the hash of a key; rows of one key stay together."""
    slot = hash_slot(key, 100)
    return df.where(slot < train_percent), df.where(slot >= train_percent)


def fit_rows(df: DataFrame, key: str, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """At most about ``max_fit_rows`` rows, by hash; all if there are no more."""
    n = df.count()
    if n <= max_fit_rows:
        return df
    share = int(max_fit_rows / n * 1_000_000)
    return df.where(F.pmod(F.xxhash64(F.lit("fit"), F.col(key)), F.lit(1_000_000)) < share)


def decision_tree(label: str = "label_index", depth: int = MAX_DEPTH, seed: int = 1) -> DecisionTreeClassifier:
    """ML5."""
    return DecisionTreeClassifier(labelCol=label, maxDepth=min(depth, MAX_DEPTH), seed=seed)


def random_forest(label: str = "label_index", trees: int = 500, depth: int = MAX_DEPTH, subset: str = "auto", seed: int = 1) -> RandomForestClassifier:
    """ML6.  Each row keeps its node of every tree, so that a level costs one step
    and not a walk from the root; the trees are the same."""
    return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy=subset, seed=seed, cacheNodeIds=True)


def boosted_trees(train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], classes: Sequence[str], rounds: int = 100,
                  depth: int = 3, eta: float = 0.3, folds: int = 0, key: str | None = None) -> tuple[Boosted, Bins, DataFrame]:
    """ML9: multiclass boosting with log-loss.  With `folds`, one model for each
    fold by the hash of `key`, trained on the others; the scored rows have
    `fold`, `model`, `class_no` and `scores`."""
    bins = fit_bins(train, numeric, categorical)
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(f"`{label}`").cast("string"))
    rows = train.withColumn("bins", bins.column()).withColumn("class_no", F.nullif(number, F.lit(0)).cast("int") - 1)
    rows = rows.withColumn("fold", hash_slot(key, folds) if folds else F.lit(-1))
    fitted, scored = boost(rows, "class_no", "bins", len(classes), max(1, folds), rounds, depth, eta, held_out="fold" if folds else None)
    return fitted, bins, scored


SAME_SUBSETS = {"auto": "sqrt"}  # what "auto" means for a forest of classifiers


def grid_predictions(rows: DataFrame, key: str, label: str = "label_index", trees: Sequence[int] = (50, 400), subsets: Sequence[str] = ("auto", "sqrt", "log2"),
                     folds: int = 5, depth: int = MAX_DEPTH, parallelism: int = 4, seed: int = 1) -> DataFrame:
    """ML7: (trees, subset, fold, key, label, predicted): every row, with
    `features`, predicted by each cell's forest of the other folds.  Folds are a
    column by the hash of the key; the fits share the cluster, `parallelism` at
    a time; cells of equal parameters share their fit.  A cell's predictions are
    written before its thread takes the next, so the driver holds `parallelism`
    forests at most."""
    rows = materialise(rows.select(key, "features", label).withColumn("fold", hash_slot(key, folds)), "grid-rows")
    strategies = sorted({SAME_SUBSETS.get(s, s) for s in subsets})
    cells = [(n, s, fold) for n in trees for s in strategies for fold in range(folds)]

    def fit(cell: tuple[int, str, int]) -> DataFrame:
        n, strategy, fold = cell
        model = random_forest(label, n, depth, strategy, seed).fit(rows.where(F.col("fold") != fold))
        return materialise(model.transform(rows.where(F.col("fold") == fold)).select(
            F.lit(n).alias("trees"), F.lit(strategy).alias("subset"), "fold", key, F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("predicted")), "grid-predictions")

    with ThreadPool(parallelism) as pool:
        found = pool.map(inheritable_thread_target(rows.sparkSession)(fit), cells)
    held = reduce(DataFrame.unionByName, found)
    again = [held.where(F.col("subset") == SAME_SUBSETS[s]).withColumn("subset", F.lit(s)) for s in subsets if s in SAME_SUBSETS]
    return reduce(DataFrame.unionByName, again, held.where(F.col("subset").isin(list(subsets))))


def grid_metrics(predictions: DataFrame) -> DataFrame:
    """Rows, hits and accuracy of every cell by fold, and over all folds (fold
    NULL, accuracy the mean of the folds')."""
    hit = (F.col("label") == F.col("predicted")).cast("bigint")
    by_fold = predictions.groupBy("trees", "subset", "fold").agg(F.count("*").alias("n"), F.sum(hit).alias("hits"), (F.sum(hit) / F.count("*")).alias("accuracy"))
    whole = by_fold.groupBy("trees", "subset").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.avg("accuracy").alias("accuracy"))
    return by_fold.unionByName(whole.withColumn("fold", F.lit(None).cast("int")))


def accuracy_evaluator(label: str = "label_index") -> MulticlassClassificationEvaluator:
    """ML8: accuracy, which is micro-F1 where each row has one label (Spark's
    own 'f1' is weighted)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")


def fit_pipeline(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str, model) -> PipelineModel:
    return Pipeline(stages=[*feature_stages(categorical, numeric), label_indexer(label), model]).fit(train)


def accuracy_by_group(df: DataFrame, group: str, label: str, prediction: str) -> DataFrame:
    """ML8 in SQL form: rows, hits and accuracy of each group; rows without a
    label or prediction don't count."""
    known = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    hit = (F.col(label) == F.col(prediction)).cast("bigint")
    return known.groupBy(group).agg(F.count("*").alias("n"), F.sum(hit).alias("hits"), (F.sum(hit) / F.count("*")).alias("accuracy"))
