"""Registered keys for the models (ML3-ML9) on the labelled documents."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.ml import models as M
from adlake.ml.boosting import log_loss
from adlake.plans.registry import register
from adlake.session import materialise
from adlake.sources.tables import Tables


@register("accuracy_by_group", """
SELECT lang, count(*) AS n, CAST(sum(CASE WHEN (n_chars >= 300) = (quality = 1) THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  sum(CASE WHEN (n_chars >= 300) = (quality = 1) THEN 1 ELSE 0 END) / count(*) AS accuracy
FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY 1
""", "ML8")
def accuracy_by_group(spark, sf):
    """How well length alone tells the quality label, by language."""
    t = Tables(spark, sf)
    rows = t.documents.join(t.labels, "doc_id").withColumn("guess", (F.col("n_chars") >= 300).cast("int"))
    return M.accuracy_by_group(rows, "lang", "quality", "guess")


def labelled(spark, sf) -> DataFrame:
    """Labelled documents with a few features that need no model."""
    t = Tables(spark, sf)
    text = F.coalesce("text", F.lit(""))
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id", "lang", "source", F.col("quality").cast("string").alias("quality"), F.length(text).cast("double").alias("chars"),
        (F.length(F.regexp_replace(text, r"[^#*$%&|!]", "")) / F.greatest(F.length(text), F.lit(1))).alias("symbols"),
        (F.length(F.regexp_replace(text, r"[^A-Z]", "")) / F.greatest(F.length(text), F.lit(1))).alias("capitals"),
        (F.size(F.array_distinct(F.split(text, " "))) / F.size(F.split(text, " "))).alias("variety"))


@register("train_test_split", """
SELECT doc_id, quality, CASE WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 70 THEN 'train' ELSE 'test' END AS side
FROM documents JOIN labels USING (doc_id)
""", "ML4")
def train_test_split(spark, sf):
    t = Tables(spark, sf)
    rows = t.documents.join(t.labels, "doc_id").select("doc_id", "quality")
    train, test = M.hash_split(rows, "doc_id")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


CATEGORICAL, NUMERIC = ["lang", "source"], ["chars", "symbols", "capitals", "variety"]
BOOSTING_ROUNDS = 20


@register("quality_models", None, "ML3,ML5,ML6")
def quality_models(spark, sf):
    """The quality label of held-out documents by a tree of depth 30 and a
    forest of 500, fitted on all the others."""
    rows = materialise(labelled(spark, sf).where("quality is not null"), "labelled")  # the texts are read once
    train, held = M.hash_split(rows, "doc_id")
    out = None
    for name, model in (("tree", M.decision_tree()), ("forest", M.random_forest())):
        fitted = M.fit_pipeline(train, CATEGORICAL, NUMERIC, "quality", model)
        rows = fitted.transform(held).select(F.lit(name).alias("model"), "doc_id", F.col("label_index").cast("int").alias("label"),
                                             F.col("prediction").cast("int").alias("predicted"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("boosted_log_loss", None, "ML9")
def boosted_log_loss(spark, sf):
    """Multiclass boosting of the quality and toxic labels together: log-loss
    and accuracy of 3 models, each on the fold it didn't see."""
    rows = labelled(spark, sf).join(Tables(spark, sf).labels.select("doc_id", "toxic"), "doc_id")
    rows = materialise(rows.withColumn("kind", F.concat("quality", F.lit("/"), F.col("toxic").cast("string"))), "labelled")  # the texts are read once
    _, _, scored = M.boosted_trees(rows, "kind", NUMERIC, CATEGORICAL, ["0/0", "0/1", "1/0", "1/1"], rounds=BOOSTING_ROUNDS, folds=3, key="doc_id")
    return log_loss(scored.where(F.col("fold") == F.col("model")), "class_no", ["fold"])


@register("grid_search", None, "ML7,ML8")
def grid_search(spark, sf):
    """Forests of 50 and 400 trees by three rules for the feature subset, in 5
    folds: accuracy of each cell and fold, and over the folds, of all labelled rows."""
    rows = materialise(labelled(spark, sf).where("quality is not null"), "labelled")  # the texts are read once
    stages = Pipeline(stages=[*M.feature_stages(CATEGORICAL, NUMERIC), M.label_indexer("quality")])
    return M.grid_metrics(M.grid_predictions(stages.fit(rows).transform(rows), "doc_id"))
