import random

import numpy as np
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from adlake.functions.features import neutered_state, sex_of
from adlake.ml import boosting
from adlake.ml import models as M
from tests.conftest import SMOKE


def animals(spark, n=600, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        kind, sex = rnd.choice(["cat", "dog", "bird", None]), rnd.choice(["Neutered Male", "Intact Female", "Unknown"])
        days = rnd.random() * 30
        outcome = "return" if kind == "dog" and days < 10 else "transfer" if sex == "Unknown" else "adopt"
        rows.append((i, kind, sex, days if rnd.random() < 0.95 else None, outcome))
    return spark.createDataFrame(rows, "id long, kind string, sex string, days double, outcome string")


def test_features_keep_unseen_and_null(spark):
    df = animals(spark, 60)
    model = Pipeline(stages=M.feature_stages(["kind"], ["days"])).fit(df.where("kind <> 'bird'"))
    out = model.transform(df).select("kind", "features").collect()
    width = {len(r.features) for r in out}
    assert len(out) == 60 and len(width) == 1
    by_kind = {r.kind: int(r.features.toArray()[:-1].argmax()) for r in out}
    assert by_kind["bird"] == by_kind[None] not in (by_kind["cat"], by_kind["dog"])


def test_hash_split_is_repeatable(spark):
    df = animals(spark, 500)
    a, b = M.hash_split(df, "id")
    again, _ = M.hash_split(df.repartition(7), "id")
    ids = lambda x: {r.id for r in x.collect()}
    assert ids(a) == ids(again) and not ids(a) & ids(b) and len(ids(a) | ids(b)) == 500 and 0.6 < len(ids(a)) / 500 < 0.8
    assert M.fit_rows(df, "id", 1000).count() == 500 and 50 < M.fit_rows(df, "id", 100).count() < 160


def test_models_learn_separable_data(spark):
    train, held = M.hash_split(animals(spark).fillna(0.0, ["days"]), "id")
    for model in (M.decision_tree(), M.random_forest(trees=15)):
        fitted = M.fit_pipeline(train, ["kind", "sex"], ["days"], "outcome", model)
        assert M.accuracy_evaluator().evaluate(fitted.transform(held)) > 0.9


def test_forest_keeps_nodes_and_grows_the_same_trees(spark):
    df = animals(spark, 200).fillna(0.0, ["days"])
    forest = M.random_forest(trees=6)
    assert forest.getCacheNodeIds()
    trees = [M.fit_pipeline(df, ["kind", "sex"], ["days"], "outcome", forest.copy({forest.cacheNodeIds: kept})).stages[-1].toDebugString.split("\n", 1)[1] for kept in (True, False)]
    assert trees[0] == trees[1]


def test_quality_models_read_the_texts_once(spark):
    from adlake.plans.keys_ml import quality_models
    files = quality_models(spark, SMOKE).inputFiles()
    assert files and not any("documents" in f for f in files)


def _many_labelled(spark, n=210_000):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("web").alias("source"), (F.col("id") % 2).cast("string").alias("quality"),
                                 *[(F.col("id") % k).cast("double").alias(c) for k, c in enumerate(("chars", "symbols", "capitals", "variety"), 5)])


def test_grid_search_fits_on_all_labelled_rows(spark, monkeypatch):
    from adlake.plans import keys_ml
    seen = []

    def predictions(rows, key):
        seen.append((rows.count(), rows.select(key).distinct().count()))
        return rows.limit(10).select(F.lit(1).alias("trees"), F.lit("auto").alias("subset"), F.lit(0).alias("fold"), key, F.lit(1).alias("label"), F.lit(1).alias("predicted"))

    monkeypatch.setattr(keys_ml, "labelled", lambda *_: _many_labelled(spark))
    monkeypatch.setattr(M, "grid_predictions", predictions)
    assert keys_ml.grid_search(spark, SMOKE).count() == 2
    assert seen == [(210_000, 210_000)]


def test_quality_models_fit_on_all_training_rows(spark, monkeypatch):
    from types import SimpleNamespace

    from adlake.plans import keys_ml
    rows, seen = _many_labelled(spark, 300_000), []

    def fit(train, *_):
        seen.append(train.count())
        return SimpleNamespace(transform=lambda held: held.select("*", F.lit(1).alias("label_index"), F.lit(1).alias("prediction")))

    monkeypatch.setattr(keys_ml, "labelled", lambda *_: rows)
    monkeypatch.setattr(M, "fit_pipeline", fit)
    train, held = M.hash_split(rows, "doc_id")
    assert keys_ml.quality_models(spark, SMOKE).count() == 2 * held.count()
    assert seen == 2 * [train.count()] and seen[0] > 205_000


def test_grid_cells_are_written_one_by_one(spark):
    """No forest is needed for the predictions of a finished cell."""
    df = animals(spark, 100).fillna(0.0, ["days"])
    rows = Pipeline(stages=[*M.feature_stages(["kind", "sex"], ["days"]), M.label_indexer("outcome")]).fit(df)
    found = M.grid_predictions(rows.transform(df), "id", trees=(1, 2), subsets=("sqrt",), folds=2, depth=3)
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) == 4 and found.count() == 200


def test_grid_metrics_equal_sql_over_predictions(spark):
    import duckdb
    df = animals(spark, 300).fillna(0.0, ["days"])
    stages = [*M.feature_stages(["kind", "sex"], ["days"]), M.label_indexer("outcome")]
    rows = Pipeline(stages=stages).fit(df).transform(df)
    found = M.grid_predictions(rows, "id", trees=(1, 8), subsets=("auto", "sqrt", "log2"), folds=5, depth=6)
    predictions = found.toArrow()
    assert predictions.num_rows == 300 * 6
    want = duckdb.sql("""SELECT trees, subset, fold, count(*) AS n, count(*) FILTER (WHERE label = predicted) AS hits FROM predictions GROUP BY ALL""").fetchall()
    got = M.grid_metrics(found).collect()
    assert sorted((r.trees, r.subset, r.fold, r.n, r.hits) for r in got if r.fold is not None) == sorted(want) and len(want) == 30
    assert all(r.n == 300 and r.accuracy > 0.5 for r in got if r.fold is None and r.trees == 8) and len(got) == 36
    folds = {r.id: r.fold for r in found.collect()}
    assert all(len({f}) == 1 for f in folds.values()) and set(folds.values()) == set(range(5))


def _boost_by_hand(x, y, classes, rounds, depth, eta, reg=1.0, least=1.0):
    """The same rule from rows: every split of every node is tried."""
    scores = np.zeros((len(x), classes))
    for _ in range(rounds):
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        step = np.zeros_like(scores)
        for k in range(classes):
            g, h = p[:, k] - (y == k), p[:, k] * (1 - p[:, k])
            parts = [np.arange(len(x))]
            for _ in range(depth):
                below = []
                for rows in parts:
                    best = (0.0, None)
                    G, H = g[rows].sum(), h[rows].sum()
                    for f in range(x.shape[1]):
                        for b in range(int(x.max())):
                            left = x[rows, f] <= b
                            GL, HL = g[rows][left].sum(), h[rows][left].sum()
                            if HL >= least and H - HL >= least:
                                gain = round(GL ** 2 / (HL + reg) + (G - GL) ** 2 / (H - HL + reg) - G ** 2 / (H + reg), 6)
                                if gain > best[0]:
                                    best = (gain, left)
                    below += [rows, rows[:0]] if best[1] is None else [rows[best[1]], rows[~best[1]]]
                parts = below
            for rows in parts:
                step[rows, k] = -eta * g[rows].sum() / (h[rows].sum() + reg)
        scores += step
    return scores


def test_boosting_equals_the_rule_by_hand(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 4, (240, 3))
    y = np.where(x[:, 0] > 1, np.where(x[:, 1] > 2, 2, 1), 0)
    y = np.where(rng.random(240) < 0.1, rng.integers(0, 3, 240), y)
    rows = spark.createDataFrame([(i, [int(v) for v in x[i]], int(y[i])) for i in range(240)], "id long, bins array<int>, y int")
    fitted, scored = boosting.boost(rows, "y", "bins", 3, rounds=4, depth=2, eta=0.3)
    want = _boost_by_hand(x, y, 3, 4, 2, 0.3)
    got = {r.id: r.scores for r in scored.collect()}
    assert np.allclose([got[i] for i in range(240)], want, atol=1e-6)
    chance = np.exp(want) / np.exp(want).sum(1, keepdims=True)
    again = {r.id: r.p for r in rows.repartition(5).select("id", fitted.probabilities(F.col("bins")).alias("p")).collect()}
    assert np.allclose([again[i] for i in range(240)], chance, atol=1e-6)
    loss = boosting.log_loss(scored, "y").collect()[0]
    assert abs(loss.log_loss + np.log(chance[np.arange(240), y]).mean()) < 1e-6 and loss.n == 240


def test_a_level_is_summed_in_its_tasks(spark):
    """Each task sends a cell once, however many rows it read, with exact sums."""
    rng = np.random.default_rng(7)
    x, model = rng.integers(0, 3, (500, 2)), rng.integers(0, 2, 500)
    g, h = rng.integers(-(1 << 32), 1 << 32, (500, 2)), rng.integers(0, 1 << 32, (500, 2))
    rows = spark.createDataFrame([(int(model[i]), x[i].tolist(), g[i].tolist(), h[i].tolist()) for i in range(500)], "model int, b array<int>, g array<bigint>, h array<bigint>")
    feature, last = np.zeros((2, 2, 4), int), np.ones((2, 2, 4), int)
    feature[1, 1, 1] = -1
    want = {}
    for i in range(500):
        for k in range(2):
            node = 1 if feature[model[i], k, 1] >= 0 and x[i, 0] > 1 else 0
            for f in range(2):
                cell = int((((model[i] * 2 + k) * 2 + node) * 2 + f) * 3 + x[i, f])
                a, b = want.get(cell, (0, 0))
                want[cell] = a + int(g[i, k]), b + int(h[i, k])
    sums = boosting._histograms(rows.repartition(3), feature, last, 1, 2, 2)
    assert {r.cell: (r.g, r.h) for r in sums.collect()} == want
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan


def test_boosting_folds_and_odd_rows(spark):
    df = animals(spark, 400)
    fitted, bins, scored = M.boosted_trees(df.withColumn("outcome", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("outcome"))), "outcome", ["days"], ["kind", "sex"],
                                           ["adopt", "return", "transfer"], rounds=6, folds=3, key="id")
    assert scored.count() == 1200 and set(bins.categorical["kind"]) == {"bird", "cat", "dog"}
    held = {r.fold: r for r in boosting.log_loss(scored.where("fold = model"), "class_no", ["fold"]).collect()}
    assert len(held) == 3 and all(r.log_loss < 0.5 and r.accuracy > 0.85 for r in held.values())
    seen = boosting.log_loss(scored.where("fold <> model"), "class_no", ["model"]).collect()
    assert sum(r.n for r in seen) == 2 * sum(r.n for r in held.values())
    again = M.boosted_trees(df.withColumn("outcome", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("outcome"))).repartition(9), "outcome", ["days"], ["kind", "sex"],
                            ["adopt", "return", "transfer"], rounds=2, folds=3, key="id")[0]
    assert all((a == b).all() for a, b in zip(again.leaf, fitted.leaf))
    assert boosting.boost(spark.createDataFrame([], "bins array<int>, y int"), "y", "bins", 2, rounds=1)[1].count() == 0


def test_accuracy_by_group(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 1), ("b", 1, 1), ("b", None, 1)], "g string, y int, p int")
    assert {r.g: (r.n, r.hits, r.accuracy) for r in M.accuracy_by_group(df, "g", "y", "p").collect()} == {"a": (2, 1, 0.5), "b": (1, 1, 1.0)}


def test_sex_maps(spark):
    df = spark.createDataFrame([("Spayed Female",), ("Intact Male",), ("Unknown",), ("else",), (None,)], "s string")
    got = df.select(sex_of("s").alias("x"), neutered_state("s").alias("n")).collect()
    assert [tuple(r) for r in got] == [("Female", "Neutered"), ("Male", "Intact"), ("Unknown", "Unknown"), (None, None), (None, None)]
