"""Linear families fitted in the same passes, against single fits and MLlib."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from catalog import views as T
from clipwright.operators import batched, classifiers, metrics, moments as M, tuning
from clipwright.operators.sizing import class_names


@pytest.fixture(scope="module")
def folded(spark, sf_dir):
    """Three classes with a shift between them, over three folds."""
    table = T.features(spark, sf_dir).withColumn("k", F.col("clip_id") % 3).withColumn("fold", (F.col("clip_id") * 7 % 10 % 3).cast("int"))
    moved = table.withColumn("features", F.slice(F.transform(
        "features", lambda v, i: v + F.when(i < 4, F.col("k") * 0.1).otherwise(0.0)), 1, 12))
    rows = moved.withColumn("label", F.concat(F.lit("c"), F.col("k").cast("string"))).drop("k")
    return M.apply_scaler(rows, M.fit_scaler(rows)).persist()


@pytest.mark.parametrize("loss", ["softmax", "margin"])
def test_models_fitted_together_are_those_fitted_alone(folded, loss):
    classes = class_names(folded)
    ready = batched.prepared(folded, classes).persist()
    parts = [batched.Part(f, c) for c in (0.01, 1.0) for f in (0, 1, 2, batched.ALL_ROWS)]
    together = batched.fit_parts(ready, parts, loss, classes, tolerance=1e-7)
    assert together.largest_gradient <= 1e-7 and together.passes < 120
    for i in (0, 3, 5):
        alone = batched.fit_parts(ready, [parts[i]], loss, classes, tolerance=1e-7)
        assert np.abs(alone.weights[0] - together.weights[i]).max() < 1e-3
    gaps = batched.intercept_gaps(ready, together).collect()
    assert all(abs(r["gap"]) < 1e-6 for r in gaps) and len(gaps) == 4 * 3


def test_gradients_are_those_of_differences(folded):
    classes = class_names(folded)
    ready = batched.prepared(folded, classes).repartition(3).persist()
    weights = np.random.default_rng(1).normal(0, 0.3, (2, 3, 13))
    for loss in batched.CURVATURE:
        values, gradients = batched.summed_gradients(ready, weights, [1, batched.ALL_ROWS], loss)
        for model, k, j in ((0, 0, 0), (0, 2, 12), (1, 1, 5)):
            moved = weights.copy()
            moved[model, k, j] += 1e-5
            more, _ = batched.summed_gradients(ready, moved, [1, batched.ALL_ROWS], loss)
            assert (more[model] - values[model]) / 1e-5 == pytest.approx(gradients[model, k, j], rel=1e-2, abs=1e-1)


def test_search_agrees_with_single_fits_of_the_library(spark, folded):
    classes = class_names(folded)
    points = {0: {"C": 0.001, "max_iter": 100}, 3: {"C": 0.1, "max_iter": 100}}
    found = batched.search("logistic", folded, points, classes, folds=3, tolerance=1e-7)
    ready = classifiers.vectorized(folded, classes).select("vector", "label_enc", F.col("fold").alias("_fold")).persist()
    for i, point in points.items():
        for f in (0, 2):
            train = ready.where(F.col("_fold") != f)
            single = LogisticRegression(featuresCol="vector", labelCol="label_enc", family="multinomial", standardization=False,
                                        regParam=1.0 / (point["C"] * train.count()), tol=1e-9, maxIter=100).fit(train)
            score = MulticlassClassificationEvaluator(labelCol="label_enc", metricName="f1").evaluate(single.transform(ready.where(F.col("_fold") == f)))
            mine = found.scores.where(f"candidate = {i} and fold = {f}").first()["score"]
            assert mine == pytest.approx(score, abs=1e-9)
    assert found.best == tuning.best_candidate(tuning.mean_scores(found.scores)).first()["candidate"]
    whole = LogisticRegression(featuresCol="vector", labelCol="label_enc", family="multinomial", standardization=False, tol=1e-9,
                               regParam=1.0 / (points[found.best]["C"] * ready.count()), maxIter=100).fit(ready)
    pred = found.model.predict(folded)
    assert pred.where(F.abs(F.aggregate("proba", F.lit(0.0), lambda a, p: a + p["proba"]) - 1) > 1e-9).count() == 0
    theirs = {tuple(np.round(r["vector"].toArray(), 9)): r["probability"].toArray() for r in whole.transform(ready).collect()}
    for r in pred.limit(50).collect():
        assert np.abs([p["proba"] for p in r["proba"]] - theirs[tuple(np.round(r["features"], 9))]).max() < 1e-4


def test_margin_search_and_refit(folded):
    classes = class_names(folded)
    points = {i: {"C": c, "kernel": "rbf", "gamma": g} for i, (c, g) in enumerate([(0.5, "scale"), (2.0, "scale"), (0.5, "auto")])}
    found = batched.search("svm", folded, points, classes, folds=3)
    assert found.scores.count() == 9
    pred = found.model.predict(folded)
    assert not found.model.has_proba and "raw_scores" in pred.columns and "_space" not in pred.columns
    assert metrics.evaluate(pred, (), "label", "pred_label").first()["accuracy"] > 0.6


def test_rows_without_a_class_and_a_missing_fold(folded):
    classes = class_names(folded)
    parts = [batched.Part(f, 1.0) for f in (0, 9)]
    plain = batched.fit_parts(batched.prepared(folded, classes), parts, "softmax", classes, tolerance=1e-7)
    more = folded.unionByName(folded.limit(20).withColumn("label", F.lit(None).cast("string")))
    again = batched.fit_parts(batched.prepared(more, classes), parts, "softmax", classes, tolerance=1e-7)
    assert np.abs(plain.weights - again.weights).max() < 1e-4
    assert batched.confusion_cells(batched.prepared(folded, classes), plain).where("model = 1").count() == 0


def test_drawn_points_have_the_grid_s_types(spark):
    drawn = tuning.random_candidates(tuning.candidate_table(spark), 3)
    points = batched.drawn_points(drawn, "logistic")
    grid = tuning.grid_points(tuning.GRIDS["logistic"])
    assert len(points) == 3 and all(grid[i] == p for i, p in points.items())
