"""Classifier families, tuning and whole protocols, with few rounds."""

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES, views as T
from clipwright.operators import classifiers, metrics, moments as M, tuning
from clipwright.operators.sizing import class_names
from clipwright.plans import protocols
from clipwright.sources.readers import ContractError

FEW = {"rf": {"n_estimators": 10, "max_depth": 8}, "xgb": {"n_estimators": 2, "max_depth": 2}}
SMALL = ["rf", "knn", "dtr", "nb"]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    """Three classes with a shift between them, so that a classifier has something to learn."""
    table = T.features(spark, sf_dir).withColumn("k", F.col("clip_id") % 3)
    moved = table.withColumn("features", F.transform("features", lambda v, i: v + F.when(i < 8, F.col("k") * 0.15).otherwise(0.0)))
    return moved.withColumn("label", F.concat(F.lit("c"), F.col("k").cast("string"))).drop("k").persist()


@pytest.mark.parametrize("name", classifiers.MODEL_NAMES)
def test_family_beats_majority(rows, name):
    train, test = rows.where("clip_id % 4 > 0"), rows.where("clip_id % 4 = 0")
    scaler = M.fit_scaler(train)
    fitted = classifiers.fit(name, M.apply_scaler(train, scaler), class_names(train), FEW.get(name), tasks=1)
    pred = fitted.predict(M.apply_scaler(test, scaler))
    assert ("proba" in pred.columns) == fitted.has_proba
    report = metrics.evaluate(pred, (), "label", "pred_label").first()
    assert report["accuracy"] > 0.45
    assert report["accuracy"] == pytest.approx(report["recall_weighted"])
    if fitted.has_proba:
        wide = classifiers.proba_wide(pred, fitted.classes)
        total = sum(F.col(f"proba_{c}") for c in fitted.classes)
        assert wide.where(F.abs(total - 1.0) > 1e-6).count() == 0


def test_cross_validation_picks_the_best_mean(spark, rows):
    folded = rows.withColumn("fold", (F.col("clip_id") % 3).cast("int"))
    points = [{"max_depth": 1, "min_samples_leaf": 50}, {"max_depth": 6, "min_samples_leaf": 2}]
    found = tuning.cross_validate("dtr", folded, points, class_names(rows), folds=3)
    means = tuning.score_table(spark, "dtr", found)
    best = tuning.best_candidate(means.select("model", "candidate", "mean_score")).first()
    assert best["mean_score"] == pytest.approx(max(found.avgMetrics))
    assert best["candidate"] == found.best
    assert found.model.model.getMaxDepth() == points[best["candidate"]]["max_depth"]


def test_kernel_candidates_are_searched_in_their_own_space(spark, rows, monkeypatch):
    seen = []
    plain = classifiers.kernel_space
    monkeypatch.setattr(classifiers, "kernel_space", lambda df, gamma, *rest: (seen.append(gamma), plain(df, gamma, *rest))[1])
    folded = rows.withColumn("fold", (F.col("clip_id") % 2).cast("int"))
    points = [{"C": c, "kernel": "rbf", "gamma": g} for c in (0.5, 2.0) for g in ("scale", "auto")]
    found = tuning.cross_validate("svm", folded, points, class_names(rows), folds=2, tasks=1)
    assert seen == ["scale", "auto"] and len(set(found.avgMetrics)) > 1
    assert found.model.settings["C"] == points[found.best]["C"]


def test_kernel_family_has_probabilities_when_asked(rows):
    fitted = classifiers.fit("svm", rows, class_names(rows), {"probability": True}, tasks=1)
    pred = fitted.predict(rows).select("label", "pred_label", "proba")
    assert fitted.has_proba
    best = F.array_max(F.transform("proba", lambda p: F.struct(p["proba"], p["label"])))["label"]
    assert pred.where(best != F.col("pred_label")).count() == 0
    assert pred.where(F.abs(F.aggregate("proba", F.lit(0.0), lambda a, p: a + p["proba"]) - 1) > 1e-9).count() == 0
    assert pred.where("label = pred_label").count() > 0.6 * pred.count()


def test_neighbour_tuning(rows):
    folded = rows.withColumn("fold", (F.col("clip_id") % 2).cast("int"))
    points = [{"n_neighbors": 5, "weights": "uniform"}, {"n_neighbors": 10, "weights": "distance"}]
    scores = tuning.tune_neighbours(folded, candidates=points, folds=2).collect()
    assert len(scores) == 4 and all(0.3 < r["score"] <= 1.0 for r in scores)


def test_random_candidates_without_replacement(spark):
    drawn = tuning.random_candidates(tuning.candidate_table(spark)).collect()
    assert len(drawn) == 84 and len({(r["model"], r["candidate"]) for r in drawn}) == 84


def test_protocols(spark, rows):
    plain = protocols.hold_out(rows, SMALL, FEW, min_rows=300)
    projected = protocols.hold_out(rows, SMALL, FEW, project=True, min_rows=300)
    groups = protocols.leave_group_out(rows, SMALL, FEW, min_rows=300)
    assert plain.reports.count() == len(SMALL) and groups.reports.count() == 5 * len(SMALL)
    summary = protocols.fold_summary(groups).where("metric = 'accuracy'").collect()
    assert len(summary) == len(SMALL) and all(r["mean"] > 0.4 for r in summary)
    areas = protocols.compare({"80_20": plain, "loso": groups, "pca": projected})
    assert areas.count() == 3 * len(SMALL)
    assert all(r["auc"] > 0.5 for r in areas.collect())

    external = rows.where("clip_id % 7 = 0").withColumn("dataset", F.lit("ext"))
    predictions, reports = protocols.zero_shot(plain, external)
    assert set(predictions) == set(SMALL) and reports.count() == len(SMALL)
    _, projected_reports = protocols.zero_shot(projected, external)
    assert projected_reports.count() == len(SMALL)
    by_fold, fold_reports = protocols.zero_shot(groups, external)
    assert len(by_fold) == 5 * len(SMALL) and fold_reports.count() == 5 * len(SMALL)
    assert fold_reports.where("accuracy < 0.4").count() == 0
    with pytest.raises(ValueError):
        groups.space(external)
    unlabelled, none = protocols.zero_shot(plain, external.drop("label"))
    assert none is None and unlabelled["nb"].count() == external.count()
    with pytest.raises(ContractError):
        protocols.zero_shot(plain, external.withColumn("label", F.lit("new")))


def test_too_few_rows(rows):
    with pytest.raises(ContractError):
        protocols.hold_out(rows, ["nb"], min_rows=500)


@pytest.mark.parametrize("name", ["boosted_trees", "margin_classifier", "cv_tuning", "refit_best"])
def test_long_queries_with_few_rounds(spark, sf_dir, monkeypatch, name):
    monkeypatch.setitem(classifiers.SETTINGS, "xgb", {"n_estimators": 1, "max_depth": 2, "learning_rate": 0.1})
    monkeypatch.setitem(tuning.GRIDS, "dtr", {"max_depth": [2, 4], "min_samples_leaf": [5]})
    assert QUERIES[name](spark, sf_dir).count() == (2 if name == "cv_tuning" else 100)
