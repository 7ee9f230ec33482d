"""Confusion matrices, metric reports, fold summaries and protocol comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as T
from catalog.registry import query, view
from clipwright.operators import compare, metrics, roc

view("cells_all", "SELECT model, y_true, y_pred, count(*) AS n FROM preds GROUP BY ALL", "preds")
view("matrix", """
    SELECT m.model, t.class AS y_true, p.class AS y_pred, coalesce(n, 0) AS n
    FROM (SELECT DISTINCT model FROM preds) m CROSS JOIN types t CROSS JOIN types p
    LEFT JOIN cells_all c ON c.model = m.model AND c.y_true = t.class AND c.y_pred = p.class""",
     "preds", "types", "cells_all")
view("per_class", """
    SELECT model, label, CAST(sum(support) AS BIGINT) AS support, CAST(sum(predicted) AS BIGINT) AS predicted,
           CAST(sum(hits) AS BIGINT) AS hits,
           CASE WHEN sum(predicted) = 0 THEN 0 ELSE sum(hits)::DOUBLE / sum(predicted) END AS p,
           CASE WHEN sum(support) = 0 THEN 0 ELSE sum(hits)::DOUBLE / sum(support) END AS r,
           2.0::DOUBLE * sum(hits) / (sum(support) + sum(predicted)) AS f
    FROM (SELECT model, y_true AS label, n AS support, 0 AS predicted, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS hits
          FROM cells_all UNION ALL SELECT model, y_pred, 0, n, 0 FROM cells_all)
    GROUP BY model, label""", "cells_all")
view("class_areas", """
    SELECT workflow, model, fold, class,
           CASE WHEN max(p) * max(m) = 0 OR max(score) IS NULL THEN NULL
                ELSE sum(pos * (below + neg / 2.0::DOUBLE)) / (max(p) * max(m)) END AS auc
    FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY workflow, model, fold, class ORDER BY score
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
                 sum(pos) OVER (PARTITION BY workflow, model, fold, class) AS p,
                 sum(neg) OVER (PARTITION BY workflow, model, fold, class) AS m
          FROM (SELECT workflow, model, fold, class, score, count(*) FILTER (hit) AS pos, count(*) FILTER (NOT hit) AS neg
                FROM scores GROUP BY workflow, model, fold, class, score))
    GROUP BY workflow, model, fold, class""", "scores")
view("fold_areas", """
    SELECT workflow, model, fold, CASE WHEN count(auc) = count(*) THEN avg(auc) END AS auc
    FROM class_areas GROUP BY workflow, model, fold""", "class_areas")
view("areas", "SELECT workflow, model, avg(auc) AS auc FROM fold_areas GROUP BY workflow, model", "fold_areas")


def _cells(spark, d, keys=("model",)):
    return metrics.counts(T.predictions(spark, d), list(keys))


@query("confusion_matrix", "SELECT model, y_true, y_pred, n FROM matrix", "matrix")
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(_cells(spark, d), T.TYPES, ["model"])


@query("confusion_matrix_wide", f"""
    SELECT model, y_true, {', '.join(f"CAST(sum(n) FILTER (y_pred = '{t}') AS BIGINT) AS {t}" for t in T.TYPES)}
    FROM matrix GROUP BY model, y_true""", "matrix")
def confusion_matrix_wide(spark, d):
    return metrics.confusion_matrix_wide(_cells(spark, d), T.TYPES, ["model"])


@query("accuracy", """
    SELECT model, round(avg(CASE WHEN y_true = y_pred THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
    FROM preds GROUP BY model""", "preds")
def accuracy(spark, d):
    return metrics.accuracy(T.predictions(spark, d), ["model"]).select("model", *T.r6("accuracy"))


@query("per_class_prf", """
    SELECT model, label, support, predicted, hits, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1
    FROM per_class""", "per_class")
def per_class_prf(spark, d):
    out = metrics.per_class(_cells(spark, d), ["model"])
    return out.select("model", "label", "support", "predicted", "hits", *T.r6("precision", "recall", "f1"))


@query("weighted_prf", """
    SELECT model, round(sum(p * support) / sum(support), 6) AS precision_weighted,
           round(sum(r * support) / sum(support), 6) AS recall_weighted,
           round(sum(f * support) / sum(support), 6) AS f1_weighted FROM per_class GROUP BY model""", "per_class")
def weighted_prf(spark, d):
    out = metrics.weighted_prf(metrics.per_class(_cells(spark, d), ["model"]), ["model"])
    return out.select("model", *T.r6("precision_weighted", "recall_weighted", "f1_weighted"))


@query("macro_f1_uar", """
    SELECT model, round(avg(f), 6) AS f1_macro, round(avg(r), 6) AS uar FROM per_class GROUP BY model""", "per_class")
def macro_f1_uar(spark, d):
    out = metrics.macro_scores(metrics.per_class(_cells(spark, d), ["model"]), ["model"])
    return out.select("model", *T.r6("f1_macro", "uar"))


REPORT = """
    SELECT model, round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy, round(sum(f * support) / sum(support), 6) AS f1_weighted,
           round(avg(f), 6) AS f1_macro, round(avg(r), 6) AS uar,
           round(sum(p * support) / sum(support), 6) AS precision_weighted,
           round(sum(r * support) / sum(support), 6) AS recall_weighted
    FROM per_class GROUP BY model"""


@query("metric_report", REPORT, "per_class")
def metric_report(spark, d):
    out = metrics.report(_cells(spark, d), ["model"])
    return out.select("model", *T.r6(*metrics.SIX_METRICS)).orderBy("model")


@query("sorted_report", """
    SELECT model, fold, round(accuracy, 6) AS accuracy, round(uar, 6) AS uar FROM fold_reports ORDER BY model, fold""",
       "fold_reports")
def sorted_report(spark, d):
    out = metrics.evaluate(T.predictions(spark, d), ["model", "fold"])
    return out.select("model", "fold", *T.r6("accuracy", "uar")).orderBy("model", "fold")


@query("metric_unpivot", "SELECT model, fold, metric, round(value, 6) AS value FROM long_reports", "long_reports")
def metric_unpivot(spark, d):
    wide = metrics.evaluate(T.predictions(spark, d), ["model", "fold"])
    return metrics.to_long(wide, ["model", "fold"]).select("model", "fold", "metric", *T.r6("value"))


@query("fold_summary", """
    SELECT model, metric, round(mean, 6) AS mean, round(std, 6) AS std,
           CASE WHEN mean IS NULL THEN 'N/A' ELSE printf('%.4f ± %.4f', mean, std) END AS text
    FROM (SELECT model, metric, CASE WHEN count(value) = 5 THEN avg(value) END AS mean,
                 CASE WHEN count(value) = 5 THEN stddev_samp(value) END AS std
          FROM long_reports WHERE NOT (model = 'beta' AND fold = 3) GROUP BY model, metric)""", "long_reports")
def fold_summary(spark, d):
    long = metrics.to_long(metrics.evaluate(T.predictions(spark, d), ["model", "fold"]), ["model", "fold"])
    held = long.where(~((F.col("model") == "beta") & (F.col("fold") == 3)))
    return metrics.fold_summary(metrics.model_fold_grid(held)).select("model", "metric", *T.r6("mean", "std"), "text")


# ---- areas across protocols --------------------------------------------------------

def _areas(spark, d):
    keys = ["workflow", "model", "fold"]
    folds = roc.macro_auc(roc.class_auc(T.scores(spark, d), keys), keys).withColumnRenamed("macro_auc", "auc")
    return roc.fold_nanmean(folds, ["workflow", "model"], "auc")


@query("fold_nanmean", "SELECT workflow, model, round(auc, 6) AS auc FROM areas", "areas")
def fold_nanmean(spark, d):
    return _areas(spark, d).select("workflow", "model", F.round("auc", 6).alias("auc"))


@query("loso_auc", "SELECT model, round(auc, 6) AS auc FROM areas WHERE workflow = 'loso'", "areas")
def loso_auc(spark, d):
    rows = T.scores(spark, d).where("workflow = 'loso'").drop("workflow")
    folds = roc.macro_auc(roc.class_auc(rows, ["model", "fold"]), ["model", "fold"])
    return roc.fold_nanmean(folds, ["model"], "macro_auc").select("model", F.round("macro_auc", 6).alias("auc"))


PIVOT = """round(max(auc) FILTER (workflow = '80_20'), 6) AS "80_20", round(max(auc) FILTER (workflow = 'loso'), 6) AS loso,
           round(max(auc) FILTER (workflow = 'pca'), 6) AS pca"""


@query("workflow_pivot", f"SELECT model, {PIVOT} FROM areas GROUP BY model", "areas")
def workflow_pivot(spark, d):
    return compare.workflow_pivot(_areas(spark, d)).select("model", *[F.round(f"`{w}`", 6).alias(w) for w in compare.WORKFLOWS])


@query("best_model_per_workflow", """
    SELECT workflow, arg_max(model, auc) AS best_model, round(max(auc), 6) AS best_auc, round(avg(auc), 6) AS mean_auc
    FROM areas GROUP BY workflow""", "areas")
def best_model_per_workflow(spark, d):
    out = compare.best_model_per_workflow(_areas(spark, d), T.TOY_MODELS)
    return out.select("workflow", "best_model", *T.r6("best_auc", "mean_auc"))


@query("best_workflow_per_model", """
    SELECT model, arg_max(workflow, auc) AS best_workflow, round(max(auc), 6) AS best_auc FROM areas GROUP BY model""",
       "areas")
def best_workflow_per_model(spark, d):
    out = compare.best_workflow_per_model(_areas(spark, d))
    return out.select("model", "best_workflow", *T.r6("best_auc"))


@query("auc_comparison", f"""
    SELECT model, {PIVOT}, arg_max(workflow, auc) AS best_workflow, round(max(auc), 6) AS best_auc,
           coalesce((SELECT string_agg(workflow, ',' ORDER BY workflow)
                     FROM (SELECT workflow, arg_max(model, auc) AS winner FROM areas GROUP BY workflow)
                     WHERE winner = model), '') AS wins
    FROM areas GROUP BY model""", "areas")
def auc_comparison(spark, d):
    out = compare.auc_comparison(_areas(spark, d), models=T.TOY_MODELS)
    return out.select(
        "model", *[F.round(f"`{w}`", 6).alias(w) for w in compare.WORKFLOWS], "best_workflow",
        F.round("best_auc", 6).alias("best_auc"), "wins",
    )
