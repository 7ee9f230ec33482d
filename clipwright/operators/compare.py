"""Comparison of protocols on (model, workflow, auc) tables: at most models x workflows rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Published order of protocols and models.
WORKFLOWS = ["80_20", "loso", "pca"]
MODELS = ["rf", "xgb", "svm", "knn", "dtr", "logistic", "nb"]


def position(column: str, order: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(v) for v in order]), F.col(column))


def workflow_pivot(areas: DataFrame, workflows: Sequence[str] = WORKFLOWS) -> DataFrame:
    """Model x workflow table with fixed columns; a missing area is NULL."""
    return areas.groupBy("model").pivot("workflow", list(workflows)).agg(F.first("auc"))


def _winner(order: Sequence[str], column: str) -> Column:
    """``column`` of the highest area; the earliest in ``order`` wins ties; NULL areas never win."""
    key = F.when(F.col("auc").isNotNull(), F.struct("auc", -position(column, order)))
    return F.max_by(column, key)


def best_model_per_workflow(areas: DataFrame, models: Sequence[str] = MODELS) -> DataFrame:
    return areas.groupBy("workflow").agg(
        _winner(models, "model").alias("best_model"), F.max("auc").alias("best_auc"), F.avg("auc").alias("mean_auc")
    )


def best_workflow_per_model(areas: DataFrame, workflows: Sequence[str] = WORKFLOWS) -> DataFrame:
    return areas.groupBy("model").agg(
        _winner(workflows, "workflow").alias("best_workflow"), F.max("auc").alias("best_auc")
    )


def auc_comparison(
    areas: DataFrame, workflows: Sequence[str] = WORKFLOWS, models: Sequence[str] = MODELS
) -> DataFrame:
    """The model x workflow table with each model's best workflow and whether it wins a workflow."""
    tops = best_model_per_workflow(areas, models).groupBy(F.col("best_model").alias("model")).agg(
        F.array_join(F.array_sort(F.collect_list("workflow")), ",").alias("wins")
    )
    return (
        workflow_pivot(areas, workflows)
        .join(best_workflow_per_model(areas, workflows), "model")
        .join(tops, "model", "left")
        .withColumn("wins", F.coalesce("wins", F.lit("")))
    )
